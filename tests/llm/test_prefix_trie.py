"""Nodes of the prefix trie against a plain recursive build."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from signalframe.llm import prefix_trie as p

SCHEMA = "conv_id long, turn long, role string, text string, depth int, key string"
NAMES = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def table(spark, rows):
    """Conversations with columns whose names the operator uses itself."""
    return spark.createDataFrame([(*r, -1, "clash") for r in rows], SCHEMA)


def digest(role, text):
    return hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()


def brute(rows):
    turns = {}
    for c, turn, role, text in rows:
        if c is not None:
            turns.setdefault(c, []).append((turn is not None, turn or 0, digest(role or "", text or "")[:16], (role or "", text or "")))
    turns = {c: [x[-1] for x in sorted(t)] for c, t in turns.items()}
    convs = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 9
        family = c - (abs(c) % 5) * (1 if c >= 0 else -1)
        convs[c] = tuple(turns.get(family, [])[:h] + own[h:])
    members, ends = {}, {}
    for c, t in convs.items():
        for d in range(len(t) + 1):
            members.setdefault(t[:d], []).append(c)
        ends.setdefault(t, []).append(c)
    children = {}
    for node in members:
        if node:
            children.setdefault(node[:-1], []).append(node)

    def below(node):
        todo, found = [node], []
        while todo:
            found.append(todo.pop())
            todo += children.get(found[-1], [])
        return found

    out = []
    for node, who in members.items():
        tree = below(node)
        out.append((
            min(who), len(node), min(members[node[:-1]]) if node else None, len(who), len(children.get(node, [])),
            sum(x not in children for x in tree), sum((len(members[x]) - 1) * len(x[-1][1].encode()) for x in tree if x),
            hashlib.sha256(",".join(map(str, sorted(ends.get(node, [])))).encode()).hexdigest()))
    return sorted(out, key=repr)


def built(spark, rows, **settings):
    frame = p.prefix_trie(table(spark, rows), **settings)
    assert frame.columns == NAMES
    return sorted((tuple(r) for r in frame.collect()), key=repr)


def conversations(count, seed, words=3, longest=12):
    draw = random.Random(seed)
    out = []
    for c in range(count):
        out += [(c, t, draw.choice(["user", "assistant"]), draw.choice(["ja", "né", "", "x" * 40][:words])) for t in range(draw.randrange(1, longest))]
    draw.shuffle(out)
    return out


@pytest.mark.parametrize("limit", [10**6, 40, 3, 0])
def test_equals_brute_force_at_any_container_size(spark, limit):
    rows = conversations(90, 1)
    assert built(spark, rows, limit=limit) == brute(rows)


def test_awkward_rows(spark):
    rows = conversations(30, 2) + [(None, 0, "user", "a")] * 3
    rows += [(200, None, None, None), (200, None, "user", ""), (200, 1, "user", "b"), (200, 1, "user", "a"), (200, 1, "user", "a")]
    rows += [(c, t, "r", "same") for c in (-7, -5, -3, -1, 2**62) for t in range(4)]  # negative ids and a large one
    rows += [(c, 0, "user", "short") for c in (301, 302, 303)]  # nothing left of its own, no family head
    got = built(spark, rows, limit=20)
    assert got == brute(rows)
    assert any(r[1] == 0 and r[7] != p._NOTHING for r in got)  # some conversation is without turns


def test_copies_and_one_long_conversation(spark):
    rows = [(c * 5, t, "user", f"copy {t}") for c in range(150) for t in range(6)]
    rows += [(9_000, t, "user", f"long {t}") for t in range(700)]
    rows += [(9_005, t, "user", f"long {t}" if t < 500 else f"other {t}") for t in range(650)]
    assert built(spark, rows, limit=50) == brute(rows)


def test_ids_in_several_pieces(spark, monkeypatch):
    monkeypatch.setattr(p, "PIECE_IDS", 7)
    rows = [(c * 5, 0, "user", "hi") for c in range(60)]
    assert built(spark, rows, limit=5) == brute(rows)


def test_empty_table(spark):
    assert built(spark, []) == []


def test_text_is_not_shuffled(spark):
    turns = p.ordered_turns(table(spark, conversations(5, 3)))
    assert turns.columns == ["conv_id", "id", "bytes", "pos"]
    long = [(5, 0, "user", "w" * 3_000_000), (10, 0, "user", "w" * 3_000_000)]
    assert built(spark, long) == brute(long)


def test_turn_ids_keep_role_and_text_apart(spark):
    rows = spark.createDataFrame([("ab", "c"), ("a", "bc")], "role string, text string")
    assert rows.select(p.turn_id(F.col("role"), F.col("text"))).distinct().count() == 2
