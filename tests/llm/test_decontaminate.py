import random

import numpy as np
import pytest
from samples import AWKWARD, documents, edited, prose

from signalframe.llm import decontaminate as d

ITEMS = [prose(12 + 3 * k, 50 + k) for k in range(12)]


def benchmark(spark, items):
    return spark.createDataFrame([(k, t, 7) for k, t in enumerate(items)], "item_id long, text string, doc_id int")


def brute(items, texts, ids):
    """Every item against every start, by the textbook recurrence."""
    out = set()
    for k, item in enumerate(items):
        a = d.word_hashes(item or "").tolist()
        for i, text in zip(ids, texts):
            b = d.word_hashes(text or "").tolist()
            if a and distance(a, b) <= d.allowed(len(a)):
                out.add((i, k))
    return out


def distance(a, b):
    row = [0] * (len(b) + 1)
    for i, x in enumerate(a, 1):
        before, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], min(before + (x != y), row[j] + 1, row[j - 1] + 1)
    return min(row)


def pairs(df):
    return {(r.doc_id, r.item_id) for r in df.collect()}


def test_equals_brute_force(spark):
    draw, texts = random.Random(1), [*AWKWARD[:9]]
    for k, item in enumerate(ITEMS):
        texts += [prose(80, 900 + k), f"{prose(40, 300 + k)} {item} {prose(50, 400 + k)}", f"{item.upper().replace(' ', '  ')}", edited(item, 0.1, k) + " " + prose(20, k)]
        words = item.split()
        texts.append(prose(10, k) + " " + " ".join(words[: len(words) // 2]))  # half an item is none
    draw.shuffle(texts)
    found = d.leaks(documents(spark, texts), benchmark(spark, [*ITEMS, None, "", "!?"]))
    assert pairs(found) == brute(ITEMS, texts, range(len(texts)))
    exact = [r for r in found.collect() if r.edits == 0]
    assert len(exact) >= 24 and all(r.similarity == 1 and r.contaminated for r in exact)


def test_recall_at_the_limit():
    draw, hit, n = random.Random(2), 0, 0
    for k in range(300):
        item = d.word_hashes(prose(15 + k % 40, k))
        words = item.tolist()
        for _ in range(d.allowed(len(words))):
            place = draw.randrange(len(words))
            change = draw.choice("sid")
            if change == "s":
                words[place] = draw.randrange(2**63)
            elif change == "i":
                words.insert(place, draw.randrange(2**63))
            else:
                del words[place]
        text = np.array(words + [draw.randrange(2**63) for _ in range(60)], np.uint64)
        size, start = d.window_size(len(item)), np.zeros(1, np.int64)
        hit += bool(set(d.walk_keys(item, start, size)[0].tolist()) & set(d.walk_keys(text, start, size)[0].tolist()))
        n += 1
    assert hit / n >= 0.95


def test_edit_distances_equal_the_recurrence():
    draw = random.Random(3)
    items = [np.array([draw.randrange(5) for _ in range(draw.randrange(1, 12))]) for _ in range(60)]
    passages = [np.array([draw.randrange(5) for _ in range(draw.randrange(0, 15))], np.int64) for _ in range(60)]

    def prefix(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            before, row[0] = row[0], i
            for j, y in enumerate(b, 1):
                before, row[j] = row[j], min(before + (x != y), row[j] + 1, row[j - 1] + 1)
        return min(row)

    assert d.edit_distances(items, passages).tolist() == [prefix(a.tolist(), b.tolist()) for a, b in zip(items, passages)]


@pytest.mark.parametrize("words", range(1, 70))
def test_window_sizes(words):
    assert d.window_size(words) <= words < d.next_size(d.window_size(words))


def test_short_items_and_empty_tables(spark):
    docs = documents(spark, ["one two three", "two one", "three", None, "one two three"], [1, 2, 3, 4, 1])
    assert pairs(d.leaks(docs, benchmark(spark, ["three", "one two"]))) == {(1, 0), (3, 0), (1, 1)}
    assert d.leaks(docs, benchmark(spark, [])).count() == 0
    assert d.leaks(docs.limit(0), benchmark(spark, ["three"])).count() == 0


def test_passages_that_end_short_with_their_document(spark):
    items = [prose(n, 800 + n) for n in (10, 12, 14, 16, 19, 22, 26, 31)]
    cut = [" ".join(item.split()[:-1]) for item in items]
    texts = cut + [f"{prose(30, 40 + k)} {text}" for k, text in enumerate(cut)] + [" ".join(i.split()[: len(i.split()) - d.allowed(len(i.split())) - 1]) for i in items]
    found = {(r.doc_id, r.item_id): (r.start, r.edits) for r in d.leaks(documents(spark, texts), benchmark(spark, items)).collect()}
    assert found == {(k, k): (0, 1) for k in range(8)} | {(8 + k, k): (30, 1) for k in range(8)}
