import random

import numpy as np
import pytest
from samples import AWKWARD, documents, edited, prose

from signalframe.llm import components, oddsketch


def shingles(text, size):
    words = (text or "").encode().lower().split()
    if not words:
        return frozenset()
    size = min(size, len(words))
    return frozenset(tuple(words[k : k + size]) for k in range(len(words) - size + 1))


def brute(rows, size, per_cent):
    sets = [shingles(t, size) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            n = len(sets[a] & sets[b])
            if n and 100 * n >= per_cent * (len(sets[a]) + len(sets[b]) - n):
                root[find(a)] = find(b)
    least = {}
    for k, (i, _) in enumerate(rows):
        least[find(k)] = min(least.get(find(k), i), i)
    return sorted((i, len(sets[k]), least[find(k)], i == least[find(k)]) for k, (i, _) in enumerate(rows))


def found(spark, rows, **more):
    docs = documents(spark, [t for _, t in rows], [i for i, _ in rows])
    return sorted(tuple(r) for r in oddsketch.near_duplicates(docs, **more).select("doc_id", "n_shingles", "component_id", "kept").collect())


def corpus():
    texts = [*AWKWARD]
    for k in range(12):
        base = prose(150, 100 + k)
        texts += [base, *[edited(base, share, 10 * k + n) for n, share in enumerate((0.01, 0.02, 0.04, 0.08, 0.3))]]
    hot = prose(120, 77)
    texts += [hot] * 30 + [edited(hot, 0.02, n) for n in range(60)] + [edited(hot, 0.15, n) for n in range(60, 100)]
    order = list(range(len(texts)))
    random.Random(4).shuffle(order)
    return list(zip(order, texts))


@pytest.mark.parametrize(("words", "per_cent"), [(3, 85), (5, 80)])
def test_equals_brute_force(spark, words, per_cent):
    rows = corpus()
    assert found(spark, rows, words=words, per_cent=per_cent) == brute(rows, words, per_cent)


def test_chain_across_hubs(spark):
    """Documents that only a chain links, in buckets whose smallest document is linked with few."""
    text, rows = prose(200, 9), []
    for k in range(12):
        rows.append((k, text))
        text = edited(text, 0.02, 1000 + k)
    assert found(spark, rows, words=3, per_cent=85) == brute(rows, 3, 85)


def test_empty_table_and_missing_ids(spark):
    assert found(spark, []) == []
    docs = documents(spark, ["a b", "a b", None], [None, 4, None])
    out = oddsketch.near_duplicates(docs).collect()
    assert sorted((r.doc_id is None, r.component_id, r.kept, r.n_shingles) for r in out if r.component_id) == [(False, 4, True, 1), (True, 4, False, 1)]
    assert [(r.n_shingles, r.kept) for r in out if r.component_id is None] == [(0, True)]


def test_sketches_estimate_high_similarities():
    draw = np.random.default_rng(3)
    for similarity in (0.8, 0.9, 0.97):
        n = 1000
        common = int(n * 2 * similarity / (1 + similarity))
        x = draw.integers(0, 2**63, 2 * n - common, dtype=np.uint64)
        a, b = x[:n], x[n - common :]
        true = common / len(x)
        k = oddsketch.odd_sketches(np.stack([oddsketch.min_hashes(a), oddsketch.min_hashes(b)]))
        apart = int(np.unpackbits((k[0] ^ k[1]).view(np.uint8)).sum())
        guess = 1 + oddsketch.BITS / (4 * oddsketch.SAMPLES) * np.log(1 - 2 * apart / oddsketch.BITS)
        assert abs(guess - true) < 0.1 and apart <= oddsketch.furthest(true)


@pytest.mark.parametrize("seed", [1, 2])
def test_components_equal_union_find(spark, seed):
    draw = random.Random(seed)
    links = [(draw.randrange(200), draw.randrange(200)) for _ in range(120)] + [(k, k + 1) for k in range(300, 340)] + [(500, k) for k in range(501, 560)]
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    want = {(x, find(x)) for x in root if any(x in link and link[0] != link[1] for link in links)}
    got = components.connected(spark.createDataFrame(links, "a long, b long"))
    assert {tuple(r) for r in got.select("node", "component").collect()} == want
    assert components.connected(spark.createDataFrame([], "a long, b long")).count() == 0
