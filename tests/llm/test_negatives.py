"""Subset-sum scores, the grid of cells and the mined rows against brute force."""

import random
from fractions import Fraction

import numpy as np
import pytest

from signalframe.llm import negatives as n

SCHEMA = "vec_id long, embedding array<float>, label int, rank int, block long"


def table(spark, rows):
    """Embeddings with columns whose names the operator uses itself."""
    return spark.createDataFrame([(i, v, x, -1, -1) for i, v, x in rows], SCHEMA)


def mined(spark, rows, **settings):
    return n.hard_negatives(n.prepared(table(spark, rows)), **settings).collect()


def brute(rows):
    from math import floor, isfinite

    kept = []
    for i, v, label in rows:
        if label is None or v is None or any(x is None or not isfinite(x) for x in v):
            continue
        label = (label + 1) % 10 if i is not None and i % 7 == 0 else label
        kept.append((i, [floor(Fraction(float(np.float32(x))) * 256) for x in v], label))
    key = lambda x: (-x[1], x[0] is None, x[0] or 0)
    out = []
    for a, (i, v, label) in enumerate(kept):
        if i is None or i % 50:
            continue
        scored = [(j, sum(p * q for p, q in zip(v, w)), x) for b, (j, w, x) in enumerate(kept) if b != a]
        for pos, score, _ in sorted((s for s in scored if s[2] == label), key=key)[:5]:
            near = sorted((s for s in scored if s[2] != label and 50 * score <= 100 * s[1] <= 95 * score), key=key)[:3]
            out += [(i, pos, r, neg, score, value) for r, (neg, value, _) in enumerate(near, 1)]
    return sorted(out, key=repr)


def vectors(count, seed, width=20, labels=4):
    draw = random.Random(seed)
    return [(i, [draw.uniform(-1, 1) + 0.4 for _ in range(width)], draw.randrange(labels)) for i in range(count)]


def test_table_lookups_are_exact_inner_products():
    draw = np.random.default_rng(3)
    for low, high, width in ((-300, 300, 16), (-1, 0, 8), (0, 1, 24), (-2**31, 2**31, 8), (5, 6, 8)):
        rows, anchors = draw.integers(low, high, (50, width)), draw.integers(low, high, (7, width))
        planes, bits = n.pack(rows)
        assert (n.unpack(planes, width // 8, 50, bits, np.arange(50)) == rows).all()
        packed = np.frombuffer(bits, np.uint8).reshape(planes, width // 8, 50)
        assert (n.scores(n.tables(anchors, np.int64), packed) == rows @ anchors.T).all()


@pytest.mark.parametrize("cells", [None, (64, 8, 2)])
def test_equals_brute_force(spark, monkeypatch, cells):
    if cells:  # many blocks, cells and sub-blocks
        monkeypatch.setattr(n, "CELL_ROWS", cells[0])
        monkeypatch.setattr(n, "BLOCK_ROWS", 16)
        monkeypatch.setattr(n, "CELL_ANCHORS", cells[2])
        monkeypatch.setattr(n, "ANCHORS_AT_ONCE", 2)
        monkeypatch.setattr(n, "ROWS_AT_ONCE", 10)
    rows = vectors(400, 1)
    assert sorted((tuple(r) for r in mined(spark, rows)), key=repr) == brute(rows)


def test_ties_repeats_nulls_and_lengths(spark):
    nan, inf = float("nan"), float("inf")
    rows = vectors(120, 2, 9, 2)
    rows += [rows[50]] * 4 + [(50, rows[3][1], 1), (None, rows[51][1], 0), (None, rows[52][1], 1)]  # repeated and absent ids
    rows += [(200 + k, [0.5] * 9, k % 2) for k in range(30)]  # equal vectors
    rows += [(300, None, 1), (350, [0.1] * 9, None), (400, [nan] + [0.1] * 8, 1), (450, [inf] * 9, 0), (500, [None] + [0.2] * 8, 0)]
    rows += [(550, [], 1), (600, [1.0], 0), (650, [0.3] * 30, 1), (-50, [-0.5] * 9, 0), (700, [0.0] * 9, 1)]
    got = sorted((tuple(r) for r in mined(spark, rows)), key=repr)
    assert got == brute(rows) and {r[0] for r in got} & {50, 650}


def test_empty_and_lonely(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(50, [1.0], 1)]) == []
    assert mined(spark, [(1, [1.0], 1), (2, [1.0], 2)]) == []
    assert n.hard_negatives(n.prepared(table(spark, []))).columns == [
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def test_large_components_stay_exact_or_fail(spark):
    rows = [(50, [3.0e6, 1.0], 1), (1, [3.0e6, 2.0], 1), (2, [2.0e6, 5.0], 2)]
    assert [tuple(r) for r in mined(spark, rows)] == brute(rows) != []
    with pytest.raises(Exception, match="64 bits"):
        mined(spark, [(50, [1e30], 1), (1, [1e30], 1)])
