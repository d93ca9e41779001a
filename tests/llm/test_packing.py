import numpy as np
import pytest
from pyspark.sql import functions as F
from samples import AWKWARD, documents

from signalframe.llm import packing


def naive(lengths, opened):
    """Best-fit decreasing, piece by piece: what the bins hold (which of equally full bins gets a piece is open)."""
    bins = []
    for length in sorted(lengths, reverse=True):
        fitting = [b for b in bins if b[0] >= length]
        if fitting:
            best = min(fitting, key=lambda b: b[0])
        else:
            best = [opened(length), []]
            bins.append(best)
        best[0] -= length
        best[1].append(length)
    return sorted(sum(b[1]) for b in bins)


@pytest.mark.parametrize("seed", range(8))
def test_grouped_best_fit_equals_the_naive_one(seed):
    draw = np.random.default_rng(seed)
    lengths = draw.integers(1, 33, 200).tolist()
    opened = lambda x: next(c for c in (8, 16, 32) if c >= x)
    counts = {x: lengths.count(x) for x in set(lengths)}
    runs, bins = packing.best_fit(counts, opened)
    held = {}
    for length, first, each, start, place in sorted(runs):
        stretch = [r[1] for r in runs if r[0] == length and r[1] > first]
        for k in range(first, min([*stretch, counts[length]])):
            held.setdefault(start + (k - first) // each, []).append(length)
    assert sorted(map(sum, held.values())) == naive(lengths, opened) and sorted(sum(held.values(), [])) == sorted(lengths)
    assert sum(n for _, n, _ in bins) == len(held)


def test_cheapest_of_the_permitted_lengths():
    made = packing.plan({100: 10, 30: 5}, (128, 256, 1024), 0)
    assert sum(n * size for _, n, _, size in made.bins.tolist()) <= 10 * 128


def check(rows, counts, capacities):
    bins = {}
    for r in rows:
        assert 0 < r.length <= max(capacities)
        bins.setdefault(r.bin_id, []).append(r)
    for held in bins.values():
        at = 0
        for r in sorted(held, key=lambda r: r.bin_offset):
            assert r.bin_offset == at
            at += r.length
        assert at == held[0].bin_tokens <= held[0].bin_capacity == min(c for c in capacities if c >= at)
    total = {}
    for r in rows:
        total[r.doc_id] = total.get(r.doc_id, 0) + r.length
        assert r.piece_start == r.piece * max(capacities)
    assert total == {i: n for i, n in counts if n and n > 0}


def test_every_token_has_one_place(spark):
    draw = np.random.default_rng(1)
    counts = [(k, int(n)) for k, n in enumerate(np.exp(draw.normal(3, 1.5, 800)).astype(int))] + [(900, 1000), (901, 64), (902, 0), (903, -4)]
    counts += [(1000 + k, 17) for k in range(400)]  # a hot length
    df = spark.createDataFrame([(*c, "clash") for c in counts], "doc_id long, n_tokens long, length string")
    check(packing.packed(df, (16, 32, 64), 4).collect(), counts, (16, 32, 64))


def test_awkward_rows(spark):
    df = spark.createDataFrame([(1, None), (2, 0), (None, 5), (3, 5), (3, 5)], "doc_id long, n_tokens int")
    out = packing.packed(df, (8, 16), 0).collect()
    assert sorted(str(r.doc_id) for r in out) == ["3", "3", "None"] and sum(r.length for r in out) == 15
    assert packing.packed(df.limit(0)).count() == 0


def test_token_count(spark):
    counts = documents(spark, [*AWKWARD, "Ab1, cd!!", "éü 12"]).select(packing.token_count(F.col("text")).alias("n"))
    got = [r.n for r in counts.collect()]
    assert got[:9] == [0, 0, 0, 0, 1, 1, 1, 2, 2] and got[-2:] == [5, 2]
