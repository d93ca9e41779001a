"""Running sums and row numbers over range partitions."""

import random

import pytest
from pyspark.sql import functions as F

from signalframe.operators import series
from signalframe.plans.running import BLOCK, number_by_range, range_blocks, running_sums


def rows_of(spark, cells):
    return spark.createDataFrame(cells, "k long, t long, v long, id long")


def drawn(count, seed, hot=0):
    draw = random.Random(seed)
    out = [(draw.randrange(5), draw.choice([None, *range(30)]), draw.randrange(100), i) for i in range(count)]
    return out + [(2, 7, 1, count + i) for i in range(hot)]


@pytest.mark.parametrize("blocks", [1, 3, 40])
def test_running_sums_per_key(spark, blocks):
    cells = drawn(300, 1, hot=200)
    got = {r["id"]: (r["s"], r["n"]) for r in running_sums(
        rows_of(spark, cells), ["t", "id"], {"s": F.col("v"), "n": F.lit(1)}, ["k"], blocks).collect()}
    want, sums = {}, {}
    for k, t, v, i in sorted(cells, key=lambda c: (c[0], c[1] is not None, c[1] or 0, c[3])):
        s, n = sums.get(k, (0, 0))
        want[i] = sums[k] = (s + v, n + 1)
    assert got == want


@pytest.mark.parametrize("blocks", [1, 7])
def test_numbers_without_key(spark, blocks):
    cells = drawn(200, 2)
    got = {r["id"]: r["row_no"] for r in number_by_range(rows_of(spark, cells), ["t", "id"], blocks=blocks).collect()}
    order = sorted(cells, key=lambda c: (c[1] is not None, c[1] or 0, c[3]))
    assert got == {c[3]: i for i, c in enumerate(order)}


def test_one_time_with_all_rows_is_spread(spark):
    rows = rows_of(spark, [(0, 5, i, i) for i in range(4000)]).repartition(4)
    sizes = [r["count"] for r in range_blocks(rows, ["t"], 8).groupBy(BLOCK).count().collect()]
    assert len(sizes) == 8 and max(sizes) < 4000 / 4
    numbered = number_by_range(rows, ["t"], blocks=8)
    assert sorted(r["row_no"] for r in numbered.collect()) == list(range(4000))


def test_no_task_gets_all_rows(spark):
    plan = number_by_range(rows_of(spark, drawn(50, 3)), ["t"])._jdf.queryExecution().executedPlan().toString()
    windows = [x for x in plan.split("\n") if "Window [" in x]
    assert any(BLOCK in w.split("windowspecdefinition(")[1] for w in windows)


def test_one_day_is_cut_by_rows(spark):
    day = spark.range(1000).select(F.timestamp_add("SECOND", F.col("id") * 60, F.lit("2024-01-01").cast("timestamp_ntz")).alias("t"), "id")
    marks = series.tail_validation(day, "t")
    assert {r["id"] for r in marks.where("part = 'validation'").collect()} == set(range(800, 1000))
    assert sorted(r["id"] for r in series.thin_rows(day, "t").collect()) == list(range(0, 1000, 4))
    missing = day.withColumn("t", F.when(F.col("id") >= 10, F.col("t")))
    assert series.tail_validation(missing, "t").count() == 990


def test_empty_table(spark):
    assert running_sums(rows_of(spark, []), ["t"], {"s": F.col("v")}, ["k"]).collect() == []
    assert number_by_range(rows_of(spark, []), ["t"]).collect() == []
