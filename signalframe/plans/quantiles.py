"""Exact quantiles of many columns without one task seeing a whole column."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ACCURACY = 100_000
#: Parts of equal width into which the bracket around a rank is cut.
SLICES = 1024


def long_cells(df: DataFrame, columns: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """One row per cell: (kept columns, feature, value)."""
    numbers = df.select(*keep, *[F.col(f"`{c}`") for c in columns])
    return numbers.unpivot(list(keep), [F.col(f"`{c}`") for c in columns], "feature", "value").withColumn(
        "value", F.col("value").cast("double"))


def sliced(cells: DataFrame, brackets: DataFrame) -> DataFrame:
    """Cells with each bracket of their feature and their slice of it: -1 below, SLICES above."""
    # one row per (column, probability): bounded by the schema, safe to broadcast
    both, v, low, high = cells.join(F.broadcast(brackets), "feature"), F.col("value"), F.col("low"), F.col("high")
    inside = F.least(F.floor((v - low) / (high - low) * SLICES), F.lit(SLICES - 1))
    part = F.when(v < low, -1).when(v > high, SLICES).when(low == high, 0).otherwise(inside)
    return both.withColumn("slice", part.cast("int"))


def holding(counted: DataFrame, group: Sequence[str], order: str, position: Column) -> DataFrame:
    """The counted entries (``rows`` each) that hold a position of their group's order, with the rows before them."""
    upto = Window.partitionBy(*group).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = counted.withColumn("upto", F.sum("rows").over(upto)).withColumn("before", F.col("upto") - F.col("rows"))
    return placed.where((F.col("upto") > position) & (F.col("before") <= position))


def exact_quantiles(df: DataFrame, columns: Sequence[str], probabilities: Sequence[float]) -> DataFrame:
    """(feature, probability, value), linear between the two nearest ranks.

    First pass: an approximate sketch gives a bracket of values around each
    rank (its error is n / ACCURACY ranks, the bracket is three times wider on
    each side).  Second pass: rows are counted by slice of the bracket, and the
    slices that hold the two ranks are found among these few counts.  Third
    pass: the values of those slices are counted and the ranks looked up.  A
    rank just outside the bracket is the nearest value there; one further away
    fails the job.  No task sees more than a bracket's slice in order.
    """
    margin = 3 / ACCURACY
    cells = long_cells(df, columns).where(F.col("value").isNotNull())
    low = [max(0.0, p - margin) for p in probabilities]
    high = [min(1.0, p + margin) for p in probabilities]
    sketch = cells.groupBy("feature").agg(
        F.count("*").alias("n"), F.percentile_approx("value", low + high, ACCURACY).alias("edges"))
    k = len(probabilities)
    brackets = sketch.select("feature", "n", F.inline(F.array(*[
        F.struct(F.lit(float(p)).alias("probability"), F.get("edges", F.lit(i)).alias("low"), F.get("edges", F.lit(k + i)).alias("high"))
        for i, p in enumerate(probabilities)
    ])))
    one = ["feature", "probability", "n", "side"]
    parts = sliced(cells, brackets)
    counted = parts.groupBy("feature", "probability", "n", "slice").agg(
        F.count("*").alias("rows"), F.min("value").alias("least"), F.max("value").alias("most"))
    rank = (F.col("n") - 1) * F.col("probability")
    sides = [F.struct(F.lit(s).alias("side"), f(rank).cast("long").alias("position")) for s, f in (("a", F.floor), ("b", F.ceil))]
    wanted = counted.select("*", F.inline(F.array(*sides)))
    chosen = holding(wanted, one, "slice", F.col("position")).withColumn("skip", F.col("position") - F.col("before"))
    near = F.when((F.col("slice") < 0) & (F.col("skip") == F.col("rows") - 1), F.col("most")).when(
        (F.col("slice") == SLICES) & (F.col("skip") == 0), F.col("least"))
    edge = chosen.where((F.col("slice") < 0) | (F.col("slice") == SLICES)).select(*one, near.alias("value"))
    slices = chosen.where(F.col("slice").between(0, SLICES - 1)).select("feature", "probability", "side", "slice", "skip")
    # at most two rows per bracket
    values = parts.join(F.broadcast(slices), ["feature", "probability", "slice"]).groupBy(*one, "skip", "value").agg(F.count("*").alias("rows"))
    found = holding(values, one, "value", F.col("skip")).select(*one, "value").unionAll(edge)
    ends = found.groupBy("feature", "probability", "n").agg(
        F.max(F.when(F.col("side") == "a", F.col("value"))).alias("a"), F.max(F.when(F.col("side") == "b", F.col("value"))).alias("b"))
    exact = F.when(F.col("a").isNotNull() & F.col("b").isNotNull(), F.col("a") + (F.col("b") - F.col("a")) * (rank - F.floor(rank)))
    return ends.select(
        "feature", "probability",
        F.coalesce(exact, F.raise_error(F.lit("quantile bracket missed")).cast("double")).alias("value"),
    )
