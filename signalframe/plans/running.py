"""Running sums and row numbers over any total order, in blocks cut by rows.

The order is range-partitioned, so a block holds a share of the rows however
they lie in time or under one key: one day, one time or one key with a third of
all rows is spread over tasks.  What crosses a block border are the sums of the
blocks before it, a table with at most two rows per block.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from signalframe.plans.staging import stage

BLOCK, TIE = "_run_block", "_run_tie"


def range_blocks(df: DataFrame, order: Sequence[str], blocks: int | None = None) -> DataFrame:
    """The rows with the number of their range of ``order`` and their place among equal ones.  Runs a job.

    Rows equal in ``order`` are told apart by where they lie in the input, so a
    value with many rows is split as well.  The cut is stored: later steps, and
    a repeated task, see the same one.
    """
    placed = df.withColumn(TIE, F.monotonically_increasing_id())
    parts = [blocks] if blocks else []
    return stage(placed.repartitionByRange(*parts, *order, TIE).withColumn(BLOCK, F.spark_partition_id()), "range-blocks")


def running_sums(df: DataFrame, order: Sequence[str], sums: Mapping[str, Column], keys: Sequence[str] = (),
                 blocks: int | None = None) -> DataFrame:
    """Add the sum of each expression over the rows up to and with this one, in ``order``, per key.  Runs a job.

    Key columns must not be null; nulls of ``order`` come first.  Rows equal in
    ``order`` come in the input's order, so hand in a stored table where that
    must not change.  Input and values are read as whole numbers.
    """
    values = {f"_run_{i}": e.cast("long") for i, e in enumerate(sums.values())}
    cut = range_blocks(df.withColumns(values), [*keys, *order], blocks)
    if keys:
        edges = cut.groupBy(BLOCK).agg(F.min(F.struct(*keys)).alias("a"), F.max(F.struct(*keys)).alias("b"))
        met = edges.select(BLOCK, F.explode(F.array_distinct(F.array("a", "b"))).alias("k")).groupBy("k").count()
        shared = met.where("count > 1").select("k.*")
        # a key that lies in several blocks is the first or last of each: at most two keys a block
        part = cut.join(F.broadcast(shared), list(keys), "left_semi")
    else:
        part = cut
    totals = part.groupBy(*keys, BLOCK).agg(*[F.sum(v).alias(v) for v in values])
    earlier = Window.partitionBy(*keys).orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    carried = totals.select(*keys, BLOCK, *[F.sum(v).over(earlier).alias(f"{v}_before") for v in values])
    inside = Window.partitionBy(*keys, BLOCK).orderBy(*order, TIE).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = cut.join(F.broadcast(carried), [*keys, BLOCK], "left").withColumns(
        {name: F.sum(v).over(inside) + F.coalesce(F.col(f"{v}_before"), F.lit(0)) for name, v in zip(sums, values)})
    return out.select(*[F.col(f"`{c}`") for c in df.columns if c not in sums], *sums)


def number_by_range(df: DataFrame, order: Sequence[str], keys: Sequence[str] = (), name: str = "row_no",
                    blocks: int | None = None) -> DataFrame:
    """Add the 0-based position of each row in ``order``, per key, for tables of any grain.  Runs a job."""
    counted = running_sums(df, order, {name: F.lit(1)}, keys, blocks)
    return counted.withColumn(name, F.col(name) - 1)
