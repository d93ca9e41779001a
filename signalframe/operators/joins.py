"""Joins of time series and record tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from signalframe.operators.articles import numeric_columns


def series_bounds(left: DataFrame, right: DataFrame, left_time: str, right_time: str) -> DataFrame:
    """One row: first and last time that both series can share."""
    both = left.select(F.col(left_time).alias("t"), F.lit(True).alias("is_left")).unionAll(
        right.select(F.col(right_time).alias("t"), F.lit(False).alias("is_left"))
    )
    l_time, r_time = F.when(F.col("is_left"), F.col("t")), F.when(~F.col("is_left"), F.col("t"))
    return both.agg(
        F.when(F.min(l_time).isNotNull() & F.min(r_time).isNotNull(), F.greatest(F.min(l_time), F.min(r_time)))
        .alias("overlap_start"),
        F.when(F.max(l_time).isNotNull() & F.max(r_time).isNotNull(), F.least(F.max(l_time), F.max(r_time)))
        .alias("overlap_end"),
    )


def range_overlap(left: DataFrame, right: DataFrame, left_time: str, right_time: str) -> DataFrame:
    """One row: overlap of the two time ranges and the rows of each side inside it."""
    bounds = series_bounds(left, right, left_time, right_time)
    span = bounds.select(F.struct("overlap_start", "overlap_end").alias("span"))
    inside = left.select(F.col(left_time).alias("t"), F.lit(1).alias("l"), F.lit(0).alias("r")).unionAll(
        right.select(F.col(right_time).alias("t"), F.lit(0).alias("l"), F.lit(1).alias("r"))
    ).withColumn("span", span.scalar())
    hit = F.col("t").between(F.col("span.overlap_start"), F.col("span.overlap_end"))
    return inside.agg(
        F.max("span.overlap_start").alias("overlap_start"),
        F.max("span.overlap_end").alias("overlap_end"),
        F.coalesce(F.sum(F.when(hit, F.col("l"))), F.lit(0)).alias("left_rows"),
        F.coalesce(F.sum(F.when(hit, F.col("r"))), F.lit(0)).alias("right_rows"),
    )


def merge_on_time(
    left: DataFrame,
    right: DataFrame,
    left_time: str,
    right_time: str,
    suffix: str = "_weather",
    check_overlap: bool = True,
) -> DataFrame:
    """Inner join on time; clashing right columns get the suffix, null times never match.

    With ``check_overlap`` two series without a common range fail the job; the
    check is part of the plan and reads one time column of each side, so give it
    stored tables.  An empty series gives an empty result.
    """
    if check_overlap:
        apart = F.coalesce(F.col("overlap_start") > F.col("overlap_end"), F.lit(True))
        refused = F.raise_error(F.lit("the two series share no time range")).cast("boolean")
        checked = series_bounds(left, right, left_time, right_time).select(F.when(apart, refused).otherwise(True).alias("shared"))
        left = left.where(checked.scalar())
    clashes = (set(left.columns) - {left_time}) & (set(right.columns) - {right_time})
    renamed = right.withColumnsRenamed({c: f"{c}{suffix}" for c in clashes})
    return left.join(renamed.withColumnRenamed(right_time, left_time), left_time, "inner")


def merge_zero_filled(
    left: DataFrame,
    right: DataFrame,
    left_time: str,
    right_time: str,
    key: str = "datetime",
    suffixes: tuple[str, str] = ("_x", "_y"),
) -> DataFrame:
    """Inner join on time with both clashing columns suffixed and missing numbers set to 0."""
    clashes = (set(left.columns) - {left_time}) & (set(right.columns) - {right_time})
    sides = [
        side.withColumnsRenamed({**{c: f"{c}{tail}" for c in clashes}, time: key})
        for side, time, tail in ((left, left_time, suffixes[0]), (right, right_time, suffixes[1]))
    ]
    joined = sides[0].join(sides[1], key, "inner")
    return joined.fillna(0, subset=numeric_columns(joined))


def new_records(batch: DataFrame, existing: DataFrame, key: str = "GKGRECORDID") -> DataFrame:
    """Rows of the batch whose id is not stored yet; repeats inside the batch stay."""
    return batch.join(existing.select(key), key, "left_anti")
