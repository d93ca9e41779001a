"""Fixed-interval aggregation of raw rows: partial aggregate, one shuffle on the interval.

The map-side partial aggregate shrinks a hot interval to one row per task
before the shuffle, so a third of all rows in one interval is harmless.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from signalframe import config
from signalframe.functions.clock import interval_start
from signalframe.operators.articles import numeric_columns

WIDTH = "15 minutes"


def aggregate_column(name: str, kind: str) -> Column:
    """One aggregate; an empty sum is 0, a spread of one value is NULL."""
    value = F.col(f"`{name}`")
    return {
        "sum": lambda: F.coalesce(F.sum(value), F.lit(0)),
        "mean": lambda: F.avg(value),
        "min": lambda: F.min(value),
        "max": lambda: F.max(value),
        "std": lambda: F.stddev_samp(value),
    }[kind]()


def bucket_news(
    df: DataFrame,
    time: str = "datetime",
    width: str = WIDTH,
    aggregates: Mapping[str, Sequence[str]] = config.NEWS_AGGREGATES,
    keys: Sequence[str] = (),
) -> DataFrame:
    """Article rows to one row per interval; only columns present are aggregated.

    ``article_count`` is the number of rows.
    """
    present = set(df.columns)
    aggs = [
        aggregate_column(c, kind).alias(f"{c}_{kind}")
        for c, kinds in aggregates.items() if c in present for kind in kinds
    ]
    bucketed = df.withColumn("time_bucket", interval_start(time, width))
    return bucketed.groupBy(*keys, "time_bucket").agg(*aggs, F.count("*").alias("article_count"))


def bucket_weather(df: DataFrame, time: str | None = None, width: str = WIDTH) -> DataFrame:
    """Weather and load readings to one row per interval.

    Named columns use their own aggregates, every other number is averaged,
    calendar parts and moving averages are left out.  Names get the aggregate
    as suffix as soon as one column has several aggregates.
    """
    if time is None:
        time = "datetime" if "datetime" in df.columns else "timestamp"
    numbers = numeric_columns(df, config.WEATHER_SKIPPED)
    spec = {c: kinds for c, kinds in config.WEATHER_AGGREGATES.items() if c in df.columns}
    spec |= {c: ["mean"] for c in numbers if c not in spec and "moving_avg" not in c}
    suffixed = any(len(kinds) > 1 for kinds in spec.values())
    aggs = [
        aggregate_column(c, kind).alias(f"{c}_{kind}" if suffixed else c)
        for c, kinds in spec.items() for kind in kinds
    ]
    bucketed = df.withColumn("_start", interval_start(time, width))
    return bucketed.groupBy(F.col("_start").alias("timestamp")).agg(*aggs)


def partial_rollup(
    df: DataFrame, time: str, columns: Sequence[str], width: str = WIDTH, keys: Sequence[str] = ()
) -> DataFrame:
    """Mergeable partials per interval: row count, and per column n, sum, min, max, m2.

    ``m2`` is the sum of squared distances from the mean.  Such a table can be
    stored per batch or day and folded again at any time without raw rows.
    """
    aggs = [F.count("*").alias("rows")]
    for c in columns:
        value = F.col(f"`{c}`")
        aggs += [
            F.count(value).alias(f"{c}_n"),
            F.sum(value).cast("double").alias(f"{c}_sum"),
            F.min(value).alias(f"{c}_min"),
            F.max(value).alias(f"{c}_max"),
            (F.var_pop(value) * F.count(value)).alias(f"{c}_m2"),
        ]
    return df.withColumn("time_bucket", interval_start(time, width)).groupBy(*keys, "time_bucket").agg(*aggs)


def add_partials(partials: DataFrame, columns: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """Partials again, of at most two for each interval: those stored and those to add."""
    aggs = [F.sum("rows").alias("rows")]
    for c in columns:
        n, mean = F.col(f"{c}_n"), F.try_divide(F.col(f"{c}_sum"), F.col(f"{c}_n"))
        # with two parts: half of (n1 + n2)^2 - n1^2 - n2^2 is n1 * n2
        product = (F.sum(n) * F.sum(n) - F.sum(n * n)) / 2
        apart = F.max(mean) - F.min(mean)
        aggs += [
            F.sum(n).alias(f"{c}_n"), F.sum(f"{c}_sum").alias(f"{c}_sum"), F.min(f"{c}_min").alias(f"{c}_min"), F.max(f"{c}_max").alias(f"{c}_max"),
            (F.sum(f"{c}_m2") + F.coalesce(apart * apart * F.try_divide(product, F.sum(n)), F.lit(0.0))).alias(f"{c}_m2"),
        ]
    return partials.groupBy(*keys, "time_bucket").agg(*aggs)


def merge_partials(
    partials: DataFrame, columns: Sequence[str], width: str | None = None, keys: Sequence[str] = ()
) -> DataFrame:
    """Fold partials to one row per interval (optionally a wider one) with exact mean and std.

    One aggregate, folded in each task before the shuffle.  The spread is that
    inside the parts plus that of the part means, which are measured from the
    column's overall mean so that large values do not cancel.
    """
    if width:
        partials = partials.withColumn("time_bucket", interval_start("time_bucket", width))
    centres = partials.agg(F.struct(*[
        F.try_divide(F.sum(f"{c}_sum"), F.sum(f"{c}_n")).alias(f"c{i}") for i, c in enumerate(columns)
    ]).alias("centres"))
    group = [*keys, "time_bucket"]
    aggs = [F.sum("rows").alias("article_count")]
    for i, c in enumerate(columns):
        n, part_n = F.sum(f"{c}_n"), F.col(f"{c}_n")
        distance = F.try_divide(F.col(f"{c}_sum"), part_n) - F.col(f"_centres.c{i}")
        squares = F.sum(f"{c}_m2") + F.sum(part_n * distance * distance) - F.try_divide(
            F.sum(part_n * distance) * F.sum(part_n * distance), n)
        aggs += [
            F.coalesce(F.sum(f"{c}_sum"), F.lit(0.0)).alias(f"{c}_sum"),
            F.try_divide(F.sum(f"{c}_sum"), n).alias(f"{c}_mean"),
            F.min(f"{c}_min").alias(f"{c}_min"),
            F.max(f"{c}_max").alias(f"{c}_max"),
            F.when(n > 1, F.sqrt(F.greatest(squares, F.lit(0.0)) / (n - 1))).alias(f"{c}_std"),
        ]
    return partials.withColumn("_centres", centres.scalar()).groupBy(*group).agg(*aggs)
