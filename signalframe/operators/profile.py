"""Table profiles: one aggregate pass, then a few rows of (name, value)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from signalframe import config
from signalframe.functions import clock, score
from signalframe.operators.articles import numeric_columns
from signalframe.plans.quantiles import exact_quantiles, long_cells


def percent(part, whole):
    return F.try_divide(part * 100, whole)


def quality_profile(df: DataFrame, time: str = "datetime") -> DataFrame:
    """(metric, value, pct): size, time range, nulls, flags, tone and oddities of parsed articles.

    Times are given as seconds since 1970.  Two mean tones are reported: over
    the rows that have one, and over all rows.
    """
    flags = [f"theme_{c}" for c in config.CATEGORIES]
    zero = F.lit(0)
    no_theme = sum((F.col(c) for c in flags), zero) == 0
    counts = {
        "records": F.count("*"),
        **{f"null_{c}": F.count_if(F.col(f"`{c}`").isNull()) for c in df.columns},
        **{f"flag_{c}": F.coalesce(F.sum(c), zero) for c in flags},
        "extreme_tone": F.count_if(F.abs("tone_tone") > 10),
        "no_theme": F.count_if(no_theme),
    }
    values = {
        "first_time": clock.epoch_seconds(F.min(time)),
        "last_time": clock.epoch_seconds(F.max(time)),
        "tone_mean": F.avg("tone_tone"),
        "tone_mean_all_rows": F.try_divide(F.sum("tone_tone"), F.count("*")),
        "tone_min": F.min("tone_tone"),
        "tone_max": F.max("tone_tone"),
        "positive_max": F.max("tone_positive"),
        "negative_max": F.max("tone_negative"),
    }
    one = df.agg(*[e.cast("double").alias(f"m_{k}") for k, e in {**counts, **values}.items()])
    rows = [
        F.struct(F.lit(k).alias("metric"), F.col(f"`m_{k}`").alias("value"),
                 (percent(F.col(f"`m_{k}`"), F.col("m_records")) if k in counts else F.lit(None).cast("double"))
                 .alias("pct"))
        for k in {**counts, **values}
    ]
    return one.select(F.inline(F.array(*rows)))


def records_by_month(df: DataFrame, time: str = "datetime") -> DataFrame:
    """(level, label, n, pct): rows per year and per year-month, both from one pass."""
    parts = df.where(F.col(time).isNotNull()).select(
        F.date_format(time, "yyyy").alias("year"), F.date_format(time, "yyyy-MM").alias("month"))
    counted = parts.rollup("year", "month").agg(
        F.count("*").alias("n"), F.grouping_id().alias("_level")).where(F.col("_level") < 3)
    whole = F.sum("n").over(Window.partitionBy("level"))
    return (
        counted.select(F.when(F.col("_level") == 1, "year").otherwise("month").alias("level"),
                       F.coalesce("month", "year").alias("label"), "n")
        .withColumn("pct", percent(F.col("n"), whole))
    )


def null_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(feature, nulls, fraction) per column and for the whole table (feature ``(all)``)."""
    columns = list(columns or df.columns)
    one = df.agg(F.count("*").alias("rows"),
                 *[F.count_if(F.col(f"`{c}`").isNull()).alias(f"n_{c}") for c in columns])
    total = sum((F.col(f"`n_{c}`") for c in columns), F.lit(0))
    rows = [F.struct(F.lit(c).alias("feature"), F.col(f"`n_{c}`").alias("nulls"),
                     F.try_divide(F.col(f"`n_{c}`"), F.col("rows")).alias("fraction")) for c in columns]
    rows.append(F.struct(F.lit("(all)").alias("feature"), total.alias("nulls"),
                         F.try_divide(total, F.col("rows") * len(columns)).alias("fraction")))
    return one.select(F.inline(F.array(*rows)))


def feature_statistics(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(feature, mean, min, max, std, missing) of every numeric column, in one pass.

    Rows are turned into (feature, value) cells, which each task folds to one
    row per column before the shuffle.
    """
    return basic_statistics(df, columns).drop("count")


def basic_statistics(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    cells = long_cells(df, list(columns or numeric_columns(df)))
    return cells.groupBy("feature").agg(
        F.count("value").alias("count"),
        F.avg("value").alias("mean"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
        F.stddev_samp("value").alias("std"),
        F.count_if(F.col("value").isNull()).alias("missing"),
    )


def describe(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(feature, count, mean, std, min, q25, q50, q75, max) with exact quartiles."""
    columns = list(columns or numeric_columns(df))
    quartiles = exact_quantiles(df, columns, [0.25, 0.5, 0.75]).groupBy("feature").agg(*[
        F.max(F.when(F.col("probability") == p, F.col("value"))).alias(name)
        for name, p in (("q25", 0.25), ("q50", 0.5), ("q75", 0.75))
    ])
    return basic_statistics(df, columns).join(quartiles, "feature", "left").select(
        "feature", "count", "mean", "std", "min", "q25", "q50", "q75", "max")


def hour_and_dow_profile(
    df: DataFrame, value: str = "article_count", hour: str = "hour", weekday: str = "day_of_week"
) -> DataFrame:
    """(kind, slot, mean_value): mean per hour of day and per weekday, from one pass."""
    sets = df.groupingSets([[hour], [weekday]], hour, weekday)
    means = sets.agg(F.avg(value).alias("mean_value"), F.grouping(hour).alias("_no_hour"))
    by_hour = F.col("_no_hour") == 0
    return means.select(
        F.when(by_hour, "hour").otherwise("day_of_week").alias("kind"),
        F.when(by_hour, F.col(hour)).otherwise(F.col(weekday)).alias("slot"),
        "mean_value",
    )


def histogram(df: DataFrame, value: str, bins: int = config.HISTOGRAM_BINS) -> DataFrame:
    """(bin, low, high, n): equal-width bins between min and max, empty ones included.

    The last bin holds its upper edge.  A column with a single value gets a
    range of one around it.
    """
    x = F.col(f"`{value}`")
    edges = df.agg(F.min(x).alias("a"), F.max(x).alias("b")).select(
        F.struct(
            F.when(F.col("a") == F.col("b"), F.col("a") - 0.5).otherwise(F.col("a")).cast("double").alias("a"),
            F.when(F.col("a") == F.col("b"), F.col("b") + 0.5).otherwise(F.col("b")).cast("double").alias("b"),
        ).alias("edges")
    )
    a, step = F.col("edges.a"), (F.col("edges.b") - F.col("edges.a")) / bins
    slot = F.least(F.floor((x - a) / step), F.lit(bins - 1)).cast("int")
    counted = (
        df.where(x.isNotNull()).withColumn("edges", edges.scalar())
        .groupBy(slot.alias("bin")).agg(F.count("*").alias("n"))
    )
    spine = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin")).withColumn("edges", edges.scalar())
    return spine.join(counted, "bin", "left").select(
        "bin", (a + F.col("bin") * step).alias("low"), (a + (F.col("bin") + 1) * step).alias("high"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )


def regression_metrics(df: DataFrame, actual: str = "actual", predicted: str = "predicted") -> DataFrame:
    """One row of forecast scores; percent errors leave out rows whose actual is 0.

    Means come from one aggregate, the two medians from the exact-quantile plan.
    """
    rows = (
        df.select(F.col(actual).cast("double").alias("actual"), F.col(predicted).cast("double").alias("predicted"))
        .where(F.col("actual").isNotNull() & F.col("predicted").isNotNull())
        .withColumns(score.error_columns())
    )
    mse = F.avg(F.col("error") * F.col("error"))
    basic = rows.agg(
        F.count("*").alias("n"),
        mse.alias("mse"),
        F.sqrt(mse).alias("rmse"),
        F.avg("abs_error").alias("mae"),
        (1 - F.try_divide(mse, F.var_pop("actual"))).alias("r2"),
        F.avg("error").alias("mean_error"),
        F.max("error").alias("max_error"),
        F.min("error").alias("min_error"),
        F.avg("abs_error").alias("mean_abs_error"),
        F.avg("percent_error").alias("mean_percent_error"),
    )
    medians = exact_quantiles(rows, ["error", "percent_error"], [0.5])
    both = medians.agg(F.struct(*[
        F.max(F.when(F.col("feature") == c, F.col("value"))).alias(c) for c in ("error", "percent_error")
    ]).alias("m"))
    return (
        basic.withColumn("_m", both.scalar())
        .withColumns({"median_error": F.col("_m.error"), "median_percent_error": F.col("_m.percent_error")})
        .drop("_m")
    )
