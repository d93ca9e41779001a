"""Theme counts.  Mentions are counted map-side first, so a theme that makes up
a third of all mentions costs one row per task in the shuffle."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from signalframe import config
from signalframe.functions import clock, text


def theme_column(df: DataFrame) -> str:
    for name in ("V2Themes", "Themes"):
        if name in df.columns:
            return name
    raise ValueError("the table has no theme column")


def theme_counts(df: DataFrame, column: str | None = None) -> DataFrame:
    """(theme, n): mentions of each raw theme over the whole table."""
    mentions = df.select(F.explode(text.theme_mentions(column or theme_column(df))).alias("theme"))
    return mentions.groupBy("theme").agg(F.count("*").alias("n"))


def spread_columns(row: DataFrame, names: Mapping[str, str], label: str, value: str, keys: Sequence[str] = ()) -> DataFrame:
    """Turn named columns into (label, value) rows."""
    pairs = [F.struct(F.lit(shown).alias(label), F.col(f"`{c}`").alias(value)) for c, shown in names.items()]
    return row.select(*keys, F.inline(F.array(*pairs)))


def category_counts(
    counts: DataFrame, categories: Mapping[str, list[str]] = config.THEME_CATEGORIES
) -> DataFrame:
    """(category, n, pct) from a theme count table; every category is listed, 0 included."""
    named = counts.select(F.lower("theme").alias("name"), "n")
    marked = named.select(text.first_category(F.col("name"), categories).alias("category"), "n")
    sums = marked.agg(*[
        F.coalesce(F.sum(F.when(F.col("category") == c, F.col("n"))), F.lit(0)).alias(c) for c in categories
    ])
    total = F.col("total")
    rows = sums.withColumn("total", sum((F.col(c) for c in categories), F.lit(0)))
    return (
        spread_columns(rows, {c: c for c in categories}, "category", "n", ["total"])
        .select("category", "n", F.coalesce(F.try_divide(F.col("n") * 100, total), F.lit(0.0)).alias("pct"))
    )


def keyword_themes(counts: DataFrame, words: Sequence[str] = config.ENERGY_KEYWORDS) -> DataFrame:
    """Themes that contain any of the words, most frequent first."""
    return (
        counts.where(text.contains_any(F.upper("theme"), words)).orderBy(F.desc("n"), "theme")
    )


def top_themes(counts: DataFrame, rows: int) -> DataFrame:
    return counts.orderBy(F.desc("n"), "theme").limit(rows)


def flag_category_sums(
    df: DataFrame, time: str | None = None, categories: Sequence[str] = config.CATEGORIES
) -> DataFrame:
    """(period, category, n) from the 0/1 flags of parsed articles, plus period ``All``."""
    flags = {f"theme_{c}": c for c in categories if f"theme_{c}" in df.columns}
    sums = [F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in flags]
    if time is None:
        return spread_columns(df.agg(*sums).withColumn("period", F.lit("All")), flags, "category", "n", ["period"])
    periods = df.select(clock.day_period(F.hour(time)).alias("period"), *flags)
    rolled = periods.rollup("period").agg(*sums, F.grouping("period").alias("_all"))
    named = rolled.withColumn("period", F.when(F.col("_all") == 1, "All").otherwise(F.col("period"))).where(
        F.col("period").isNotNull())
    return spread_columns(named, flags, "category", "n", ["period"])


def period_category_counts(
    df: DataFrame,
    time: str = "datetime",
    column: str | None = None,
    categories: Mapping[str, list[str]] = config.THEME_CATEGORIES,
) -> DataFrame:
    """(period, category, n) from raw theme text; rows without a time are left out.

    Mentions are counted by theme and period in each task, and each distinct
    name is put into its category once, whatever the number of its mentions.
    The last sum holds nine counts per period.
    """
    found = df.where(F.col(time).isNotNull()).select(
        clock.day_period(F.hour(time)).alias("period"), text.theme_mentions(column or theme_column(df)).alias("_mentions"))
    # a period without mentions is listed too: its one null name has no category
    names = found.select("period", F.explode_outer("_mentions").alias("name"))
    counted = names.groupBy("period", F.lower("name").alias("name")).agg(F.count("name").alias("n"))
    marked = counted.select("period", text.first_category(F.col("name"), categories).alias("category"), "n")
    sums = marked.groupBy("period").agg(*[
        F.coalesce(F.sum(F.when(F.col("category") == c, F.col("n"))), F.lit(0)).alias(c) for c in categories])
    return spread_columns(sums, {c: c for c in categories}, "category", "n", ["period"])


def period_category_pivot(counts: DataFrame, periods: Sequence[str] = tuple(config.DAY_PERIODS)) -> DataFrame:
    """Category by period shares (each period adds to 1), row total and its rank.

    The last step is a window over one row per category.
    """
    pivot = counts.groupBy("category").pivot("period", list(periods)).agg(F.sum("n"))
    whole, ranked = Window.partitionBy(), Window.orderBy(F.desc("total"), "category")
    filled = pivot.withColumn("total", sum((F.coalesce(F.col(p), F.lit(0)) for p in periods), F.lit(0)))
    return filled.select(
        "category",
        *[F.try_divide(F.col(p), F.sum(p).over(whole)).alias(p) for p in periods],
        "total",
        F.row_number().over(ranked).alias("rank"),
    )
