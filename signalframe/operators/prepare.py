"""Train/test splits, scaling and input sequences for forecasting.

Random choices are md5 draws on a seed and the row's own key, so a split does
not depend on partitioning and can be repeated in any engine.  A split is a
``part`` column on one table, not two copies.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from signalframe import config
from signalframe.functions import clock
from signalframe.plans.ordered import number_rows, trailing_windows

STAMP = "yyyy-MM-dd HH:mm:ss"


def part_label(is_test: Column) -> Column:
    return F.when(is_test, "test").otherwise("train")


def split_month_based(df: DataFrame, time: str, fraction: float = config.TEST_FRACTION,
                      seed: int = config.SEED, name: str = "part") -> DataFrame:
    """Per year, max(1, int(fraction * months)) drawn months are test.

    The month table has one row per calendar month, so it can be broadcast
    whatever the size of the series.
    """
    chosen = test_months(df, time, fraction, seed)
    marked = df.withColumns({"_year": F.year(time), "_month": F.month(time)})
    return (
        marked.join(F.broadcast(chosen.withColumn("_test", F.lit(True))), ["_year", "_month"], "left")
        .withColumn(name, part_label(F.coalesce("_test", F.lit(False))))
        .drop("_year", "_month", "_test")
    )


def test_months(df: DataFrame, time: str, fraction: float = config.TEST_FRACTION,
                seed: int = config.SEED) -> DataFrame:
    """(_year, _month) of the drawn test months."""
    months = df.where(F.col(time).isNotNull()).select(
        F.year(time).alias("_year"), F.month(time).alias("_month")).distinct()
    draw = F.md5(F.concat_ws("-", F.lit(str(seed)), F.col("_year").cast("string"), F.col("_month").cast("string")))
    per_year = Window.partitionBy("_year")
    ranked = months.withColumns({
        "_rank": F.row_number().over(per_year.orderBy(draw)),
        "_months": F.count("*").over(per_year),
    })
    wanted = F.greatest(F.lit(1), F.floor(F.col("_months") * F.lit(fraction)))
    return ranked.where(F.col("_rank") <= wanted).select("_year", "_month")


def split_random(df: DataFrame, time: str, fraction: float = config.TEST_FRACTION,
                 seed: int = config.SEED, name: str = "part") -> DataFrame:
    """Each row is test with the given probability; no shuffle."""
    draw = F.substring(F.md5(F.concat(F.lit(f"{seed}-"), F.date_format(time, STAMP))), 1, 8)
    limit = format(int(fraction * 16**8), "08x")
    return df.withColumn(name, part_label(F.coalesce(draw < limit, F.lit(False))))


def split_seasonal_block(df: DataFrame, time: str, fraction: float = config.TEST_FRACTION,
                         name: str = "part") -> DataFrame:
    """Per year and season, a run of int(fraction * n) rows from the middle is test."""
    groups = ["_year", "_season"]
    marked = df.withColumns({"_year": F.year(time), "_season": clock.season_code(time)})
    sizes = marked.groupBy(*groups).agg(F.count("*").alias("_n"))
    block = F.floor(F.col("_n") * F.lit(fraction))
    first = F.floor(F.col("_n") / 2) - F.floor(block / 2)
    # one row per year and season: bounded by the calendar, safe to broadcast
    numbered = number_rows(marked, time, groups, "_row").join(F.broadcast(sizes), groups)
    inside = (F.col("_row") >= first) & (F.col("_row") < first + block)
    return numbered.withColumn(name, part_label(inside)).drop(*groups, "_row", "_n")


SPLITS = {
    "month_based": split_month_based,
    "fully_random": split_random,
    "seasonal_block": split_seasonal_block,
}


def split_metadata(split: DataFrame, time: str, strategy: str) -> DataFrame:
    """(strategy, part, year, season, month, rows): what a split put where."""
    code = clock.season_code(time)
    return (
        split.select("part", F.year(time).alias("year"), clock.season_name(code).alias("season"), F.month(time).alias("month"))
        .groupBy("part", "year", "season", "month").agg(F.count("*").alias("rows"))
        .select(F.lit(strategy).alias("strategy"), "part", "year", "season", "month", "rows")
    )


def split_union_keys(train: DataFrame, test: DataFrame, time: str) -> DataFrame:
    """Distinct union of the time keys of both parts."""
    return train.select(time).union(test.select(time)).distinct()


def split_month_profile(split: DataFrame, time: str) -> DataFrame:
    """(month, train, test) rows per calendar month 1-12, zeros kept."""
    counted = split.groupBy(F.month(time).alias("month")).pivot("part", ["train", "test"]).agg(F.count(F.lit(1)))
    months = split.sparkSession.range(1, 13).select(F.col("id").cast("int").alias("month"))
    return months.join(counted, "month", "left").fillna(0, subset=["train", "test"])


def fit_scalers(split: DataFrame, features: Sequence[str], target: str, strategy: str = "default") -> DataFrame:
    """(strategy, feature, role, shift, width) fitted on the train rows only.

    Features: mean and population spread, a spread of 0 becomes 1.  Target:
    minimum and range, a range of 0 becomes 1.
    """
    train = F.col("part") == "train"

    def pick(c: str) -> Column:
        return F.when(train, F.col(f"`{c}`").cast("double"))

    def safe(width: Column) -> Column:
        return F.when(width == 0, 1.0).otherwise(width)

    parts = [
        F.struct(F.lit(c).alias("feature"), F.lit("feature").alias("role"), F.avg(pick(c)).alias("shift"),
                 F.when(F.min(pick(c)) == F.max(pick(c)), 1.0).otherwise(safe(F.stddev_pop(pick(c)))).alias("width"))
        for c in features
    ]
    parts.append(F.struct(F.lit(target).alias("feature"), F.lit("target").alias("role"), F.min(pick(target)).alias("shift"),
                          safe(F.max(pick(target)) - F.min(pick(target))).alias("width")))
    one = split.agg(*[p.alias(f"p{i}") for i, p in enumerate(parts)])
    return one.select(F.inline(F.array(*[f"p{i}" for i in range(len(parts))]))).select(
        F.lit(strategy).alias("strategy"), "feature", "role", "shift", "width")


def apply_scalers(split: DataFrame, scalers: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(value - shift) / width for the given columns, train and test alike."""
    wide = scalers.agg(F.struct(*[
        F.struct(F.max(F.when(F.col("feature") == c, F.col("shift"))).alias("shift"),
                 F.max(F.when(F.col("feature") == c, F.col("width"))).alias("width")).alias(f"s{i}")
        for i, c in enumerate(columns)
    ]).alias("s"))
    scaled = {c: ((F.col(f"`{c}`").cast("double") - F.col(f"_scale.s{i}.shift")) / F.col(f"_scale.s{i}.width")).alias(c)
              for i, c in enumerate(columns)}
    return split.withColumn("_scale", wide.scalar()).select(*[scaled.get(c, F.col(f"`{c}`")) for c in split.columns])


def standard_scale(split: DataFrame, features: Sequence[str], target: str) -> DataFrame:
    """Features scaled by the train mean and population spread."""
    return apply_scalers(split, fit_scalers(split, features, target), features)


def minmax_target(split: DataFrame, target: str) -> DataFrame:
    """Target scaled to the train range."""
    return apply_scalers(split, fit_scalers(split, [], target), [target])


def scale_split(split: DataFrame, features: Sequence[str], target: str) -> DataFrame:
    """Features and target scaled with one fitting pass."""
    return apply_scalers(split, fit_scalers(split, features, target), [*features, target])


def sequence_windows(df: DataFrame, time: str, features: Sequence[str], target: str,
                     rows: int = config.SEQUENCE_ROWS, keys: Sequence[str] = (), max_gap: str | None = None) -> DataFrame:
    """(keys, time, sequence, target): the preceding ``rows`` feature rows of every row that has them.

    ``keys`` keeps sequences inside one series.  With ``max_gap``, such as
    "1 day", a sequence that steps over a longer hole, between its rows or to
    its target, is left out; without it sequences cross the holes that a split
    leaves.
    """
    step = F.array(*[F.col(f"`{c}`").cast("double") for c in features])
    numbered = number_rows(df.select(*keys, time, step.alias("_step"), F.col(f"`{target}`").alias("target")), time, keys, "_row")

    def build(w):
        made = {"sequence": F.collect_list("_step").over(w.rowsBetween(-rows, -1))}
        return made | ({"_times": F.collect_list(clock.epoch_seconds(time)).over(w.rowsBetween(-rows, 0))} if max_gap else {})

    framed = trailing_windows(numbered, "_row", rows, build, keys).where(F.size("sequence") == rows)
    if max_gap:
        near = F.forall(F.sequence(F.lit(1), F.lit(rows)), lambda k: F.get("_times", k) - F.get("_times", k - 1) <= clock.width_seconds(max_gap))
        framed = framed.where(near)
    return framed.select(*keys, time, "sequence", "target")


def unscale(df: DataFrame, scalers: DataFrame, target: str, columns: Sequence[str]) -> DataFrame:
    """Scaled target values (actual or predicted columns) back in the units of ``target``."""
    edges = scalers.where((F.col("feature") == target) & (F.col("role") == "target")).agg(
        F.struct(F.max("shift").alias("shift"), F.max("width").alias("width")).alias("s"))
    back = {c: (F.col(c) * F.col("_scale.width") + F.col("_scale.shift")).alias(c) for c in columns}
    return df.withColumn("_scale", edges.scalar()).select(*[back.get(c, F.col(f"`{c}`")) for c in df.columns])
