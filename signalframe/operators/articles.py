"""Per-record work on the article table: one projection, no shuffle (but for samples)."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from signalframe import config
from signalframe.functions import clock, score, text
from signalframe.plans.running import number_by_range

TIME_NAMES = ("timestamp", "time_bucket", "datetime")
#: Largest pick that a task folds, and the digits of a draw by which a larger one is counted.
TOP_ROWS, DIGITS, _DRAW = 10_000, 4, "_draw"


def numeric_columns(df: DataFrame, skip: Iterable[str] = ()) -> list[str]:
    skip = set(skip)
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType) and f.name not in skip]


def parse_time_column(df: DataFrame, time: str | None = None, names: Sequence[str] = TIME_NAMES) -> DataFrame:
    """Type the time column of a table; rows whose time cannot be read are dropped.

    The first of ``names`` present is used.  If none is, the first string column
    whose value in the first row reads as a time (this looks at one row).
    """
    if time is None:
        time = next((n for n in names if n in df.columns), None)
    if time is None:
        texts = [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]
        row = df.select(*[F.col(f"`{c}`").try_cast("timestamp_ntz").alias(c) for c in texts]).first()
        time = next((c for c in texts if row is not None and row[c] is not None), None)
    if time is None or time not in df.columns:
        raise ValueError(f"no time column among {df.columns}")
    return df.withColumn(time, F.col(f"`{time}`").try_cast("timestamp_ntz")).where(F.col(f"`{time}`").isNotNull())


def missing_columns(df: DataFrame, required: Sequence[str]) -> list[str]:
    return [c for c in required if c not in df.columns]


def conform_columns(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """Project to the required columns; ``theme_x`` may come in another letter case."""
    present = set(df.columns)
    picks, absent = [], []
    for name in required:
        source = name if name in present else None
        if source is None and name.startswith("theme_"):
            stem = name.removeprefix("theme_")
            spellings = (f"theme_{s}" for s in (stem.lower(), stem.upper(), stem.capitalize()))
            source = next((s for s in spellings if s in present), None)
        if source is None:
            absent.append(name)
        else:
            picks.append(F.col(f"`{source}`").alias(name))
    if absent:
        raise ValueError(f"missing required columns: {absent}")
    return df.select(*picks)


def location_filter(
    df: DataFrame, pattern: str = config.PLACE, columns: Sequence[str] = ("Locations", "V2Locations")
) -> DataFrame:
    """Rows where any of the columns matches the pattern, ignoring case."""
    hit = F.lit(False)
    for name in columns:
        hit = hit | F.coalesce(F.col(name).rlike(f"(?i){pattern}"), F.lit(False))
    return df.where(hit)


def add_event_time(df: DataFrame, date: str = "DATE", name: str = "datetime") -> DataFrame:
    """Read the record time; records without a real time are dropped."""
    return df.withColumn(name, text.event_time(date)).where(F.col(name).isNotNull())


def row_sample(df: DataFrame, rows: int, key: str, seed: int | None = None) -> DataFrame:
    """The first ``rows`` rows by key, or with a seed a repeatable random pick of that size.

    The order is a total one (hash, then key), so the pick does not depend on
    partitioning or engine; a null key comes first.  A pick of up to TOP_ROWS
    is folded in each task.  A larger one is selected without a sort into one
    task: draws are counted by their first digits, groups below the one with
    the last place pass whole, and only that group is put in order.  Picks above
    TOP_ROWS run jobs that read the table more than once, so hand in a stored
    table.
    """
    draw = F.md5(F.concat(F.lit(f"{seed}-"), F.col(key).cast("string")))
    if rows <= TOP_ROWS:
        return (df.orderBy(key) if seed is None else df.orderBy(draw, key)).limit(rows)
    if seed is None:
        return _first_by_range(df, [key], rows)
    marked, parts = df.withColumn(_DRAW, F.coalesce(draw, F.lit(""))), []
    for digits in (DIGITS, 2 * DIGITS):  # the group with the last place, then that within it
        prefix = F.substring(_DRAW, 1, digits)
        upto = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        # one row for each value of a few digits, whatever the table's size
        counted = marked.groupBy(prefix.alias("part")).count().withColumn("upto", F.sum("count").over(upto))
        last = counted.where(F.col("upto") >= rows).agg(F.min_by(F.struct("part", (F.col("upto") - F.col("count")).alias("before")), "part").alias("l")).first()["l"]
        if last is None:
            return df
        parts.append(marked.where(prefix < last["part"]))
        marked, rows = marked.where(prefix == last["part"]), rows - last["before"]
    parts.append(_first_by_range(marked, [_DRAW, key], rows))
    return reduce(DataFrame.unionAll, parts).select(df.columns)


def _first_by_range(df: DataFrame, order: Sequence[str], rows: int) -> DataFrame:
    return number_by_range(df, order, name="_place").where(F.col("_place") < rows).drop("_place")


def add_themes(df: DataFrame, source: str = "V2Themes", name: str = "themes") -> DataFrame:
    return df.withColumn(name, text.record_themes(source))


def theme_flags(
    df: DataFrame, themes: str = "themes", categories: Mapping[str, list[str]] = config.THEME_CATEGORIES
) -> DataFrame:
    """Nine 0/1 columns; each theme counts for its first matching category only."""
    found = F.array_distinct(F.transform(F.col(themes), lambda t: text.first_category(t, categories)))
    return (
        df.withColumn("_found", found)
        .withColumns({
            f"theme_{c}": F.coalesce(F.array_contains("_found", c), F.lit(False)).cast("int")
            for c in categories
        })
        .drop("_found")
    )


def tone_metrics(df: DataFrame, source: str = "V2Tone") -> DataFrame:
    """Six leading tone numbers; all six are 0 unless all six can be read."""
    return (
        df.withColumn("_tone", text.tone_parts(source))
        .withColumns({
            f"tone_{m}": F.coalesce(F.get("_tone", F.lit(i)).cast("double"), F.lit(0.0))
            for i, m in enumerate(config.TONE_METRICS)
        })
        .drop("_tone")
    )


def entity_stats(df: DataFrame, source: str = "Counts") -> DataFrame:
    """Sum of entity counts and number of distinct entities per record; an entity's last count wins."""
    return (
        df.withColumn("_entities", text.entity_entries(source))
        .withColumn("_names", F.col("_entities.entity"))
        .withColumn("_entities", text.first_per_entity(F.col("_entities"), F.col("_names")))
        .withColumns({
            "entity_count": text.array_sum(F.col("_entities.n"), "bigint"),
            "entity_variety": F.size("_entities"),
        })
        .drop("_entities", "_names")
    )


def amount_stats(df: DataFrame, source: str = "Amounts") -> DataFrame:
    """Mean, maximum and number of the amounts of a record; zeros when it has none."""
    some = F.size("_amounts") > 0
    return (
        df.withColumn("_amounts", text.amount_values(source))
        .withColumns({
            "avg_amount": F.when(some, text.array_sum(F.col("_amounts"), "double") / F.size("_amounts"))
            .otherwise(0.0),
            "max_amount": F.when(some, F.array_max("_amounts")).otherwise(0.0),
            "amount_count": F.size("_amounts"),
        })
        .drop("_amounts")
    )


def add_impact_score(df: DataFrame, name: str = "energy_impact_score") -> DataFrame:
    return df.withColumn(name, score.impact_score())


def context_tags(df: DataFrame, themes: str = "themes", parity: bool = True) -> DataFrame:
    return df.withColumns(score.context_flags(themes, parity))


def amount_interactions(df: DataFrame) -> DataFrame:
    """Theme flag times mean amount for three categories, and one article per row."""
    return df.withColumns({
        "article_count": F.lit(1),
        "energy_amount": F.col("theme_Energy") * F.col("avg_amount"),
        "infrastructure_amount": F.col("theme_Infrastructure") * F.col("avg_amount"),
        "environment_amount": F.col("theme_Environment") * F.col("avg_amount"),
    })


def enrich_articles(df: DataFrame, contexts: bool | None = None, parity: bool = True) -> DataFrame:
    """All per-record features of an article table.

    Context flags are added when the table has a ``V2FullNames`` or ``TEXT``
    column, or on request.
    """
    absent = missing_columns(df, config.PARSER_COLUMNS)
    if absent:
        raise ValueError(f"missing required columns: {absent}")
    if contexts is None:
        contexts = bool({"V2FullNames", "TEXT"} & set(df.columns))
    out = add_themes(add_event_time(df))
    out = amount_stats(entity_stats(tone_metrics(theme_flags(out))))
    out = amount_interactions(add_impact_score(out))
    return context_tags(out, parity=parity) if contexts else out


def select_features(df: DataFrame, keep: Sequence[str] = config.FEATURE_COLUMNS) -> DataFrame:
    """The kept columns that exist, in the given order."""
    present = set(df.columns)
    return df.select(*[F.col(f"`{c}`") for c in keep if c in present])


def add_calendar(df: DataFrame, time: str = "time_bucket") -> DataFrame:
    return df.withColumns(clock.calendar_columns(time))


def add_model_time(df: DataFrame, time: str) -> DataFrame:
    return df.withColumns(clock.model_time_columns(time))


def add_day_period(df: DataFrame, time: str = "datetime", name: str = "time_period") -> DataFrame:
    return df.withColumn(name, clock.day_period(F.hour(time)))


def crisis_indicators(df: DataFrame) -> DataFrame:
    """Composite indicators of an aggregated news table, with their fallbacks."""
    have = set(df.columns)

    def has(*names: str) -> bool:
        return have.issuperset(names)

    def c(name: str):
        return F.col(name)

    zero = F.lit(0.0)
    if "article_count" not in have:
        df = df.withColumn("article_count", F.lit(1))
    volatility = c("tone_tone_max") - c("tone_tone_min") if has("tone_tone_max", "tone_tone_min") else zero
    out = {"tone_volatility": volatility}
    if has("theme_Energy_sum", "avg_amount_sum"):
        out["energy_event_magnitude"] = c("theme_Energy_sum") * F.log1p("avg_amount_sum")
    elif has("theme_Energy_sum"):
        out["energy_event_magnitude"] = (c("theme_Energy_sum") * c("article_count")).cast("double")
    if has("energy_impact_score_sum"):
        out["energy_impact_index"] = c("energy_impact_score_sum")

    def product(theme: str, other: str | None, factor, fallback: float | None = None):
        theme = f"theme_{theme}_sum"
        if has(theme) and (other is None or has(other)):
            return c(theme) * factor
        return c(theme) * fallback if fallback is not None and has(theme) else zero

    negative = c("tone_negative_max")
    out["energy_crisis_indicator"] = product("Energy", "tone_negative_max", negative, 0.5)
    out["weather_alert_indicator"] = product(
        "Environment", "tone_tone_min", F.abs(F.col("tone_tone_min")) if has("tone_tone_min") else zero, 0.5)
    out["social_event_indicator"] = product("Social", None, c("article_count")) / 100
    out["infrastructure_stress"] = product("Infrastructure", "tone_negative_max", negative)
    out["political_crisis_indicator"] = product("Political", "tone_negative_max", negative)
    out["economic_impact_indicator"] = product("Economic", None, volatility)
    return df.withColumns(out)


def context_indicators(df: DataFrame) -> DataFrame:
    """Indicators from summed context flags; only those whose inputs exist."""
    have = set(df.columns)
    volatility = (
        F.col("tone_volatility") if "tone_volatility" in have
        else F.col("tone_tone_max") - F.col("tone_tone_min")
    )
    rules = [
        ("supply_disruption_indicator", "energy_supply_sum", lambda: F.col("tone_negative_max")),
        ("demand_spike_indicator", "energy_demand_sum", lambda: F.col("article_count")),
        ("price_volatility_indicator", "energy_price_sum", lambda: volatility),
        ("infrastructure_failure_indicator", "energy_infrastructure_sum", lambda: F.col("tone_negative_max")),
        ("weather_impact_indicator", "weather_event_sum", lambda: F.lit(1)),
    ]
    return df.withColumns({
        name: F.col(source) * factor() for name, source, factor in rules if source in have
    })


def prediction_errors(df: DataFrame, actual: str = "actual", predicted: str = "predicted") -> DataFrame:
    return df.withColumns(score.error_columns(actual, predicted))
