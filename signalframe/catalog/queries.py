"""One query per operator, each over whole derived tables.

Numbers are rounded to six places so that engines can be compared.
"""

from __future__ import annotations

import io
import zipfile
from collections.abc import Callable

import pandas as pd
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from signalframe import config
from signalframe.catalog import fixtures as fx
from signalframe.functions import clock, text
from signalframe.operators import articles, buckets, correlate, forecast, joins, prepare, profile, series, themes
from signalframe.plans import flows
from signalframe.plans.ordered import number_rows, trailing_windows
from signalframe.plans.staging import new_folder, spread, stage
from signalframe.sources import archives, files, folders, manifest
from signalframe.streaming import intervals, records

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ID = "GKGRECORDID"
FLAGS = [f"theme_{c}" for c in config.CATEGORIES]
TONES = [f"tone_{m}" for m in config.TONE_METRICS]
TARGET = "Power demand_sum"


def rounded(df: DataFrame, places: int = 6) -> DataFrame:
    return df.select(*[
        F.round(F.col(f"`{f.name}`"), places).alias(f.name) if isinstance(f.dataType, T.DoubleType) else F.col(f"`{f.name}`")
        for f in df.schema
    ])


def query(run: Query | None = None, *, places: int = 6):
    """Register a query under its function name."""
    if run is None:
        return lambda f: query(f, places=places)
    QUERIES[run.__name__] = lambda spark, sf_dir: rounded(run(spark, sf_dir), places)
    return run


# --- inputs -------------------------------------------------------------------

def enriched(spark, sf_dir, place: bool = False) -> DataFrame:
    rows = fx.articles_table(spark, sf_dir)
    # the test tables are files of a single row group: deal their rows to all cores
    rows = spread(articles.location_filter(rows) if place else rows, spark.sparkContext.defaultParallelism)
    return articles.enrich_articles(rows)


def news_buckets(spark, sf_dir) -> DataFrame:
    return stage(buckets.bucket_news(enriched(spark, sf_dir, place=True)), "news")


def weather_buckets(spark, sf_dir) -> DataFrame:
    return buckets.bucket_weather(fx.weather_table(spark, sf_dir))


def merged_buckets(spark, sf_dir) -> DataFrame:
    news = buckets.bucket_news(enriched(spark, sf_dir, place=True))
    return joins.merge_zero_filled(weather_buckets(spark, sf_dir), news, "timestamp", "time_bucket")


def daily(spark, sf_dir) -> DataFrame:
    return stage(fx.daily_table(spark, sf_dir), "daily")


def daily_split(spark, sf_dir, strategy: str = "month_based") -> DataFrame:
    return prepare.SPLITS[strategy](daily(spark, sf_dir), "ts")


def predictions(spark, sf_dir) -> DataFrame:
    """The range-scaled target and, as a stand-in forecast, its previous day's value."""
    rows = daily(spark, sf_dir)
    edges = rows.agg(F.struct(F.min("target").alias("a"), F.max("target").alias("b")).alias("edges"))
    actual = (F.col("target") - F.col("edges.a")) / (F.col("edges.b") - F.col("edges.a"))
    scaled = rows.withColumn("edges", edges.scalar()).select("ts", actual.alias("actual"))
    shifted = trailing_windows(
        number_rows(scaled, "ts"), "row_no", 1, lambda w: {"predicted": F.lag("actual", 1).over(w)})
    return shifted.where(F.col("predicted").isNotNull()).drop("row_no")


# --- scans, sources, sinks ------------------------------------------------------

def raw_lines(rows: DataFrame, *more) -> DataFrame:
    """Articles as the lines of a raw file."""
    cells = [F.coalesce(F.col(c), F.lit("")) for c in config.RAW_COLUMNS]
    return fx.raw_records(rows, *more).select(F.concat_ws("\t", *cells).alias("value"), *[F.col("name")] * len(more))


def write_archives(rows: DataFrame, stamp: Column, folder: str) -> None:
    """Articles as the zip files that the source publishes: one for each ``stamp``, written where the rows are."""
    lines = raw_lines(rows, stamp.alias("name"))

    def write(group: pd.DataFrame) -> pd.DataFrame:
        store, where = fs.FileSystem.from_uri(folder)
        name, buffer = f"{group['name'].iloc[0]}.gkg.csv", io.BytesIO()
        with zipfile.ZipFile(buffer, "w") as archive:
            archive.writestr(name, "\n".join(group["value"]) + "\n")
        store.create_dir(where)
        with store.open_output_stream(f"{where}/{name}.zip") as out:
            out.write(buffer.getvalue())
        return pd.DataFrame({"name": [name]})

    lines.groupBy("name").applyInPandas(write, "name string").write.format("noop").mode("overwrite").save()


@query
def scan_gkg_tsv(spark, sf_dir):
    folder = new_folder(spark, "tsv")
    raw_lines(fx.articles_table(spark, sf_dir)).write.text(folder)
    return files.scan_gkg_tsv(spark, folder)


@query
def scan_gkg_zip(spark, sf_dir):
    folder = new_folder(spark, "zip")
    quarter = F.lpad((F.pmod(F.xxhash64(ID), F.lit(4)) * 1500).cast("string"), 4, "0")  # four archives an hour of arrival
    write_archives(fx.articles_table(spark, sf_dir), F.concat(F.substring(ID, 1, 10), quarter), folder)
    return archives.scan_gkg_zip(spark, folder)


@query
def scan_csv_table(spark, sf_dir):
    folder, rows = new_folder(spark, "csv"), fx.daily_table(spark, sf_dir)
    files.write_table(rows, folder, format="csv")
    return files.scan_csv_table(spark, folder, "ts string, n bigint, target double, b double, c double", "ts")


@query
def parse_time_column(spark, sf_dir):
    rows = fx.weather_table(spark, sf_dir)
    as_text = rows.withColumn("datetime", F.when(F.col("dwpt") != 7, F.date_format("datetime", "yyyy-MM-dd HH:mm:ss")).otherwise("not a time"))
    return articles.parse_time_column(as_text).select("datetime", F.col("Power demand").alias("power"), "temp")


@query
def conform_columns(spark, sf_dir):
    rows = articles.theme_flags(articles.add_themes(articles.add_event_time(fx.articles_table(spark, sf_dir))))
    odd = rows.withColumnsRenamed({"theme_Energy": "theme_ENERGY", "theme_Social": "theme_social"})
    return articles.conform_columns(odd, ["datetime", ID, *[f"theme_{c}" for c in config.LOAD_CATEGORIES]])


@query
def union_batches(spark, sf_dir):
    rows = fx.articles_table(spark, sf_dir).select(ID, "DATE", "V2Tone", "Counts", "V2Locations")
    india, france = F.col("V2Locations").isNotNull(), F.col("V2Locations").isNull()
    batches = [rows.where(india).select(ID, "DATE", "V2Tone"), rows.where(france).select("Counts", "DATE", ID), rows.select(ID, "V2Locations")]
    folder = new_folder(spark, "batches")
    for batch in batches:
        files.write_table(batch, folder, "append", "csv")
    found, _ = folders.scan_csv_folder(spark, folder, "DATE string, V2Tone string, Counts string, V2Locations string")
    return found.select(ID, "DATE", "V2Tone", "Counts", "V2Locations")


@query
def interval_manifest(spark, sf_dir):
    return manifest.interval_manifest(manifest.table_bounds(fx.table(spark, sf_dir, "events"), "ts"))


@query
def batch_plan(spark, sf_dir):
    return manifest.batch_plan(manifest.table_bounds(fx.table(spark, sf_dir, "orders"), "o_orderdate"))


def batch_names(spark, sf_dir) -> DataFrame:
    spans = fx.table(spark, sf_dir, "orders").groupBy("o_custkey").agg(
        F.min("o_orderdate").alias("a"), F.max("o_orderdate").alias("b"))
    end = F.when(F.col("o_custkey") % 5 == 0, "20990230").otherwise(F.date_format("b", "yyyyMMdd"))
    return spans.select(F.concat(F.lit("batch_"), F.date_format("a", "yyyyMMdd"), F.lit("_to_"), end, F.lit(".csv")).alias("file_name"))


@query
def resume_point(spark, sf_dir):
    return manifest.resume_point(batch_names(spark, sf_dir))


@query
def pending_files(spark, sf_dir):
    wanted = manifest.interval_manifest(manifest.table_bounds(fx.table(spark, sf_dir, "events"), "ts"))
    folder, table = new_folder(spark, "zip"), new_folder(spark, "landed")
    located = articles.add_event_time(articles.location_filter(fx.articles_table(spark, sf_dir)))
    write_archives(located, F.date_format(clock.interval_start("datetime"), "yyyyMMddHHmmss"), folder)
    archives.land(spark, folder, table)
    return manifest.pending_files(wanted, archives.read_ledger(spark, table))


@query
def write_table(spark, sf_dir):
    folder, rows = new_folder(spark, "written"), fx.daily_table(spark, sf_dir)
    labelled = rows.withColumn("year", F.year("ts"))
    files.write_table(labelled, folder, partition_by=["year"])
    files.write_table(labelled.where(F.col("b").isNotNull()), folder, mode="append", partition_by=["year"])
    return spark.read.parquet(folder).select("ts", "n", "target", "b", F.col("year").cast("int").alias("year"))


def stored_splits(spark, sf_dir) -> str:
    folder, rows = new_folder(spark, "splits"), daily(spark, sf_dir)
    for run, strategy in (("20240101_000000", "month_based"), ("20240102_000000", "month_based"),
                          ("20240101_000000", "fully_random")):
        files.write_split_tables(prepare.SPLITS[strategy](rows, "ts"), folder, strategy, run, "ts")
        files.write_split_tables(prepare.SPLITS[strategy](rows, "ts"), folder, strategy, run, "ts")  # a re-run replaces
    return folder


@query
def write_split_tables(spark, sf_dir):
    return files.read_split_tables(spark, stored_splits(spark, sf_dir)).select("strategy", "run", "part", "ts", "n", "target")


@query
def latest_run(spark, sf_dir):
    return files.latest_run(spark, stored_splits(spark, sf_dir)).select("strategy", "run", "part", "ts", "n", "target")


# --- per-record work --------------------------------------------------------------

@query
def location_filter(spark, sf_dir):
    return articles.location_filter(fx.articles_table(spark, sf_dir)).select(ID, "Locations", "V2Locations")


@query
def event_time(spark, sf_dir):
    return articles.add_event_time(fx.articles_table(spark, sf_dir)).select(ID, "DATE", "datetime")


@query
def row_sample(spark, sf_dir):
    rows = fx.articles_table(spark, sf_dir).select(ID, "DATE")
    first = articles.row_sample(rows, 500, ID).withColumn("kind", F.lit("first"))
    return first.unionAll(articles.row_sample(rows, 500, ID, seed=config.SEED).withColumn("kind", F.lit("random")))


@query
def row_sample_half(spark, sf_dir):
    """Half of a table, more than one task should put in order."""
    rows = stage(fx.table(spark, sf_dir, "lineitem").select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("line"), "l_partkey"))
    return articles.row_sample(rows, rows.count() // 2, "line", seed=config.SEED)


@query
def record_themes(spark, sf_dir):
    rows = articles.add_themes(fx.articles_table(spark, sf_dir))
    return rows.select(ID, F.explode("themes").alias("theme"))


@query
def theme_flags(spark, sf_dir):
    return articles.theme_flags(articles.add_themes(fx.articles_table(spark, sf_dir))).select(ID, *FLAGS)


@query
def tone_metrics(spark, sf_dir):
    return articles.tone_metrics(fx.articles_table(spark, sf_dir)).select(ID, *TONES)


@query
def entity_counts(spark, sf_dir):
    return articles.entity_stats(fx.articles_table(spark, sf_dir)).select(ID, "entity_count", "entity_variety")


@query
def amount_stats(spark, sf_dir):
    return articles.amount_stats(fx.articles_table(spark, sf_dir)).select(ID, "avg_amount", "max_amount", "amount_count")


@query
def impact_score(spark, sf_dir):
    return enriched(spark, sf_dir).select(ID, "energy_impact_score")


@query
def context_tags(spark, sf_dir):
    rows = articles.add_themes(fx.articles_table(spark, sf_dir))
    flags = [F.col(c) for c in config.CONTEXTS]
    parity = articles.context_tags(rows).select(ID, F.lit(True).alias("parity"), *flags)
    return parity.unionAll(articles.context_tags(rows, parity=False).select(ID, F.lit(False).alias("parity"), *flags))


@query
def amount_interactions(spark, sf_dir):
    return enriched(spark, sf_dir).select(ID, "article_count", "energy_amount", "infrastructure_amount", "environment_amount")


@query
def select_features(spark, sf_dir):
    bucketed = buckets.bucket_news(enriched(spark, sf_dir, place=True))
    return articles.select_features(articles.add_calendar(articles.crisis_indicators(bucketed)))


@query
def calendar_features(spark, sf_dir):
    rows = fx.table(spark, sf_dir, "events").select("event_id", "ts")
    return articles.add_calendar(rows, "ts")


@query
def model_time_features(spark, sf_dir):
    return articles.add_model_time(fx.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate"), "o_orderdate")


@query
def day_period(spark, sf_dir):
    rows = articles.add_event_time(fx.articles_table(spark, sf_dir))
    return articles.add_day_period(rows).groupBy("time_period").agg(F.count("*").alias("n"))


INDICATORS = ["tone_volatility", "energy_event_magnitude", "energy_impact_index", "energy_crisis_indicator",
              "weather_alert_indicator", "social_event_indicator", "infrastructure_stress",
              "political_crisis_indicator", "economic_impact_indicator"]


@query
def crisis_indicators(spark, sf_dir):
    full = buckets.bucket_news(enriched(spark, sf_dir, place=True))
    return articles.crisis_indicators(full).select("time_bucket", *INDICATORS)


@query
def crisis_indicators_fallback(spark, sf_dir):
    rows = articles.theme_flags(articles.add_themes(articles.add_event_time(fx.articles_table(spark, sf_dir))))
    bare = buckets.bucket_news(rows.select("datetime", "theme_Energy", "theme_Environment"))
    return articles.crisis_indicators(bare).select("time_bucket", *[c for c in INDICATORS if c != "energy_impact_index"])


@query
def context_indicators(spark, sf_dir):
    rows = articles.enrich_articles(fx.articles_table(spark, sf_dir), contexts=True, parity=False)
    return articles.context_indicators(buckets.bucket_news(rows)).select(
        "time_bucket", "supply_disruption_indicator", "demand_spike_indicator", "price_volatility_indicator",
        "infrastructure_failure_indicator", "weather_impact_indicator")


@query
def prediction_errors(spark, sf_dir):
    return articles.prediction_errors(predictions(spark, sf_dir))


# --- joins --------------------------------------------------------------------------

def news_side(spark, sf_dir) -> DataFrame:
    news = buckets.bucket_news(enriched(spark, sf_dir, place=True))
    return news.select("time_bucket", "article_count", "theme_Energy_sum", F.col("tone_tone_mean").alias("temp_mean"))


@query
def merge_on_time(spark, sf_dir):
    news, weather = stage(news_side(spark, sf_dir), "news"), stage(weather_buckets(spark, sf_dir), "weather")
    return joins.merge_on_time(news, weather, "time_bucket", "timestamp")


@query
def range_overlap(spark, sf_dir):
    return joins.range_overlap(news_side(spark, sf_dir), weather_buckets(spark, sf_dir), "time_bucket", "timestamp")


@query
def merge_zero_filled(spark, sf_dir):
    news = buckets.bucket_news(enriched(spark, sf_dir, place=True)).select(
        "time_bucket", "article_count", "tone_tone_std", F.col("tone_tone_mean").alias("temp_mean"))
    return joins.merge_zero_filled(weather_buckets(spark, sf_dir), news, "timestamp", "time_bucket")


@query
def densify_spine(spark, sf_dir):
    news = stage(news_side(spark, sf_dir))
    return series.densify_spine(news)


@query
def new_records(spark, sf_dir):
    rows = fx.articles_table(spark, sf_dir).select(ID, "DATE", "V2Tone")
    stored = articles.add_event_time(articles.location_filter(fx.articles_table(spark, sf_dir)))
    return joins.new_records(rows, stored)


# --- aggregations --------------------------------------------------------------------

@query
def bucket_news_15min(spark, sf_dir):
    rows = articles.enrich_articles(articles.location_filter(fx.articles_table(spark, sf_dir)), contexts=True)
    return buckets.bucket_news(rows)


@query
def merge_partials(spark, sf_dir):
    rows = enriched(spark, sf_dir).withColumn("batch", F.coalesce(F.substring("Locations", 1, 1), F.lit("-")))
    columns = ["tone_tone", "avg_amount"]
    parts = buckets.partial_rollup(rows, "datetime", columns, keys=["batch"])
    return buckets.merge_partials(parts, columns, width="1 hour")


@query
def bucket_weather_15min(spark, sf_dir):
    rows = fx.weather_table(spark, sf_dir).withColumns({"hour": F.hour("datetime"), "cloud": F.col("pres") - F.col("temp")})
    return buckets.bucket_weather(rows)


def theme_table(spark, sf_dir) -> DataFrame:
    return themes.theme_counts(fx.articles_table(spark, sf_dir))


@query
def theme_counts(spark, sf_dir):
    return theme_table(spark, sf_dir)


@query
def wordy_theme_counts(spark, sf_dir):
    return themes.theme_counts(fx.derive(spark, sf_dir, fx.WORDY, "documents"))


@query
def wordy_category_counts(spark, sf_dir):
    return themes.category_counts(stage(wordy_theme_counts(spark, sf_dir), "wordy"))


@query
def unique_themes(spark, sf_dir):
    return theme_table(spark, sf_dir).agg(F.count("*").alias("themes"), F.sum("n").alias("mentions"))


@query
def category_counts(spark, sf_dir):
    return themes.category_counts(theme_table(spark, sf_dir))


@query
def keyword_themes(spark, sf_dir):
    return themes.keyword_themes(theme_table(spark, sf_dir))


@query
def flag_category_sums(spark, sf_dir):
    return themes.flag_category_sums(enriched(spark, sf_dir), "datetime")


def period_counts(spark, sf_dir) -> DataFrame:
    rows = fx.articles_table(spark, sf_dir).withColumn("datetime", text.event_time("DATE"))
    return themes.period_category_counts(rows)


@query
def period_category_counts(spark, sf_dir):
    return period_counts(spark, sf_dir)


@query
def period_category_pivot(spark, sf_dir):
    return themes.period_category_pivot(period_counts(spark, sf_dir))


@query
def quality_profile(spark, sf_dir):
    return profile.quality_profile(enriched(spark, sf_dir).drop("themes"))


@query
def records_by_month(spark, sf_dir):
    return profile.records_by_month(fx.table(spark, sf_dir, "orders"), "o_orderdate")


@query
def null_counts(spark, sf_dir):
    return profile.null_counts(fx.articles_table(spark, sf_dir))


@query
def feature_statistics(spark, sf_dir):
    return profile.feature_statistics(buckets.bucket_news(enriched(spark, sf_dir, place=True)))


@query
def describe(spark, sf_dir):
    return profile.describe(fx.weather_table(spark, sf_dir))


@query
def correlation_matrix(spark, sf_dir):
    news = buckets.bucket_news(enriched(spark, sf_dir, place=True))
    merged = joins.merge_on_time(news, weather_buckets(spark, sf_dir), "time_bucket", "timestamp", check_overlap=False)
    return correlate.correlation_matrix(stage(merged, "merged"))


@query
def target_correlation(spark, sf_dir):
    return correlate.target_correlation(merged_buckets(spark, sf_dir), TARGET)


@query
def correlated_pairs(spark, sf_dir):
    news = stage(buckets.bucket_news(enriched(spark, sf_dir, place=True)), "news")
    return correlate.correlated_pairs(correlate.correlation_matrix(news))


@query
def hour_and_dow_profile(spark, sf_dir):
    news = buckets.bucket_news(enriched(spark, sf_dir, place=True))
    return profile.hour_and_dow_profile(articles.add_calendar(news))


@query
def split_month_profile(spark, sf_dir):
    return prepare.split_month_profile(daily_split(spark, sf_dir), "ts")


@query
def histogram(spark, sf_dir):
    errors = stage(articles.prediction_errors(predictions(spark, sf_dir)), "errors")
    return profile.histogram(errors, "error")


@query
def theme_sum_histogram(spark, sf_dir):
    news = news_buckets(spark, sf_dir)
    return files.union_batches([
        profile.histogram(news, f"theme_{c}_sum", 10).withColumn("category", F.lit(c)) for c in config.LOAD_CATEGORIES])


@query
def regression_metrics(spark, sf_dir):
    return profile.regression_metrics(stage(predictions(spark, sf_dir), "predicted"))


# --- windows ---------------------------------------------------------------------------

@query
def volume_change(spark, sf_dir):
    news = news_buckets(spark, sf_dir).select("time_bucket", "article_count")
    return series.volume_change(news)


@query
def volume_spike(spark, sf_dir):
    news = news_buckets(spark, sf_dir).select("time_bucket", "article_count")
    return series.volume_spike(news)


@query
def moving_average_3(spark, sf_dir):
    weather = stage(weather_buckets(spark, sf_dir).select("timestamp", TARGET))
    return series.moving_average(weather)


@query
def gap_fill(spark, sf_dir):
    news = stage(buckets.bucket_news(enriched(spark, sf_dir, place=True)).select(
        "time_bucket", "article_count", "theme_Energy_sum", "tone_tone_mean", "tone_tone_std", "max_amount_max"))
    return series.gap_fill(series.densify_spine(news))


@query
def ffill_limited(spark, sf_dir):
    return series.ffill_limited(daily(spark, sf_dir), "ts", ["b", "c"])


@query
def interpolate_linear(spark, sf_dir):
    return series.interpolate_linear(daily(spark, sf_dir), "ts", ["b", "c"])


@query
def mean_fill(spark, sf_dir):
    return series.mean_fill(daily(spark, sf_dir), ["b", "c"])


@query
def impute(spark, sf_dir):
    return flows.impute(daily(spark, sf_dir), "ts", ["target", "b", "c"])


@query
def sequence_windows(spark, sf_dir):
    rows = prepare.sequence_windows(daily(spark, sf_dir), "ts", ["n", "c"], "target")
    steps = rows.select("ts", "target", F.posexplode("sequence").alias("step", "values"))
    return steps.select("ts", "target", "step", F.get("values", F.lit(0)).alias("n"), F.get("values", F.lit(1)).alias("c"))


@query
def sequence_windows_guarded(spark, sf_dir):
    train = stage(daily_split(spark, sf_dir).where(F.col("part") == "train"))
    rows = prepare.sequence_windows(train, "ts", ["n", "c"], "target", max_gap="1 day")
    steps = rows.select("ts", "target", F.posexplode("sequence").alias("step", "values"))
    return steps.select("ts", "target", "step", F.get("values", F.lit(0)).alias("n"), F.get("values", F.lit(1)).alias("c"))


@query
def tail_validation(spark, sf_dir):
    train = stage(daily_split(spark, sf_dir).where(F.col("part") == "train").drop("part"))
    return series.tail_validation(train, "ts").select("ts", "target", "part")


@query
def thin_rows(spark, sf_dir):
    return series.thin_rows(news_buckets(spark, sf_dir).select("time_bucket", "article_count"))


@query
def user_volume_change(spark, sf_dir):
    rows = stage(fx.derive(spark, sf_dir, fx.USER_SERIES, "events"), "users")
    return series.volume_features(rows, keys=["user_id"])


@query
def second_moving_average(spark, sf_dir):
    rows = stage(fx.derive(spark, sf_dir, fx.SECONDS, "events").withColumn("total", F.col("total").cast("double")), "seconds")
    return series.moving_average(rows, "t", "total")


# --- sorts, limits, top-k, sets -----------------------------------------------------------

@query
def top_themes(spark, sf_dir):
    counts = stage(theme_table(spark, sf_dir), "themes")
    every = themes.top_themes(counts, 20).withColumn("kind", F.lit("all"))
    energy = themes.top_themes(themes.keyword_themes(counts), 15).withColumn("kind", F.lit("energy"))
    return every.unionAll(energy)


@query
def top_correlated(spark, sf_dir):
    merged = stage(merged_buckets(spark, sf_dir), "merged")
    return correlate.top_matrix(merged, TARGET)


@query
def top_correlated_by_source(spark, sf_dir):
    weather = weather_buckets(spark, sf_dir).columns
    correlations = correlate.target_correlation(merged_buckets(spark, sf_dir), TARGET)
    return correlate.top_by_source(correlations, weather)


@query
def select_by_correlation(spark, sf_dir):
    correlations = correlate.target_correlation(merged_buckets(spark, sf_dir), TARGET)
    return correlate.select_by_correlation(correlations, TARGET, 0.02)


@query
def time_sort(spark, sf_dir):
    return series.time_sort(merged_buckets(spark, sf_dir).select("datetime", "article_count", "temp_mean"), "datetime")


@query
def split_union_keys(spark, sf_dir):
    split = daily_split(spark, sf_dir)
    part = F.col("part")
    return prepare.split_union_keys(split.where(part == "train"), split.where(part == "test"), "ts")


# --- split, scale, model ----------------------------------------------------------------------

@query
def split_month_based(spark, sf_dir):
    return daily_split(spark, sf_dir, "month_based").select("ts", "target", "part")


@query
def split_random(spark, sf_dir):
    return daily_split(spark, sf_dir, "fully_random").select("ts", "target", "part")


@query
def split_seasonal_block(spark, sf_dir):
    return daily_split(spark, sf_dir, "seasonal_block").select("ts", "target", "part")


@query
def split_metadata(spark, sf_dir):
    return prepare.split_metadata(daily_split(spark, sf_dir, "seasonal_block"), "ts", "seasonal_block")


@query
def standard_scale(spark, sf_dir):
    split = stage(daily_split(spark, sf_dir))
    return prepare.standard_scale(split, ["n", "c"], "target").select("ts", "part", "n", "c")


@query
def minmax_target(spark, sf_dir):
    split = stage(daily_split(spark, sf_dir))
    return prepare.minmax_target(split, "target").select("ts", "part", "target")


def scaled(spark, sf_dir) -> DataFrame:
    return stage(flows.prepare_split(flows.impute(daily(spark, sf_dir), "ts"), "ts", "target"), "scaled")


def trained(spark, sf_dir) -> tuple[DataFrame, DataFrame, DataFrame]:
    return flows.train_and_score(scaled(spark, sf_dir), "ts", "target")


@query
def gbt_forecast(spark, sf_dir):
    return trained(spark, sf_dir)[0]


@query
def forecast_report(spark, sf_dir):
    """Metrics, and the histogram of the errors, of the model's own predictions."""
    scored, metrics, _ = trained(spark, sf_dir)
    values = metrics.select([F.col(c).cast("double") for c in metrics.columns]).unpivot([], metrics.columns, "name", "value")
    bins = profile.histogram(scored, "error").select(F.format_string("bin %02d", "bin").alias("name"), F.col("n").cast("double").alias("value"))
    return values.unionAll(bins)


@query
def feature_importance(spark, sf_dir):
    return trained(spark, sf_dir)[2]


@query
def sequence_forecast(spark, sf_dir):
    split = scaled(spark, sf_dir)
    features = articles.numeric_columns(split, ["target"])
    train, test = (split.where(F.col("part") == p) for p in ("train", "test"))
    return articles.prediction_errors(forecast.sequence_forecast(train, test, "ts", features, "target"))


# --- streaming ----------------------------------------------------------------------------------

#: Bytes of arrived files that a batch takes at most (a larger file is one batch): batches go with the size, not with the number of files.
TRIGGER_BYTES = 1 << 30


def follow(spark: SparkSession, folder: str, schema: T.StructType, names: str = "*.parquet") -> DataFrame:
    return spark.readStream.schema(schema).options(maxBytesPerTrigger=TRIGGER_BYTES, pathGlobFilter=names).parquet(folder)


@query
def stream_new_records(spark, sf_dir):
    rows = fx.articles_table(spark, sf_dir)
    arriving, store, mark = (new_folder(spark, n) for n in ("arriving", "store", "checkpoint"))
    # three arriving batches, the third repeats the records of both others; the stream runs after each
    for batch in (F.col("V2Locations").isNotNull(), F.col("V2Locations").isNull(), F.lit(True)):
        rows.where(batch).write.mode("append").parquet(arriving)
        records.stream_new_records(follow(spark, arriving, rows.schema), store, mark).awaitTermination()
    kept = articles.enrich_articles(rows).schema
    return records.read_store(spark, store, kept).select(ID, "datetime", *FLAGS, "tone_tone", "entity_count", "avg_amount")


@query
def stream_bucket_15min(spark, sf_dir):
    schema = fx.table(spark, sf_dir, "events").schema
    located = articles.location_filter(fx.derived(follow(spark, sf_dir, schema, "events.parquet"), fx.ARTICLES, "events"))
    rows, store = articles.enrich_articles(located, contexts=True), new_folder(spark, "stream")
    spec = {c: kinds for c, kinds in config.NEWS_AGGREGATES.items() if c in rows.columns}
    intervals.stream_partials(rows, store, new_folder(spark, "checkpoint"), "datetime", list(spec)).awaitTermination()
    folded = intervals.read_partials(spark, store, list(spec))
    whole = {f.name for f in rows.schema if isinstance(f.dataType, (T.IntegerType, T.LongType))}
    return folded.select("time_bucket", "article_count", *[
        F.col(f"{c}_{k}").cast("long").alias(f"{c}_{k}") if c in whole and k == "sum" else F.col(f"{c}_{k}")
        for c, kinds in spec.items() for k in kinds])


# --- whole jobs --------------------------------------------------------------------------------------

@query
def news_features(spark, sf_dir):
    return flows.news_features(fx.articles_table(spark, sf_dir), partitions=spark.sparkContext.defaultParallelism)


@query
def model_table(spark, sf_dir):
    return flows.model_table(news_features(spark, sf_dir), flows.weather_features(fx.weather_table(spark, sf_dir)))


@query
def theme_report(spark, sf_dir):
    report = flows.theme_report(fx.articles_table(spark, sf_dir))
    kinds = [("themes", "theme"), ("categories", "category"), ("energy_themes", "theme")]
    named = [report[k].select(F.lit(k).alias("kind"), F.col(c).alias("name"), "n") for k, c in kinds]
    periods = report["periods"].select(F.lit("periods").alias("kind"), F.concat_ws("/", "period", "category").alias("name"), "n")
    totals = report["period_shares"].select(F.lit("totals").alias("kind"), F.col("category").alias("name"), F.col("total").alias("n"))
    return files.union_batches([*named, periods, totals])
