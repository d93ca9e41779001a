"""The end-to-end jobs, composed from the operators.

Each job reads the raw rows once.  What follows the interval aggregate works
on a staged table whose size depends on the time span, not on the raw rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from signalframe import config
from signalframe.operators import articles, buckets, correlate, forecast, joins, prepare, profile, series, themes
from signalframe.plans.staging import spread, stage
from signalframe.sources import files


def engineer_features(bucketed: DataFrame, time: str = "time_bucket") -> DataFrame:
    """Indicators, volume change and spike, and calendar columns of a stored interval table."""
    out = articles.context_indicators(articles.crisis_indicators(bucketed))
    return articles.add_calendar(series.volume_features(out, time), time)


def news_features(records: DataFrame, place: str | None = config.PLACE, start=None, end=None,
                  partitions: int | None = None) -> DataFrame:
    """Raw article records to the regular 15-minute feature table.  Runs a job that stores the interval aggregate.

    ``partitions`` deals the records to so many tasks before they are parsed,
    for files that cannot be split.
    """
    if place is not None:
        records = articles.location_filter(records, place)
    rows = articles.enrich_articles(spread(records, partitions))
    bucketed = stage(buckets.bucket_news(rows), "news")
    kept = stage(articles.select_features(engineer_features(bucketed)), "features")
    return series.gap_fill(series.densify_spine(kept, "time_bucket", start, end))


def weather_features(readings: DataFrame, time: str | None = None) -> DataFrame:
    """Weather and load readings to the 15-minute table with a three-row moving average.  Runs a job that stores the intervals."""
    bucketed = buckets.bucket_weather(readings, time)
    if "Power demand_sum" not in bucketed.columns:
        return bucketed
    return series.moving_average(stage(bucketed, "weather"))


def model_table(news: DataFrame, weather: DataFrame) -> DataFrame:
    """News features joined with weather and load on the interval."""
    return joins.merge_on_time(news, weather, "time_bucket", "timestamp")


def ranked_features(merged: DataFrame, target: str, threshold: float = config.CORRELATION_THRESHOLD) -> DataFrame:
    """Features whose correlation with the target passes the threshold, strongest first."""
    return correlate.select_by_correlation(correlate.target_correlation(merged, target), target, threshold)


def impute(df: DataFrame, time: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Forward fill of short gaps, straight line where much is missing, then the mean.  Runs jobs that store the steps."""
    filled = stage(series.ffill_limited(df, time, columns), "ffill")
    lined = stage(series.interpolate_linear(filled, time, columns), "line")
    return series.mean_fill(lined, columns)


def prepare_split(df: DataFrame, time: str, target: str, strategy: str = "month_based") -> DataFrame:
    """Split a complete model table and scale it with statistics of its train rows."""
    split = prepare.SPLITS[strategy](df, time)
    features = articles.numeric_columns(split, [target])
    return prepare.scale_split(split, features, target)


def store_split(df: DataFrame, time: str, target: str, path: str, run: str, strategy: str = "month_based") -> None:
    """Split and scale a complete model table, and store rows, metadata and scalers under the run label.  Runs jobs."""
    split = stage(prepare.SPLITS[strategy](df, time), "split")
    features = articles.numeric_columns(split, [target])
    scalers = stage(prepare.fit_scalers(split, features, target, strategy), "scalers")
    scaled = prepare.apply_scalers(split, scalers, [*features, target])
    files.write_split_tables(scaled, path, strategy, run, time, scalers.drop("strategy"))


def train_and_score(split: DataFrame, time: str, target: str, model_path: str | None = None,
                    **settings) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(predictions with errors, metrics, feature importance) of a trees model on a scaled split.

    Runs jobs.  ``model_path`` stores the model there.
    """
    timed = stage(articles.add_model_time(split, time), "split")
    features = articles.numeric_columns(timed, [target])
    train = timed.where(F.col("part") == "train")
    marked = stage(series.tail_validation(train, time, name="_role").withColumn(
        "_held", F.col("_role") == "validation").drop("_role"), "train")
    model = forecast.gbt_forecast(marked, features, target, "_held", **settings)
    if model_path:
        forecast.save_model(model, model_path)
    test = timed.where(F.col("part") == "test")
    scored = stage(articles.prediction_errors(forecast.predict(model, test, features, target, time)), "scored")
    return scored, profile.regression_metrics(scored), forecast.feature_importance(model, features, split.sparkSession)


def theme_report(records: DataFrame) -> dict[str, DataFrame]:
    """The theme tables of a record table; mentions are counted once, stored and reused.  Runs jobs."""
    dated = records.withColumn("datetime", articles.text.event_time("DATE")) if "datetime" not in records.columns else records
    counts = stage(themes.theme_counts(records), "themes")
    periods = stage(themes.period_category_counts(dated), "periods")
    return {
        "themes": counts,
        "categories": themes.category_counts(counts),
        "energy_themes": themes.keyword_themes(counts),
        "periods": periods,
        "period_shares": themes.period_category_pivot(periods),
    }
