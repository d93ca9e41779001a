"""Which files a date range needs, which batches it makes, what is still to do."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from signalframe import config


def date_bounds(spark: SparkSession, first, last) -> DataFrame:
    """One row (first, last) of dates from two literals."""
    return spark.range(1).select(F.lit(first).cast("date").alias("first"), F.lit(last).cast("date").alias("last"))


def table_bounds(df: DataFrame, time: str) -> DataFrame:
    """One row (first, last): the days a table covers."""
    return df.agg(F.to_date(F.min(time)).alias("first"), F.to_date(F.max(time)).alias("last"))


def interval_manifest(bounds: DataFrame, minutes: int = 15, suffix: str = ".gkg.csv.zip") -> DataFrame:
    """(interval_start, stamp, file_name) per interval of every day, both days included."""
    days = bounds.select(F.explode(F.sequence("first", "last")).alias("day"))
    slots = days.repartition("day").select(
        "day", F.explode(F.sequence(F.lit(0), F.lit(1439), F.lit(minutes))).alias("minute"))
    start = F.timestamp_add("MINUTE", F.col("minute"), F.col("day").cast("timestamp_ntz"))
    return slots.select(start.alias("interval_start")).select(
        "interval_start",
        F.date_format("interval_start", "yyyyMMddHHmmss").alias("stamp"),
        F.concat(F.date_format("interval_start", "yyyyMMddHHmmss"), F.lit(suffix)).alias("file_name"),
    )


def batch_plan(bounds: DataFrame, days: int = config.BATCH_DAYS, prefix: str = "batch_") -> DataFrame:
    """(batch_start, batch_end, file_name): runs of days + 1 days, the last one cut off."""
    starts = bounds.select(
        F.explode(F.sequence("first", "last", F.expr(f"INTERVAL {days + 1} DAYS"))).alias("batch_start"), "last")
    return starts.select("batch_start", F.least(F.date_add("batch_start", days), F.col("last")).alias("batch_end")).select(
        "batch_start", "batch_end",
        F.concat(F.lit(prefix), F.date_format("batch_start", "yyyyMMdd"), F.lit("_to_"),
                 F.date_format("batch_end", "yyyyMMdd"), F.lit(".csv")).alias("file_name"),
    )


def resume_point(names: DataFrame, column: str = "file_name") -> DataFrame:
    """One row (last_end, next_start) from the end dates inside batch file names; bad dates do not count."""
    digits = F.regexp_extract(column, r"_to_([0-9]{8})\.csv", 1)

    def part(start: int, width: int):
        return F.substring(digits, start, width).try_cast("int")

    end = F.to_date(F.try_make_timestamp_ntz(
        part(1, 4), part(5, 2), part(7, 2), F.lit(0), F.lit(0), F.lit(0).cast("decimal(16,6)")))
    return names.agg(F.max(end).alias("last_end")).select("last_end", F.date_add("last_end", 1).alias("next_start"))


def file_names(df: DataFrame, name: str = "file_name") -> DataFrame:
    """Names of the files a scanned table came from."""
    return df.select(F.element_at(F.split(F.input_file_name(), "/"), -1).alias(name)).distinct()


def pending_files(manifest: DataFrame, landed: DataFrame, column: str = "file_name") -> DataFrame:
    """Manifest rows whose key md5(name) is not in the ledger of landed files.

    A ledger with outcomes, as ``archives.read_ledger`` returns it, counts only
    files that gave records: empty and skipped ones stay pending.
    """
    if "outcome" in landed.columns:
        landed = landed.where("outcome = 'landed'")
    done = landed.select(F.md5(column).alias("file_key")).distinct()
    return manifest.withColumn("file_key", F.md5(column)).join(done, "file_key", "left_anti")
