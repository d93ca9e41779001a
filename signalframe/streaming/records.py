"""New article records from arriving batch files, each id stored once."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from signalframe.operators.articles import enrich_articles
from signalframe.operators.joins import new_records

DAY = "stored_day"


def id_day(key: str) -> Column:
    """The date that an id starts with; ids of another form share one partition."""
    day = F.regexp_extract(key, r"^(\d{8})", 1)
    return F.when(day != "", day).otherwise("other")


def read_store(spark: SparkSession, store: str, schema: T.StructType) -> DataFrame:
    """The stored records; the partition column is text."""
    fields = [f for f in schema if f.name != DAY]
    return spark.read.schema(T.StructType([*fields, T.StructField(DAY, T.StringType())])).parquet(store)


def append_new(batch: DataFrame, store: str, key: str, enrich: Callable[[DataFrame], DataFrame]) -> None:
    """Store the rows of one batch whose id is not stored yet.

    Only the days of the batch are looked up: an id names its day, so it is
    nowhere else.  The days, at most as many as the calendar has, pass through
    the driver.  A batch that is replayed after a failure finds its own ids in
    the store and adds nothing twice.  Rows are rebalanced on the day before
    they are written: the lookups of later batches open few files.
    """
    days = [r[0] for r in batch.select(id_day(key)).distinct().collect()]
    shape = T.StructType([f for f in batch.schema if f.name == key])
    stored = read_store(batch.sparkSession, store, shape).where(F.col(DAY).isin(days))
    once = new_records(batch.dropDuplicates([key]), stored, key)
    named = enrich(once).withColumn(DAY, id_day(key))
    named.hint("rebalance", DAY).write.mode("append").partitionBy(DAY).parquet(store)


def stream_new_records(
    arriving: DataFrame,
    store: str,
    checkpoint: str,
    key: str = "GKGRECORDID",
    enrich: Callable[[DataFrame], DataFrame] = enrich_articles,
) -> StreamingQuery:
    """Work through all files that have arrived, then stop; run again for the next ones.

    Every batch looks up the stored ids of its days, so bound batches by bytes
    (``maxBytesPerTrigger``): with a bound on files many small ones cost as
    many lookups.
    """
    spark = arriving.sparkSession
    # a first run starts from an empty table, later runs keep what is stored
    empty = enrich(spark.createDataFrame([], arriving.schema)).withColumn(DAY, id_day(key))
    empty.write.mode("ignore").partitionBy(DAY).parquet(store)
    return (
        arriving.writeStream.option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(lambda batch, _: append_new(batch, store, key, enrich))
        .start()
    )
