"""Running interval aggregates over a stream of rows, complete whatever the order of arrival.

The store keeps one partial per interval, in a folder for each period (a month
or a day), and a commit record that names the period's folder and the last
batch in it.  A batch reads and rewrites the periods it has rows for and no
others, so it costs the same however many came before.  A period changes by one
rename: readers see it before or after a batch.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from signalframe.operators.buckets import WIDTH, add_partials, merge_partials, partial_rollup
from signalframe.sources import commits

PERIOD, ROWS = "stored_period", "partials"
MONTHS, DAYS = "yyyy-MM", "yyyy-MM-dd"


def _write(partials: DataFrame, folder: str, period: str) -> list[str]:
    """Write partials by the period of their interval; returns the periods."""
    named = partials.withColumn(PERIOD, F.date_format("time_bucket", period))
    named.hint("rebalance", PERIOD).write.partitionBy(PERIOD).parquet(folder)
    return [name.split("=", 1)[1] for name in commits.subfolders(partials.sparkSession, folder)]


def store_partials(batch: DataFrame, batch_id: int, store: str, time: str, columns: Sequence[str], width: str = WIDTH,
                   keys: Sequence[str] = (), stream: str | None = None, period: str = MONTHS) -> int:
    """Fold the rows of one batch into the stored partials of their periods; returns the number of stored folders read.

    A batch that is replayed after a failure finds its number in the records
    of the periods it had finished, and adds only to the others.  ``stream``
    tells apart the batch numbers of different streams into one store.  A store
    has one ``period`` for good: DAYS suits many keys, MONTHS one or a few.
    Rows without a time are left out.
    """
    spark = batch.sparkSession
    fresh = commits.new_folder(store)
    touched = _write(partial_rollup(batch, time, columns, width, keys), fresh, period)
    before = commits.recorded(spark, store, touched)

    def done(label: str) -> bool:
        facts = before[label]["facts"]
        return int(facts["batch"]) >= batch_id and stream in (None, facts["stream"])

    held = [p for p in touched if p in before and not done(p)]
    folders = {p: f"{fresh}/{PERIOD}={p}" for p in touched if p not in before}
    if held:
        both = [*[before[p]["folders"][ROWS] for p in held], *[f"{fresh}/{PERIOD}={p}" for p in held]]
        merged = commits.new_folder(store)
        _write(add_partials(commits.read_folders(spark, store, both), columns, keys), merged, period)
        folders |= {p: f"{merged}/{PERIOD}={p}" for p in held}
    for label, folder in folders.items():
        commits.record(spark, store, label, {ROWS: folder}, batch=batch_id, stream=stream or "")
    return len(held)


def stream_partials(rows: DataFrame, store: str, checkpoint: str, time: str, columns: Sequence[str],
                    width: str = WIDTH, keys: Sequence[str] = (), period: str = MONTHS) -> StreamingQuery:
    """Fold all rows that have arrived into partials, then stop; run again for the next ones.

    There is no watermark: a late row changes its interval like any other.
    """
    spark = rows.sparkSession

    def fold(batch: DataFrame, number: int) -> None:
        stream = json.loads(commits.read_text(spark, f"{checkpoint}/metadata"))["id"]
        store_partials(batch, number, store, time, columns, width, keys, stream, period)

    return rows.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(fold).start()


def read_partials(spark: SparkSession, store: str, columns: Sequence[str], width: str | None = None,
                  keys: Sequence[str] = ()) -> DataFrame:
    """All intervals as they stand now, the last and still open one included."""
    folders = [r["folders"][ROWS] for r in commits.recorded(spark, store).values()]
    if not folders:
        raise ValueError(f"no batch is stored in {store}")
    return merge_partials(commits.read_folders(spark, store, folders), columns, width, keys)
