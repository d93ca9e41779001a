"""Zipped raw files: one read gives the records and the outcome of every archive.

An archive holds one member, named like itself without the suffix.  Its file
name begins with the time of its interval, so a range of days is a set of
file-name patterns and other archives are not even listed.  ``land`` keeps what
it read, records and ledger, under one commit record.
"""

from __future__ import annotations

import hashlib
import io
import zipfile
import zlib
from collections.abc import Iterator
from datetime import date, timedelta

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from signalframe.sources import commits
from signalframe.sources.files import records_of_lines

#: Lines that one call of the unpacking step passes on at once.
LINES = 10_000
LANDED, EMPTY, SKIPPED = "landed", "empty", "skipped"
_READ = "file_name string, version string, kind string, outcome string, reason string, records long, value string"


def day_patterns(path: str, suffix: str, first: date | None = None, last: date | None = None) -> list[str]:
    """Path patterns of the archives of each day from ``first`` to ``last``, or of all."""
    if first is None or last is None:
        return [f"{path.rstrip('/')}/*{suffix}"]
    days = [first + timedelta(days=k) for k in range((last - first).days + 1)]
    return [f"{path.rstrip('/')}/{d:%Y%m%d}*{suffix}" for d in days]


def archives(spark: SparkSession, path: str, suffix: str = ".zip", first: date | None = None, last: date | None = None) -> DataFrame:
    """The archives under a path (``binaryFile`` columns), of the days asked for."""
    fs = commits._files(spark, path)
    patterns = [p for p in day_patterns(path, suffix, first, last) if len(fs.globStatus(commits._path(spark, p)) or [])]
    if not patterns:
        return spark.createDataFrame([], "path string, modificationTime timestamp, length long, content binary")
    return spark.read.format("binaryFile").load(patterns)


def version() -> Column:
    """Time and size of a file."""
    return F.concat_ws("/", F.col("modificationTime").cast("string"), F.col("length").cast("string"))


def member_lines(name: str, content: bytes, suffix: str, encoding: str) -> tuple[list[str], str | None]:
    """The lines of the member named like its archive, or why there are none."""
    try:
        text = zipfile.ZipFile(io.BytesIO(content)).read(name.removesuffix(suffix)).decode(encoding, "replace")
    except (zipfile.BadZipFile, zlib.error, KeyError, EOFError, NotImplementedError, RuntimeError, OSError) as error:
        return [], f"{type(error).__name__}: {error}"
    return text.split("\n"), None


def read_archives(found: DataFrame, suffix: str = ".zip", encoding: str = "utf-8") -> DataFrame:
    """For each archive a row of kind ``outcome`` and one of kind ``line`` for each line of its member.

    Outcome: landed (with the number of its lines that are not empty), empty,
    or skipped, with the reason: no zip file, no such member, damaged, or
    written in a way that cannot be read.  A skipped archive gives no line at all.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fields = [pa.field(n, pa.int64() if n == "records" else pa.string()) for n in ("file_name", "version", "kind", "outcome", "reason", "records", "value")]

        def rows(name: str, version: str, kind: str, outcome: str | None, reason: str | None, n: int | None, values: list) -> pa.RecordBatch:
            k = len(values)
            return pa.RecordBatch.from_arrays(
                [pa.array([x] * k if f.name != "value" else values, f.type) for f, x in zip(fields, (name, version, kind, outcome, reason, n, None))], schema=pa.schema(fields))

        for batch in batches:
            for path, version, content in zip(*(batch.column(c).to_pylist() for c in ("path", "version", "content"))):
                name = path.rsplit("/", 1)[-1]
                lines, reason = member_lines(name, content, suffix, encoding)
                records = sum(1 for x in lines if x.rstrip("\r"))
                outcome = SKIPPED if reason else LANDED if records else EMPTY
                yield rows(name, version, "outcome", outcome, reason, records, [None])
                for start in range(0, len(lines) if records else 0, LINES):
                    yield rows(name, version, "line", None, None, None, lines[start : start + LINES])

    return found.select("path", version().alias("version"), "content").mapInArrow(run, _READ)


def records_of(read: DataFrame) -> DataFrame:
    """The raw records of a read."""
    return records_of_lines(read.where("kind = 'line'").select("value"))


def scan_gkg_zip(spark: SparkSession, path: str, suffix: str = ".zip", first: date | None = None, last: date | None = None,
                 encoding: str = "utf-8") -> DataFrame:
    """Raw records of the archives under a path; those without a readable member give none."""
    return records_of(read_archives(archives(spark, path, suffix, first, last), suffix, encoding))


def outcomes_of(read: DataFrame) -> DataFrame:
    """(file_name, version, outcome, reason, records) of a read, a row for each archive."""
    return read.where("kind = 'outcome'").select("file_name", "version", "outcome", "reason", "records")


def read_ledger(spark: SparkSession, table: str) -> DataFrame:
    """The last known outcome of each archive; an empty table if nothing has been read."""
    folders = {label: r for label, r in commits.recorded(spark, table).items()}
    if not folders:
        return spark.createDataFrame([], "file_name string, version string, outcome string, reason string, records long")
    read = commits.read_folders(spark, table, [r["folders"]["rows"] for r in folders.values()]).where("kind = 'outcome'")
    best = F.max_by(F.struct("version", "outcome", "reason", "records"), F.struct((F.col("outcome") == LANDED), "landed_at"))
    return read.groupBy("file_name").agg(best.alias("o")).select("file_name", "o.*")


def read_landed(spark: SparkSession, table: str) -> DataFrame:
    """The raw records of all archives that have landed."""
    folders = [r["folders"]["rows"] for r in commits.recorded(spark, table).values()]
    if not folders:
        raise ValueError(f"nothing has landed in {table}")
    return records_of(commits.read_folders(spark, table, folders))


def land(spark: SparkSession, path: str, table: str, first: date | None = None, last: date | None = None,
         suffix: str = ".zip", encoding: str = "utf-8") -> int:
    """Read the archives of the days that have not landed yet, once, and keep their records and outcomes; returns how many.

    Archives that were skipped or empty stay pending and are read again when
    they have changed.  Names, sizes and times of the pending archives of the
    range pass through the driver; call it batch by batch, as ``batch_plan``
    cuts the calendar.  A call that died adds nothing and can be repeated.
    """
    known = read_ledger(spark, table)
    there = archives(spark, path, suffix, first, last).select(
        "path", version().alias("version"), F.element_at(F.split("path", "/"), -1).alias("file_name"))
    pending = there.join(known.where(F.col("outcome") == LANDED), "file_name", "left_anti").join(
        known, ["file_name", "version"], "left_anti").orderBy("path").collect()
    if not pending:
        return 0
    token = hashlib.sha256(repr([(r["path"], r["version"]) for r in pending]).encode()).hexdigest()
    found = spark.read.format("binaryFile").load([r["path"] for r in pending])
    read = read_archives(found, suffix, encoding).withColumn("landed_at", F.current_timestamp())
    return len(pending) if commits.append_once(read, table, token, ["kind"]) else 0
