"""Folders of headered CSV files whose columns differ: one scan a header, damaged files left out whole and listed."""

from __future__ import annotations

import csv
import re
import zlib
from collections import defaultdict
from collections.abc import Iterator
from functools import reduce
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from signalframe.plans.staging import stage

READ, EMPTY, SKIPPED = "read", "empty", "skipped"
#: A quoted cell, from its comma (or the start of the line) to the next one (or the end).
QUOTED = r'(^|,)"(?:[^"]++|"")*+"(?=,|$)'
#: Bytes that a gzip file is unpacked to at once.
PIECE = 1 << 20


def _file() -> Column:
    return F.col("_metadata.file_path").alias("file")


def gzip_ends(content: bytes) -> bool:
    """Whether gzip bytes can be unpacked to the end of their last member."""
    unpack, rest = zlib.decompressobj(31), content
    try:
        while rest:
            unpack.decompress(rest, PIECE)
            rest = unpack.unconsumed_tail
            if unpack.eof:
                rest = unpack.unused_data.lstrip(b"\0")
                if rest:
                    unpack = zlib.decompressobj(31)
    except zlib.error:
        return False
    return unpack.eof


def _broken_gzips(spark: SparkSession, path: str | list[str]) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            broken = [not gzip_ends(c.as_py()) for c in batch.column("content")]
            yield pa.RecordBatch.from_arrays([batch.column("file").filter(pa.array(broken))], names=["file"])

    found = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path)
    return found.select(_file(), "content").mapInArrow(run, "file string")


def file_outcomes(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(file, header, outcome, reason, records): a row for each file under a path.

    Outcome: read, empty (a blank first line), or skipped; files of no bytes are
    passed over by Spark's readers and not listed.  Skipped are files with bytes
    that are not UTF-8, with a quoted cell that does not end on its line, with a
    line of more cells than the header, and gzip files that break off.  Lines
    are folded in each task, so a file of any size costs one row a split.
    """
    lines = spark.read.options(lineSep="\n", ignoreCorruptFiles=True).text(path).select(
        _file(), F.regexp_replace("value", "\r$", "").alias("line"), F.is_valid_utf8("value").alias("valid"),
        F.when(F.col("_metadata.file_block_start") == 0, F.monotonically_increasing_id()).alias("at"))
    bare = lines.withColumn("bare", F.regexp_replace("line", QUOTED, "$1"))
    width = F.length("bare") - F.length(F.replace("bare", F.lit(","), F.lit("")))
    folded = bare.select("*", width.alias("width")).groupBy("file").agg(
        F.min_by(F.struct("line", "width"), "at").alias("first"), F.max("width").alias("widest"),
        F.bool_and("valid").alias("valid"), F.bool_or(F.col("bare").rlike('(^|,)"')).alias("open"),
        F.count_if(F.trim("line") != "").alias("lines"))
    broken = _broken_gzips(spark, path).withColumn("broken", F.lit(True))
    files = spark.read.format("binaryFile").load(path).select(_file())
    reason = (F.when(F.col("broken"), "gzip breaks off").when(~F.col("valid"), "not UTF-8")
              .when(F.col("open"), "quoted cell without end").when(F.col("widest") > F.col("first.width"), "more cells than the header"))
    blank = F.col("first").isNull() | (F.trim("first.line") == "")
    rows = files.join(folded, "file", "left").join(broken, "file", "left").withColumn("reason", reason)
    return rows.select(
        "file", F.ltrim("first.line", F.lit("\ufeff")).alias("header"),
        F.when(F.col("reason").isNotNull(), SKIPPED).when(blank, EMPTY).otherwise(READ).alias("outcome"), "reason",
        F.when(F.col("reason").isNull(), F.greatest(F.col("lines") - 1, F.lit(0))).otherwise(0).alias("records"))


def reader_path(file: str) -> str:
    """A file's name as readers take it: without URL escapes, and with pattern signs as ordinary characters."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", unquote(file))


def header_names(header: str) -> list[str]:
    """The cells of a header line; a name that repeats (in any case) gets a number, one without name its place."""
    names: list[str] = []
    for k, name in enumerate(next(csv.reader([header]), [])):
        name, taken = name or f"_c{k}", {n.lower() for n in names}
        extra = 0
        shown = name
        while shown.lower() in taken:
            extra += 1
            shown = f"{name}.{extra}"
        names.append(shown)
    return names


def scan_csv_folder(spark: SparkSession, path: str | list[str], schema: T.StructType | str | None = None) -> tuple[DataFrame, DataFrame]:
    """The rows of all whole CSV files under a path, and the outcome of each file.  Runs a job.

    Columns go by name: one scan for each distinct header, absent columns NULL.
    All cells are text, but columns named in ``schema`` get its type (NULL if a
    cell is no such value) and are there even if no file has them.  A file
    that ``file_outcomes`` skips gives no row.  No whole file: no rows.

    Each file is read twice, once for headers and damage, once for rows.  The
    names of the files pass through the driver, as they do in any scan.
    """
    outcomes = stage(file_outcomes(spark, path), "csv-outcomes")
    groups: dict[str, list[str]] = defaultdict(list)
    for row in outcomes.where(F.col("outcome") == READ).select("header", "file").toLocalIterator():
        groups[row["header"]].append(reader_path(row["file"]))
    wanted = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema or T.StructType()
    parts = [spark.createDataFrame([], wanted)] if not groups else []
    for header, files in sorted(groups.items()):
        names = header_names(header)
        reader = spark.read.schema(T.StructType([T.StructField(n, T.StringType()) for n in names]))
        table = reader.options(header=True, mode="PERMISSIVE", escape='"').csv(sorted(files))
        types = {f.name: f.dataType for f in wanted}
        cells = [F.col(f"`{n}`").try_cast(types[n]).alias(n) if n in types else F.col(f"`{n}`") for n in names]
        absent = [F.lit(None).cast(t).alias(n) for n, t in types.items() if n not in names]
        parts.append(table.select(*cells, *absent))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts), outcomes
