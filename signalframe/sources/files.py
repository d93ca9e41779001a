"""Reading raw article files and headered tables, writing results."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from signalframe import config
from signalframe.functions.text import null_if_missing
from signalframe.operators.prepare import split_metadata
from signalframe.sources import commits


def blank_to_null(df: DataFrame) -> DataFrame:
    """Text cells holding a "missing" token become NULL, in every string column."""
    texts = {f.name for f in df.schema if isinstance(f.dataType, T.StringType)}
    return df.select(*[
        null_if_missing(c).alias(c) if c in texts else F.col(f"`{c}`") for c in df.columns
    ])


def records_of_lines(lines: DataFrame) -> DataFrame:
    """Raw records from a table of lines (column ``value``): one record a line, 27 text cells between tabs.

    Quotation marks are ordinary characters.  Empty lines are no records,
    absent cells are NULL and cells beyond the last column are left out.
    """
    cells = F.split(F.regexp_replace("value", "\r$", ""), "\t", -1)
    rows = lines.where(~F.col("value").isin("", "\r")).select(cells.alias("cells"))
    return blank_to_null(rows.select(*[F.get("cells", F.lit(i)).alias(c) for i, c in enumerate(config.RAW_COLUMNS)]))


def scan_gkg_tsv(spark: SparkSession, path: str | list[str], encoding: str = "UTF-8") -> DataFrame:
    """Headerless tab-separated records of 27 text columns (plain or gzip files), in one of the encodings of ``decode``."""
    lines = spark.read.options(lineSep="\n", encoding=encoding).text(path)
    if encoding.upper() != "UTF-8":  # the reader finds the line ends and hands on the bytes between them
        lines = lines.select(F.decode(F.col("value").cast("binary"), encoding).alias("value"))
    return records_of_lines(lines)


def scan_csv_table(spark: SparkSession, path: str | list[str], schema: T.StructType | str,
                   time: str | None = None) -> DataFrame:
    """Headered CSV with a known schema; the time column is typed.  A file that cannot be read to its end fails the job."""
    reader = spark.read.schema(schema).options(header=True, mode="PERMISSIVE", escape='"', ignoreCorruptFiles=False)
    df = reader.csv(path)
    return df.withColumn(time, F.col(f"`{time}`").try_cast("timestamp_ntz")) if time else df


def union_batches(frames: Sequence[DataFrame]) -> DataFrame:
    """All batches as one table, absent columns NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def write_table(df: DataFrame, path: str, mode: str = "overwrite", format: str = "parquet",
                partition_by: Sequence[str] = (), token: str | None = None) -> None:
    """Write or append a table as parquet, CSV with header, or JSON.

    An append with a ``token`` is safe to repeat: parquet rows go to a folder of
    their own, and one commit record for each token makes them part of the
    table, which ``commits.read_committed`` reads.

    Mode ``replace`` puts the rows in place of the partitions that they belong
    to and leaves the others alone.

    Before a partitioned write the rows are rebalanced on the partition
    columns: few files per partition, and a partition that holds much of the
    table is spread over several tasks.
    """
    if token is not None:
        if mode != "append" or format != "parquet":
            raise ValueError("a token belongs to an append of parquet")
        commits.append_once(df, path, token, partition_by)
        return
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    writer = df.write.mode("overwrite" if mode == "replace" else mode).format(format)
    if mode == "replace":
        writer = writer.option("partitionOverwriteMode", "dynamic")
    if format == "csv":
        writer = writer.options(
            header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


def write_split_tables(split: DataFrame, path: str, strategy: str, run: str, time: str,
                       scalers: DataFrame | None = None) -> None:
    """Store one split run under its strategy and run label: rows, what went where, and the scaler table.

    Readers see the run, whole, once its commit record is in place: it is
    written last and names the three tables.  Storing the same label again
    replaces it in the same way.  ``scalers`` is the table of ``fit_scalers``
    that the rows were scaled with.
    """
    spark = split.sparkSession
    tables = {"rows": split, "metadata": split_metadata(split, time, strategy)}
    if scalers is not None:
        tables["scalers"] = scalers
    whole, folders = commits.new_folder(path), {}
    for name, table in tables.items():
        folders[name] = f"{whole}/table={name}/strategy={quote(strategy)}/run={quote(run)}"
        write_table(table, folders[name], partition_by=["part"] if name == "rows" else [])
    commits.record(spark, path, f"{strategy}/{run}", folders, strategy=strategy, run=run)


def split_runs(spark: SparkSession, path: str) -> list[dict]:
    """The stored runs: facts (strategy, run) and folders of their tables."""
    return list(commits.recorded(spark, path).values())


def read_split_tables(spark: SparkSession, path: str, name: str = "rows", runs: Sequence[dict] | None = None) -> DataFrame:
    """All stored split runs, or the given ones (or their ``metadata`` or ``scalers``); the labels are text."""
    folders = [r["folders"][name] for r in (split_runs(spark, path) if runs is None else runs) if name in r["folders"]]
    if not folders:
        raise ValueError(f"no run with {name} is stored in {path}")
    labels = ["strategy", "run", *(["part"] if name == "rows" else [])]
    found = commits.read_folders(spark, path, folders)
    fields = [f for f in found.schema if f.name not in (*labels, "table")]
    schema = T.StructType([*fields, *[T.StructField(c, T.StringType()) for c in (commits.WRITE, "table", *labels)]])
    read = spark.read.schema(schema).option("basePath", f"{path.rstrip('/')}/{commits.DATA}").parquet(*folders)
    return read.drop(commits.WRITE, "table")


def latest_run(spark: SparkSession, path: str, name: str = "rows") -> DataFrame:
    """Rows of the newest run of each strategy, newest by label order.

    Which run that is stands in the commit records; files of other runs are
    not looked at.
    """
    newest: dict[str, dict] = {}
    for r in split_runs(spark, path):
        strategy = r["facts"]["strategy"]
        if strategy not in newest or r["facts"]["run"] > newest[strategy]["facts"]["run"]:
            newest[strategy] = r
    return read_split_tables(spark, path, name, list(newest.values()))
