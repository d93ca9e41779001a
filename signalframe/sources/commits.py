"""Commit records: a small file, written last, that names the folders a label stands for.

Rows are written to a new folder first.  Only when all of them are there does a
record say that the label (a run, a day, an append) now means that folder; it
is put in place by one rename.  Readers go by the records, so they see the
former content until then, and a job that dies leaves a folder nobody reads.
``sweep`` removes such folders.  Records are as many as the labels.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Iterable, Mapping, Sequence
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession

RECORDS, DATA, WRITE = "commits", "data", "write"
_SCHEMA = "label string, folders map<string,string>, facts map<string,string>"


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _files(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())


def read_text(spark: SparkSession, path: str) -> str:
    """A small text file as it is."""
    stream = _files(spark, path).open(_path(spark, path))
    try:
        return bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode("utf-8")
    finally:
        stream.close()


def new_folder(table: str) -> str:
    """A folder for rows that no record names yet."""
    return f"{table.rstrip('/')}/{DATA}/{WRITE}={uuid.uuid4().hex}"


def read_folders(spark: SparkSession, table: str, folders: Iterable[str]) -> DataFrame:
    """The rows of some folders of a table, with the columns that their paths name."""
    return spark.read.option("basePath", f"{table.rstrip('/')}/{DATA}").parquet(*sorted(folders)).drop(WRITE)


def subfolders(spark: SparkSession, folder: str) -> list[str]:
    """Names of the folders directly inside one, as in ``column=value``."""
    return [s.getPath().getName() for s in _files(spark, folder).listStatus(_path(spark, folder)) if s.isDirectory()]


def _record_path(table: str, label: str) -> str:
    return f"{table.rstrip('/')}/{RECORDS}/{quote(label, safe='')}.json"


def record(spark: SparkSession, table: str, label: str, folders: Mapping[str, str], **facts: object) -> None:
    """Let ``label`` stand for these folders from now on, in place of what it stood for."""
    target = _record_path(table, label)
    draft = f"{table.rstrip('/')}/{RECORDS}/.{uuid.uuid4().hex}"
    text = json.dumps({"label": label, "folders": dict(folders), "facts": {k: str(v) for k, v in facts.items()}})
    out = _files(spark, draft).create(_path(spark, draft), False)
    out.write(bytearray(text, "utf-8"))
    out.close()
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(_path(spark, draft).toUri(), spark._jsc.hadoopConfiguration())
    kind = getattr(spark._jvm.org.apache.hadoop.fs, "Options$Rename")
    how = spark.sparkContext._gateway.new_array(kind, 1)
    how[0] = kind.OVERWRITE
    context.rename(_files(spark, draft).makeQualified(_path(spark, draft)), _files(spark, target).makeQualified(_path(spark, target)), how)


def recorded(spark: SparkSession, table: str, labels: Sequence[str] | None = None) -> dict[str, dict]:
    """The records of a table, or of some labels: label -> folders and facts.  Labels without record are left out."""
    if labels is None:
        where = f"{table.rstrip('/')}/{RECORDS}"
        if not _files(spark, where).exists(_path(spark, where)):
            return {}
        rows = spark.read.schema(_SCHEMA).json(where).collect()
        return {r["label"]: {"folders": r["folders"] or {}, "facts": r["facts"] or {}} for r in rows}
    found = {}
    for label in labels:
        path = _record_path(table, label)
        if _files(spark, path).exists(_path(spark, path)):
            found[label] = json.loads(read_text(spark, path))
    return found


def append_once(df: DataFrame, table: str, token: str, partition_by: Sequence[str] = ()) -> bool:
    """Append rows under a token, unless that token has been appended before; says whether it did."""
    spark = df.sparkSession
    if recorded(spark, table, [token]):
        return False
    folder = new_folder(table)
    df = df.hint("rebalance", *partition_by) if partition_by else df
    df.write.partitionBy(*partition_by).parquet(folder)
    record(spark, table, token, {"rows": folder})
    return True


def read_committed(spark: SparkSession, table: str) -> DataFrame:
    """All rows whose append has its record."""
    folders = [r["folders"]["rows"] for r in recorded(spark, table).values()]
    if not folders:
        raise ValueError(f"nothing is committed in {table}")
    return read_folders(spark, table, folders)


def sweep(spark: SparkSession, table: str, hours: float) -> int:
    """Delete folders that no record names and that were last changed more than ``hours`` ago; returns how many.

    Call it from a maintenance job: a folder that a job is writing, or a reader
    with an older record still reads, must not be older than that.
    """
    named = {f.rstrip("/").removeprefix("file:") for r in recorded(spark, table).values() for f in r["folders"].values()}
    top = f"{table.rstrip('/')}/{DATA}"
    if not _files(spark, top).exists(_path(spark, top)):
        return 0
    limit, gone = (time.time() - hours * 3600) * 1000, 0
    for status in _files(spark, top).listStatus(_path(spark, top)):
        folder = f"{top}/{status.getPath().getName()}".removeprefix("file:")
        used = any(n == folder or n.startswith(f"{folder}/") for n in named)
        if not used and status.getModificationTime() < limit:
            _files(spark, top).delete(status.getPath(), True)
            gone += 1
    return gone
