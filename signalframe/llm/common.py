"""Reading tables and passing documents to Python in batches of bounded size."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: White space as the contracts name it; a Java and a DuckDB pattern alike.
SPACES = r"[\x20\x09-\x0D]+"
#: Scripts written without spaces between words (Thai to Lao, Burmese, Khmer, Kana, ideographs), as a character class.
UNSPACED = "\u0e01-\u0eff\u1000-\u109f\u1780-\u17ff\u3041-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003ffff"
#: Bytes of text that one call of a Python step gets at most, but for a single longer row.
BATCH_BYTES = 8 << 20


def read(spark: SparkSession, sf_dir: str, table: str, *columns: str) -> DataFrame:
    """Only the named columns of a table, so columns that it has besides cannot clash."""
    return spark.read.parquet(f"{sf_dir}/{table}.parquet").select(*columns)


def one_space(text: Column) -> Column:
    """Text with every run of white space as one space; null counts as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACES, " ")


def sliced(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[pa.RecordBatch]:
    """The same rows in batches whose ``column`` holds about BATCH_BYTES at most."""
    for batch in batches:
        size = max(1, batch.column(column).nbytes)
        rows = max(1, int(batch.num_rows * BATCH_BYTES / size)) if size > BATCH_BYTES else batch.num_rows
        for start in range(0, batch.num_rows, max(1, rows)):
            yield batch.slice(start, rows)


def map_texts(docs: DataFrame, step: Callable[[list[str]], dict[str, object]], schema: str, text: str = "text") -> DataFrame:
    """Replace the column ``text`` by what ``step`` makes of a list of texts (null as ""), row by row.

    ``step`` returns a column for each field of ``schema``.  Runs in Arrow
    batches where the rows are; nothing is shuffled.
    """
    added = T.StructType.fromDDL(schema)
    kept = [f for f in docs.schema.fields if f.name != text]
    out = T.StructType([*kept, *added.fields])
    names, types = [f.name for f in kept], None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_type

        nonlocal types
        types = types or [to_arrow_type(f.dataType) for f in added.fields]
        for batch in sliced(batches, text):
            if not batch.num_rows:
                continue
            made = step([t or "" for t in batch.column(text).to_pylist()])
            columns = [batch.column(n) for n in names]
            columns += [made[f.name] if isinstance(made[f.name], pa.Array) else pa.array(made[f.name], type=k) for f, k in zip(added.fields, types)]
            yield pa.RecordBatch.from_arrays(columns, names=[*names, *added.names])

    return docs.mapInArrow(run, out)
