"""From raw documents to packed training sequences: five stages, each stored before the next one starts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from signalframe.llm import decontaminate, oddsketch, packing, quality, recipes
from signalframe.llm.common import read
from signalframe.plans.staging import stage

#: Documents below this probability of being good are rejected.
LEAST_QUALITY = 0.5


def keyed(docs: DataFrame) -> tuple[DataFrame, str]:
    """The rows with a stored key of their own, and its name: decisions are made and applied for rows, whatever their doc_id."""
    key = next(n for n in ("row_key", *(f"row_key_{i}" for i in range(len(docs.columns)))) if n not in docs.columns)
    return stage(docs.withColumn(key, F.monotonically_increasing_id()), "keyed"), key


def without(rows: DataFrame, key: str, dropped: DataFrame) -> DataFrame:
    """The rows whose key is not among ``dropped`` (column doc_id)."""
    gone = stage(dropped.select(F.col("doc_id").alias(key)).distinct(), "dropped")
    return rows.join(gone, key, "left_anti").drop(key)


def all_but_first(rows: DataFrame, key: str, found: DataFrame) -> DataFrame:
    """Keys (doc_id) of the rows of each group (doc_id, first) but the one with the smallest doc_id; a null one comes last."""
    found = stage(found, "grouped-rows")
    groups = stage(found.filter("doc_id <> first").select("first").distinct(), "groups")
    ids = rows.select(F.col(key).alias("doc_id"), F.col("doc_id").alias("id"))
    members = found.join(groups, "first", "left_semi").join(ids, "doc_id")
    best = members.groupBy("first").agg(F.min(F.struct(F.col("id").isNull(), "id", "doc_id"))["doc_id"].alias("stays"))
    return members.join(stage(best, "stays"), "first").filter("doc_id <> stays")


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the documents that the weakly supervised scorer takes for good."""
    return quality.scored(docs).filter(F.col(quality.SCORE) >= LEAST_QUALITY).select(docs.columns)


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one row of each group of equal texts, that of the smallest doc_id."""
    rows, key = keyed(docs)
    found = recipes.exact_duplicates(rows.select(F.col(key).alias("doc_id"), "text"))
    copies = found.filter("group_size > 1").select("doc_id", F.col("keep_id").alias("first"))
    return without(rows, key, all_but_first(rows, key, copies))


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one row of each class of near duplicates, that of the smallest doc_id: five-word shingles, similarity of 0.8 or more."""
    rows, key = keyed(docs)
    found = oddsketch.near_duplicates(rows.select(F.col(key).alias("doc_id"), "text"), words=5, per_cent=80)
    return without(rows, key, all_but_first(rows, key, found.select("doc_id", F.col("component_id").alias("first"))))


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the rows that hold no item of the benchmark."""
    rows, key = keyed(docs)
    return without(rows, key, decontaminate.leaks(rows.select(F.col(key).alias("doc_id"), "text"), read(spark, sf_dir, "benchmark", "item_id", "text")))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pack what is left into sequences of the permitted lengths."""
    return packing.packed(docs.select("doc_id", packing.token_count(F.col("text")).alias("n_tokens")))


STAGES = [
    ("quality classifier", quality_stage),
    ("exact dedup", exact_stage),
    ("MinHash near-dedup", near_stage),
    ("benchmark decontamination", benchmark_stage),
    ("best-fit packing", packing_stage),
]

#: SQL cannot express the classifier; the tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table ``documents``.  Runs jobs; every stage is stored in the shared folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, step) in enumerate(STAGES):
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{k}")
    return docs
