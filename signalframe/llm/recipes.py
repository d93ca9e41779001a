"""Exact duplicates by content-defined chunk recipes, in DataFrame functions only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from signalframe.llm.common import one_space
from signalframe.plans.staging import stage

#: About a quarter of the letters of the scripts beyond Latin: the first ones of each alphabet, syllabary or block.
FIRST = (r"\u0391-\u0395\u03b1-\u03b5\u0410-\u0418\u0430-\u0438\u05d0-\u05d6\u0621-\u062a\u0905-\u0920\u0e01-\u0e18"
         r"\u1000-\u1008\u1780-\u1788\u3041-\u3054\u30a1-\u30b4\u4e00-\u56ff\uac00-\ub5ff")
#: Where a chunk may end, by the characters before the cut, about once in some hundred: Latin words with anything but a
#: letter between, other scripts, figures, letters and figures mixed without spaces (codes).
CUTS = (r"[aeoAEO][b-mB-M][ !-/:-@\[-`{-~][n-zN-Z]", f"[{FIRST}]{{2}}[^\\x00-\u02ff{FIRST}][{FIRST}]", "[01][23][45][67]",
        "[0-9][A-M][a-m][N-Z]", "[0-2][a-c][5-9][a-f]")
#: A chunk ends where the text around the cut says so, 256 characters after its start at
#: the earliest and 8,192 at the latest.  Text between equal cuts gives equal chunks.
CHUNK = rf"(?s).{{256,8188}}?(?:{'|'.join(CUTS)}|\z)|.{{1,8192}}"


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def document_chunks(docs: DataFrame) -> DataFrame:
    """doc_id, text_sha256 and the ordered chunks of the normalised text (empty text: none)."""
    texts = docs.select("doc_id", one_space(F.col("text")).alias("_text"))
    return texts.select(
        "doc_id", F.sha2("_text", 256).alias("text_sha256"),
        F.regexp_extract_all("_text", F.lit(CHUNK), F.lit(0)).alias("chunks"),
    )


def shared_digests(chunked: DataFrame, digest: Callable[[Column], Column]) -> DataFrame:
    """Digests that stand for more than one chunk text: those that identify nothing.

    Each distinct chunk moves once; copies are folded before the shuffle.
    """
    chunks = chunked.select(F.explode(F.transform("chunks", lambda c: F.struct(digest(c).alias("id"), c.alias("chunk")))).alias("c"))
    return chunks.select("c.*").distinct().groupBy("id").agg(F.count("*").alias("n")).filter("n > 1").select("id")


def exact_duplicates(docs: DataFrame, digest: Callable[[Column], Column] = sha256) -> DataFrame:
    """Groups of documents (doc_id, text) whose texts are equal but for the length of white space.

    Texts are cut into content-defined chunks.  A chunk's identifier is its
    digest, verified over the whole corpus to stand for one chunk text only.
    A document's recipe is the ordered list of its identifiers; equal recipes
    are equal texts, and only recipes are grouped and joined.  Should a digest
    stand for two texts, the documents that hold it are compared by recipe and
    whole text instead.

    Returns a row for each row of ``docs``: doc_id, keep_id (smallest doc_id of
    the group), group_size, kept (doc_id = keep_id), text_sha256.  Null text is
    empty text; empty texts are one group.  Rows that repeat a doc_id share its
    decision and count each.  A null doc_id is never preferred; a group with
    no other has keep_id null and is kept.  Runs jobs that write small tables
    to the shared folder.
    """
    chunked = document_chunks(docs.select("doc_id", "text"))
    broken = stage(shared_digests(chunked, digest), "chunk-collisions")
    recipe = F.transform("chunks", digest).alias("recipe")
    keyed = chunked.select("doc_id", "text_sha256", recipe, F.lit("").alias("whole"))
    if not broken.isEmpty():
        holders = keyed.select("text_sha256", F.explode("recipe").alias("id")).join(broken, "id", "left_semi")
        holders = stage(holders.select("text_sha256").distinct().withColumn("broken", F.lit(True)), "collided")
        whole = F.when(F.col("broken"), F.concat_ws("", "chunks")).otherwise("")
        keyed = chunked.join(holders, "text_sha256", "left").select("doc_id", "text_sha256", recipe, whole.alias("whole"))
    keyed = stage(keyed, "recipes")
    groups = keyed.groupBy("recipe", "whole").agg(F.min("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
    # stored, so that the join deals out both sides itself and can split a hot group
    groups = stage(groups.filter("group_size > 1").withColumn("grouped", F.lit(True)), "copies")
    out = keyed.join(groups, ["recipe", "whole"], "left")
    keep = F.when(F.col("grouped"), F.col("keep_id")).otherwise(F.col("doc_id"))
    return out.select(
        "doc_id", keep.alias("keep_id"), F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
        F.col("doc_id").eqNullSafe(keep).alias("kept"), "text_sha256",
    )
