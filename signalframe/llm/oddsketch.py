"""Near duplicates: banded MinHash candidates, odd-sketch screening, full-set confirmation."""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from signalframe.llm.common import map_texts
from signalframe.llm.components import connected
from signalframe.plans.staging import stage

#: Of two sets with similarity s, some band agrees but for a chance of (1 - s**ROWS)**BANDS:
#: 7e-9 at 0.85 and 3e-6 at 0.8.
BANDS, ROWS = 32, 5
SAMPLES = BANDS * ROWS
#: Rounds in which members that cannot have a link are taken out.
PEELED = 2
#: Bits of a sketch, and of the bitmap of a whole set; multiples of 64.
BITS, SET_BITS = 512, 1024

_DRAWS = np.random.default_rng(20240501)
_FACTOR = _DRAWS.integers(0, 2**63, SAMPLES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SHIFT = _DRAWS.integers(0, 2**63, SAMPLES, dtype=np.uint64)
_STEP = np.uint64(0x9E3779B97F4A7C15)


def mixed(x: np.ndarray) -> np.ndarray:
    """A permutation of 64-bit numbers whose output bits all depend on all input bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def words_of(text: str) -> list[bytes]:
    """Words between ASCII white space, A-Z in lower case, everything else as it is."""
    return text.encode("utf-8", "surrogatepass").lower().split()


def shingle_set(words: list[bytes], size: int) -> np.ndarray:
    """Sorted distinct 64-bit shingles of ``size`` words; fewer words are one shingle, none are none."""
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    size = min(size, len(words))
    x = np.full(len(words) - size + 1, size, np.uint64)
    for k in range(size):
        x = x * _STEP + h[k : len(h) - size + 1 + k]
    return np.unique(mixed(x))


def min_hashes(shingles: np.ndarray) -> np.ndarray:
    least = np.full(SAMPLES, np.iinfo(np.uint64).max, np.uint64)
    for start in range(0, len(shingles), 4096):
        part = shingles[start : start + 4096, None] * _FACTOR + _SHIFT
        least = np.minimum(least, part.min(axis=0))
    return least


def band_keys(samples: np.ndarray) -> np.ndarray:
    """One 64-bit key for each band of each row of samples."""
    x = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), (len(samples), BANDS)).copy()
    for k in range(ROWS):
        x = x * _STEP + samples.reshape(-1, BANDS, ROWS)[:, :, k]
    return mixed(x)


def odd_sketches(samples: np.ndarray) -> np.ndarray:
    """Parity bitmaps: every sample, with its position, flips one of BITS bits."""
    n = len(samples)
    bit = (mixed(samples + np.arange(SAMPLES, dtype=np.uint64) * _STEP) % np.uint64(BITS)).astype(np.int64)
    flips = np.bincount((bit + np.arange(n)[:, None] * BITS).ravel(), minlength=n * BITS) & 1
    return np.packbits(flips.astype(np.uint8).reshape(n, BITS), axis=1).view(np.uint64)


def set_bitmap(shingles: np.ndarray) -> np.ndarray:
    """A bit for every shingle.  A bit that another set lacks stands for a shingle that it lacks."""
    held = np.zeros(SET_BITS, np.uint8)
    held[(shingles % np.uint64(SET_BITS)).astype(np.int64)] = 1
    return np.packbits(held).view(np.uint64)


def furthest(similarity: float) -> int:
    """Bits by which sketches of sets at least so similar may differ.

    The estimate from a population count x is 1 + BITS / (4 SAMPLES) ln(1 - 2x / BITS).
    It may fall five standard deviations below the threshold; a pair further
    away is not looked at again.
    """
    least = similarity - 5 * math.sqrt(similarity * (1 - similarity) / SAMPLES)
    return math.ceil(BITS / 2 * (1 - math.exp(-4 * SAMPLES * (1 - least) / BITS)))


def lists(values: np.ndarray) -> pa.Array:
    """Rows of a matrix as lists of signed longs."""
    offsets = np.arange(0, values.size + 1, values.shape[1], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.reshape(-1).view(np.int64)))


def signatures(docs: DataFrame, words: int) -> DataFrame:
    """doc_id, text_key (digest of the words in order, null without words), n_shingles, sketch, bands, bitmap."""

    def step(texts: list[str]) -> dict[str, object]:
        keys, counts, samples = [], np.zeros(len(texts), np.int64), np.zeros((len(texts), SAMPLES), np.uint64)
        bitmaps = np.zeros((len(texts), SET_BITS // 64), np.uint64)
        for i, text in enumerate(texts):
            split = words_of(text)
            found = shingle_set(split, words)
            counts[i] = len(found)
            keys.append(hashlib.blake2b(b" ".join(split), digest_size=16).digest() if split else None)
            samples[i], bitmaps[i] = min_hashes(found), set_bitmap(found)
        folded = {"sketch": odd_sketches(samples), "bands": band_keys(samples), "bitmap": bitmaps}
        return {"text_key": keys, "n_shingles": pa.array(counts), **{k: lists(v) for k, v in folded.items()}}

    schema = "text_key binary, n_shingles long, sketch array<long>, bands array<long>, bitmap array<long>"
    return map_texts(docs.select("doc_id", "text"), step, schema)


def full_sets(docs: DataFrame, words: int) -> DataFrame:
    """doc_id and all its shingles."""

    def step(texts: list[str]) -> dict[str, object]:
        return {"shingles": [shingle_set(words_of(t), words).view(np.int64) for t in texts]}

    return map_texts(docs, step, "shingles array<long>")


def _confirmed(pairs: DataFrame, sets: DataFrame, per_cent: int) -> DataFrame:
    """Of the pairs (a, b), those whose full sets are similar enough."""
    both = stage(pairs, "near-pairs").join(sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("sa")).hint("merge"), "a")
    both = both.join(sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("sb")).hint("merge"), "b")
    common = both.select("a", "b", F.size(F.array_intersect("sa", "sb")).cast("long").alias("n"), (F.size("sa") + F.size("sb")).alias("total"))
    return stage(common.filter(F.col("n") * 100 >= per_cent * (F.col("total") - F.col("n"))).select("a", "b"), "near-links")


def _shared(members: DataFrame, sets: DataFrame) -> DataFrame:
    """Members (doc_id) with the size of their set, and how many of it are in another member's set too."""
    held = sets.join(members.hint("merge"), "doc_id", "left_semi")
    each = held.select("doc_id", F.explode("shingles").alias("shingle"))
    own = each.groupBy("shingle").agg(F.count("*").alias("n"), F.min("doc_id").alias("doc_id")).filter("n = 1").groupBy("doc_id").agg(F.count("*").alias("own"))
    size = held.select("doc_id", F.size("shingles").cast("long").alias("size"))
    return size.join(own, "doc_id", "left").select("doc_id", "size", (F.col("size") - F.coalesce("own", F.lit(0))).alias("shared"))


def _possible(common: Column, sizes: Column, per_cent: int) -> Column:
    """Whether two sets, of so many shingles together, can be linked if no more than ``common`` are in both."""
    return common * (100 + per_cent) >= per_cent * sizes


def _open(members: DataFrame) -> DataFrame:
    """Members (band, doc_id, part) of buckets with several components, with the first component of the bucket."""
    several = members.groupBy("band").agg(F.min("part").alias("first"), F.max("part").alias("last")).filter("first <> last")
    return members.select("band", "doc_id", "part").join(stage(several.select("band", "first"), "open-buckets"), "band")


def _peeled(members: DataFrame, sets: DataFrame, per_cent: int) -> DataFrame:
    """Members without those that share too few shingles to be linked with the smallest set of their bucket, hence with any."""
    sized = stage(members.join(stage(_shared(members.select("doc_id").distinct(), sets), "shared"), "doc_id"), "sized-members")
    least = stage(sized.groupBy("band").agg(F.min("size").alias("least")), "smallest-sets")
    return sized.join(least, "band").filter(_possible(F.col("shared"), F.col("size") + F.col("least"), per_cent)).select("band", "doc_id", "part", "size", "shared")


def _compared(members: DataFrame, reps: DataFrame, per_cent: int) -> DataFrame:
    """Pairs (a, b) of members that may still be linked: one outside the first component of a bucket, one in another component.

    A pair is made in the first of the bands it shares only.
    """
    known = members.select("band", "doc_id", "shared")
    full = stage(_open(members).join(known, ["band", "doc_id"]).join(reps, "doc_id"), "open-members")
    side = lambda k: full.select("band", "first", F.struct("doc_id", "part", "shared", "n_shingles", "sketch", "bands", "bitmap").alias(k))
    both = side("x").filter("x.part <> first").join(side("y").drop("first"), "band")
    x, y = F.col("x"), F.col("y")
    once = (x.part != y.part) & ((y.part == F.col("first")) | (x.doc_id < y.doc_id))
    near = _possible(F.least(x.shared, y.shared), x.n_shingles + y.n_shingles, per_cent) & _near(x, y, per_cent)
    first = F.array_min(F.array_intersect(x.bands, y.bands)) == F.col("band")
    return both.filter(once & near & first).select(F.least(x.doc_id, y.doc_id).alias("a"), F.greatest(x.doc_id, y.doc_id).alias("b"))


def _screened(pairs: DataFrame, reps: DataFrame, per_cent: int) -> DataFrame:
    """Pairs (a, b) that sketches and bitmaps do not rule out."""
    side = lambda k: reps.select(F.col("doc_id").alias(k), F.struct("n_shingles", "sketch", "bitmap").alias(f"of_{k}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b")
    return both.filter(_near(F.col("of_a"), F.col("of_b"), per_cent)).select("a", "b").distinct()


def _near(x: Column, y: Column, per_cent: int) -> Column:
    """Whether sketches estimate a high similarity, and bitmaps leave room for enough common shingles."""
    missing = lambda a, b: _bits([a[i].bitwiseAND(F.bitwise_not(b[i])) for i in range(SET_BITS // 64)])
    common = F.least(x.n_shingles - missing(x.bitmap, y.bitmap), y.n_shingles - missing(y.bitmap, x.bitmap))
    apart = _bits([x.sketch[i].bitwiseXOR(y.sketch[i]) for i in range(BITS // 64)])
    return (apart <= furthest(per_cent / 100)) & _possible(common, x.n_shingles + y.n_shingles, per_cent)


def _bits(words: list[Column]) -> Column:
    counts = [F.bit_count(w) for w in words]
    return sum(counts[1:], counts[0])


def near_duplicates(docs: DataFrame, words: int = 5, per_cent: int = 80) -> DataFrame:
    """Classes of documents (doc_id, text) that are linked, directly or by a chain.

    A document is its set of distinct shingles of ``words`` words, lower-cased
    in A-Z; fewer words are one shingle, and documents without words are linked
    with nothing.  Two are linked when ``per_cent`` per cent of the union of
    their sets are common to both, confirmed on the full sets (64-bit shingles).

    1. Documents with the same words are folded into their smallest doc_id.
    2. MinHash samples make band keys and are folded into an odd sketch.
    3. In each bucket of a band, everything is compared with the smallest
       doc_id: first the sketches, by the population count of their XOR, and
       bitmaps of the sets, then the full sets.  Confirmed links make components.
    4. Of buckets that still hold several components, members that share too
       few shingles with any other to be linked are taken out.  In what is
       left, everything outside the first component is compared with what lies
       in another component, unless the sizes and shared shingles of the two
       rule a link out.  So every pair of a bucket is compared, joined already,
       or shown to be no link.

    Returns a row for each row of ``docs``: doc_id, n_shingles, component_id
    (smallest doc_id reachable), kept (doc_id = component_id).  Rows that repeat
    a doc_id are one node.  A null doc_id links with nothing but its copies.
    Runs jobs that write to the shared folder.
    """
    docs = docs.select("doc_id", "text")
    signed = stage(signatures(docs, words), "signatures")
    classes = signed.filter("text_key is not null").groupBy("text_key").agg(F.min("doc_id").alias("rep"), F.count("*").alias("copies"))
    classes = stage(classes, "copy-classes")
    firsts = classes.select(F.col("rep").alias("doc_id"))
    reps = stage(signed.filter("text_key is not null").join(firsts, "doc_id", "left_semi").select("doc_id", "n_shingles", "sketch", "bands", "bitmap"), "representatives")

    members = reps.select("doc_id", F.explode("bands").alias("band"))
    hubs = members.groupBy("band").agg(F.min("doc_id").alias("hub"), F.count("*").alias("n")).filter("n > 1")
    members = stage(members.join(stage(hubs, "buckets"), "band").select("band", "hub", "doc_id", "n"), "bucket-members")
    # the text of whatever shares a bucket moves once; the same join at any size
    sets = stage(full_sets(docs.join(members.select("doc_id").distinct().hint("merge"), "doc_id", "left_semi"), words), "shingles")
    spokes = members.filter("doc_id <> hub").select(F.col("hub").alias("a"), F.col("doc_id").alias("b")).distinct()
    links = _confirmed(_screened(spokes, reps, per_cent), sets, per_cent)
    parts = connected(links)

    part = parts.select(F.col("node").alias("doc_id"), F.col("component").alias("part"))
    left = members.filter("n > 2").select("band", "doc_id").join(part, "doc_id", "left").select("band", "doc_id", F.coalesce("part", "doc_id").alias("part"))
    left = stage(left, "labelled-members")
    for _ in range(PEELED):
        left = stage(_peeled(_open(left), sets, per_cent), "possible-members")
    more = _confirmed(_compared(left, reps, per_cent), sets, per_cent)
    if not more.isEmpty():
        parts = connected(links.union(more))

    found = signed.join(classes.filter("copies > 1").select("text_key", "rep"), "text_key", "left")
    found = found.select("doc_id", "n_shingles", F.coalesce("rep", "doc_id").alias("rep"))
    found = found.join(parts.select(F.col("node").alias("rep"), "component"), "rep", "left")
    component = F.coalesce("component", "rep", "doc_id")
    return found.select("doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))
