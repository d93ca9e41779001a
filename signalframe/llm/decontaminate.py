"""Benchmark passages in documents, with edits: random-walk embedding, bit sampling, exact edit distance."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from signalframe.llm.common import UNSPACED, sliced
from signalframe.llm.oddsketch import mixed
from signalframe.plans.staging import stage

#: Share of an item's words that may be edited.
ERRORS = 0.2
#: Independent walks, and sampled places of each.  Their number sets the recall.
WALKS, PLACES = 24, 3
#: Steps of a walk for each word of a window.
STRETCH = 1.5
#: Items below so many words must occur unchanged.
SHORT = 5
#: Bits for each entry of the bitmaps that every task holds (words, pairs of words, and keys of the benchmark), and the
#: least and largest logarithm of their size.  A bitmap that is full lets more through to the exact steps.
BITS, SMALLEST, LARGEST = 32, 22, 26

_STEP = np.uint64(0x9E3779B97F4A7C15)
_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
_ALONE = re.compile(f"[{UNSPACED}]")
_APART = re.compile("[\u2010-\u2027\u2030-\u205e\u3000-\u303f\uff01-\uff0f\uff1a-\uff20\uff3b-\uff40\uff5b-\uff65]")


def word_hashes(text: str) -> np.ndarray:
    """64-bit hashes of the words of a text: runs of letters and digits, in lower case.

    In scripts without spaces every character is a word.  Punctuation, wide
    forms too, parts words.
    """
    if not text.isascii():
        text = _ALONE.sub(r" \g<0> ", _APART.sub(" ", text))
    words = _WORD.findall(text.lower().encode("utf-8", "surrogatepass"))
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def pair_hashes(words: np.ndarray) -> np.ndarray:
    """Hashes of neighbouring words."""
    return mixed(words[:-1] * _STEP + words[1:])


def window_size(words: int) -> int:
    """The largest window, of sizes that grow by a fifth, that an item of so many words fills."""
    size = 1
    while (following := next_size(size)) <= words:
        size = following
    return size


def next_size(size: int) -> int:
    return max(size + 1, size * 6 // 5)


def allowed(words: int) -> int:
    """Edits by which a passage may differ from an item of so many words."""
    return int(ERRORS * words) if words >= SHORT else 0


def places(size: int, walk: int) -> list[int]:
    draws = np.random.default_rng([size, walk])
    steps = max(1, int(STRETCH * size))
    return sorted(draws.choice(steps, min(PLACES, steps), replace=False).tolist())


def walk_keys(words: np.ndarray, starts: np.ndarray, size: int, stops: np.ndarray | None = None) -> np.ndarray:
    """A key for each start and walk: the sampled places of the embedded window, which ends early at ``stops``.

    A walk reads a word, writes it, and stays or goes on to the next word as a
    random function of the step and the word says.  After an edit two walks
    fall into step again, so few edits give few different places.
    """
    keys = np.empty((len(starts), WALKS), np.uint64)
    for walk in range(WALKS):
        sampled = places(size, walk)
        bits = np.random.default_rng([size, walk, 1]).integers(0, 2**63, sampled[-1] + 1, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        at, end = starts.copy(), starts + size if stops is None else np.minimum(starts + size, stops)
        key = np.full(len(starts), size * WALKS + walk, np.uint64)
        for step in range(sampled[-1] + 1):
            inside = at < end
            word = np.where(inside, words[np.minimum(at, len(words) - 1)], np.uint64(0))
            if step in sampled:
                key = key * _STEP + word
            at += ((word * bits[step]) >> np.uint64(63)).astype(np.int64) & inside
        keys[:, walk] = mixed(key)
    return keys


def bit_of(hashes: np.ndarray, bitmap: np.ndarray) -> np.ndarray:
    """Whether the bitmap has the bits of the hashes."""
    low = hashes & np.uint64((len(bitmap) << 6) - 1)
    return (bitmap[(low >> np.uint64(6)).astype(np.int64)] >> (low & np.uint64(63))) & np.uint64(1) == 1


def bitmap_of(hashes: DataFrame, column: str) -> np.ndarray:
    """A bitmap of a size that fits the number of rows, up to 8 MB.  Runs two jobs; at most 2**(LARGEST - 6) rows reach the driver."""
    size = min(LARGEST, max(SMALLEST, (BITS * hashes.count()).bit_length()))
    low = F.col(column).bitwiseAND(F.lit((1 << size) - 1))
    words = F.shiftright(low, 6).cast("int")
    found = hashes.groupBy(words.alias("w")).agg(F.bit_or(F.expr(f"shiftleft(1L, cast({column} & 63L as int))")).alias("b")).collect()
    bitmap = np.zeros(1 << (size - 6), np.int64)
    for row in found:
        bitmap[row.w] = row.b
    return bitmap.view(np.uint64)


def indexed(benchmark: DataFrame) -> DataFrame:
    """item_id, words (hashes in order), pairs of words, size of the window, keys; an item without words has no row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for item, text in zip(batch.column("item_id").to_pylist(), batch.column("text").to_pylist()):
                words = word_hashes(text or "")
                if len(words):
                    size = window_size(len(words))
                    keys = walk_keys(words, np.zeros(1, np.int64), size)[0]
                    rows.append((item, words.view(np.int64), pair_hashes(words).view(np.int64), size, keys.view(np.int64)))
            columns = list(zip(*rows)) or [[]] * 5
            longs = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, type=t) for c, t in zip(columns, [pa.int64(), longs, longs, pa.int32(), longs])],
                names=["item_id", "item_words", "pairs", "size", "keys"],
            )

    schema = "item_id long, item_words array<long>, pairs array<long>, size int, keys array<long>"
    return benchmark.select(F.col("item_id").cast("long"), "text").mapInArrow(run, schema)


def windows(docs: DataFrame, sizes: list[int], word_map: np.ndarray, pair_map: np.ndarray, key_map: np.ndarray) -> DataFrame:
    """Windows of documents that share a key with the benchmark: doc_id, start, words, keys.

    An edit takes at most one word and two pairs of neighbouring words out of a
    passage.  So a window is embedded only if no more of them than that are
    missing from the benchmark's; nothing is lost by it.  A window that the end
    of its document cuts off counts what it lacks as missing.  All texts of a
    batch are gone through at once.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "text"):
            hashes = [word_hashes(t or "") for t in batch.column("text").to_pylist()]
            lengths = np.array([len(h) for h in hashes], np.int64)
            ends = np.cumsum(lengths)
            words = np.concatenate([*hashes, np.empty(0, np.uint64)])
            doc = np.repeat(np.arange(len(hashes)), lengths)
            known = np.concatenate([[0], np.cumsum(bit_of(words, word_map))])
            paired = np.concatenate([[0], np.cumsum(bit_of(pair_hashes(words), pair_map))])
            ids = batch.column("doc_id").to_pylist()
            for size in sizes:
                longest = next_size(size) - 1
                n, edits = max(0, len(words) - size + 1), allowed(longest)
                fit = known[size : size + n] - known[:n] >= size - edits
                fit &= paired[size - 1 : size - 1 + n] - paired[:n] >= size - 1 - 2 * edits
                starts = np.flatnonzero(fit)
                starts = starts[starts + size <= ends[doc[starts]]]
                cut = (ends[:, None] - np.arange(size - edits, size))[lengths[:, None] >= np.arange(size - edits, size)]
                stop = ends[doc[cut]]
                fit = known[stop] - known[cut] >= size - edits
                fit &= paired[stop - 1] - paired[cut] >= size - 1 - 2 * edits
                starts = np.concatenate([starts, cut[fit]])
                for begin in range(0, len(starts), 1 << 18):
                    some = starts[begin : begin + (1 << 18)]
                    keys = walk_keys(words, some, size, ends[doc[some]])
                    hit = bit_of(keys, key_map)
                    rows = np.flatnonzero(hit.any(axis=1))
                    if not len(rows):
                        continue
                    stop = np.minimum(some + longest + edits, ends[doc[some]])
                    signed = words.view(np.int64)
                    yield pa.RecordBatch.from_arrays([
                        pa.array([ids[doc[some[r]]] for r in rows], pa.int64()),
                        pa.array(some[rows] - (ends - lengths)[doc[some[rows]]], pa.int64()),
                        pa.array([signed[some[r] : stop[r]] for r in rows], pa.list_(pa.int64())),
                        pa.array([keys[r][hit[r]].view(np.int64) for r in rows], pa.list_(pa.int64())),
                    ], names=["doc_id", "start", "words", "keys"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, start long, words array<long>, keys array<long>")


def edit_distances(items: list[np.ndarray], passages: list[np.ndarray]) -> np.ndarray:
    """Word edits from each item to the closest beginning of its passage."""
    n, longest, width = len(items), max(map(len, items), default=0), max(map(len, passages), default=0)
    left, right = np.zeros((n, longest), np.int64), np.zeros((n, width), np.int64)
    for k, (item, passage) in enumerate(zip(items, passages)):
        left[k, : len(item)], right[k, : len(passage)] = item, passage
    size, beyond = np.array([len(i) for i in items]), np.arange(width + 1) > np.array([len(p) for p in passages])[:, None]
    ramp = np.arange(width + 1)
    row, best = np.tile(ramp, (n, 1)), np.zeros(n, np.int64)
    for i in range(longest):
        changed = np.minimum(row[:, :-1] + (right != left[:, i : i + 1]), row[:, 1:] + 1)
        row = np.minimum.accumulate(np.hstack([np.full((n, 1), i + 1), changed]) - ramp, axis=1) + ramp
        best = np.where(size == i + 1, np.where(beyond, longest + width, row).min(axis=1), best)
    return best


def verified(candidates: DataFrame) -> DataFrame:
    """doc_id, start, item_id, item_size and edits of the candidates that are close enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, 512):
                batch = whole.slice(start, 512)
                items = [np.array(x, np.int64) for x in batch.column("item_words").to_pylist()]
                edits = edit_distances(items, [np.array(x, np.int64) for x in batch.column("words").to_pylist()])
                close = pa.array(edits <= np.array([allowed(len(i)) for i in items]))
                columns = [*(batch.column(c) for c in ("doc_id", "start", "item_id")), pa.array([len(i) for i in items], pa.int64()), pa.array(edits, pa.int64())]
                yield pa.RecordBatch.from_arrays([c.filter(close) for c in columns], names=["doc_id", "start", "item_id", "item_words", "edits"])

    return candidates.mapInArrow(run, "doc_id long, start long, item_id long, item_words long, edits long")


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Items of ``benchmark`` (item_id, text) that documents (doc_id, text) hold, up to ERRORS of their words.

    Texts are word sequences without case and punctuation; characters of scripts
    without spaces are words.  Items are embedded
    by random walks, which turn word edits into differing places; WALKS samples
    of PLACES places each are the keys of an item.  Windows of the items' sizes
    at every word of every document that share a key are compared with the item
    by exact edit distance.

    Returns a row for each document and item found: doc_id, item_id, start
    (word where the closest passage begins, the first of several), item_words,
    edits, similarity (1 - edits / item_words), contaminated (true).  Null and
    empty texts hold nothing and are held by nothing; items below SHORT words
    must occur unchanged.  Rows that repeat a doc_id or item_id are taken
    together.  An empty benchmark gives no rows.  Runs jobs.
    """
    items = stage(indexed(benchmark), "benchmark-items")
    sizes = sorted(r["size"] for r in items.select("size").distinct().collect())
    word_map = bitmap_of(items.select(F.explode("item_words").alias("h")), "h")
    pair_map = bitmap_of(items.select(F.explode("pairs").alias("h")), "h")
    keys = items.select("item_id", F.explode("keys").alias("key"))
    key_map = bitmap_of(keys, "key")
    found = stage(windows(docs.select("doc_id", "text"), sizes, word_map, pair_map, key_map), "windows")
    pairs = found.select("doc_id", "start", "words", F.explode("keys").alias("key")).join(stage(keys, "benchmark-keys"), "key")
    pairs = pairs.select("doc_id", "start", "item_id", "words").distinct()
    close = verified(pairs.join(items.select("item_id", "item_words"), "item_id"))
    best = close.groupBy("doc_id", "item_id").agg(F.min(F.struct("edits", "start", "item_words")).alias("b"))
    similarity = 1 - F.col("b.edits") / F.col("b.item_words")
    return best.select("doc_id", "item_id", "b.start", "b.item_words", "b.edits", similarity.alias("similarity"), F.lit(True).alias("contaminated"))
