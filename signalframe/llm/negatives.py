"""Hard-negative mining with exact integer scores from subset-sum tables."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from signalframe.plans.staging import stage

#: A component x becomes floor(SCALE * x).
SCALE = 256
#: Dimensions of one subset-sum table.
GROUP = 8
#: Rows of one packed block, rows and anchors that meet in one cell of the grid, and the least number of cells.
BLOCK_ROWS, CELL_ROWS, CELL_ANCHORS, LEAST_CELLS = 2048, 8192, 512, 64
#: Anchors and rows that are scored at once, so that tables and sums stay in a core's cache.
ANCHORS_AT_ONCE, ROWS_AT_ONCE = 128, 1024

_BLOCK = "n int, planes int, groups int, bits binary, ids array<long>, labels array<long>, anchors array<int>"
_ANCHOR = "block long, at int, anchor_id long, label long, vector array<long>"


# --- packing ---------------------------------------------------------------------

def pack(vectors: np.ndarray) -> tuple[int, bytes]:
    """Rows of integers as bit planes, lowest plane first, the last one the sign: bytes [plane, group, row]."""
    planes = int(max(int(vectors.max(initial=0)), -int(vectors.min(initial=0)) - 1)).bit_length() + 1
    packed = [np.packbits((vectors >> k & 1).astype(np.uint8), axis=1, bitorder="little").T for k in range(planes)]
    return planes, np.ascontiguousarray(np.stack(packed)).tobytes()


def unpack(planes: int, groups: int, n: int, bits: bytes, at: np.ndarray) -> np.ndarray:
    """The integers of the rows ``at``."""
    rows = np.frombuffer(bits, np.uint8).reshape(planes, groups, n)[:, :, at]
    bit = np.unpackbits(np.ascontiguousarray(rows.transpose(0, 2, 1)), axis=2, bitorder="little").astype(np.int64)
    return sum((bit[k] << k) * (-1 if k == planes - 1 else 1) for k in range(planes))


def padded(lists: pa.Array, width: int) -> np.ndarray:
    """Lists of doubles as floor(SCALE * x); a shorter one ends in zeros."""
    starts, values = lists.offsets.to_numpy(), lists.values.to_numpy(zero_copy_only=False)
    if len(values) and not np.abs(values).max() * SCALE < 2.0**62:
        raise OverflowError("a component does not fit in 64 bits")
    sizes = np.diff(starts)
    out = np.zeros((len(sizes), width), np.int64)
    row = np.repeat(np.arange(len(sizes)), sizes)
    out[row, np.arange(len(row)) - np.repeat(starts[:-1] - starts[0], sizes)] = np.floor(values[starts[0] : starts[-1]] * SCALE)
    return out


def blocks(rows: DataFrame, every: int) -> DataFrame:
    """Rows (vec_id, label, vector) packed into blocks of BLOCK_ROWS or fewer, where they are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [x.split()[0] for x in _BLOCK.split(", ")]
        for batch in batches:
            for start in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.slice(start, BLOCK_ROWS)
                ids, lists = part.column("vec_id"), part.column("vector")
                groups = max(1, -(-int(np.diff(lists.offsets.to_numpy()).max()) // GROUP))
                planes, bits = pack(padded(lists, groups * GROUP))
                held = [i for i, x in enumerate(ids.to_pylist()) if x is not None and x % every == 0]
                cells = [[part.num_rows], [planes], [groups], [bits], [ids.to_pylist()], [part.column("label").to_pylist()], [held]]
                types = [pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.int32())]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cells, types)], names=names)

    return rows.mapInArrow(run, _BLOCK)


def anchors_of(packed: DataFrame) -> DataFrame:
    """The anchors of packed blocks, a row each with its integers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in batch.to_pylist():
                at = np.array(b["anchors"], np.int64)
                vectors = unpack(b["planes"], b["groups"], b["n"], b["bits"], at)
                cells = [[b["block"]] * len(at), at.tolist(), [b["ids"][i] for i in at], [b["labels"][i] for i in at], vectors.tolist()]
                types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64())]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cells, types)], names=["block", "at", "anchor_id", "label", "vector"])

    return packed.filter(F.size("anchors") > 0).mapInArrow(run, _ANCHOR)


# --- scoring ---------------------------------------------------------------------

def tables(anchors: np.ndarray, kind: type) -> np.ndarray:
    """For each group of dimensions the sums of all subsets of the anchors' components: [group, subset, anchor]."""
    n, width = anchors.shape
    out = np.zeros((width // GROUP, 1 << GROUP, n), kind)
    for g in range(width // GROUP):
        for k in range(GROUP):
            np.add(out[g, : 1 << k], anchors[:, g * GROUP + k].astype(kind), out=out[g, 1 << k : 2 << k])
    return out


def scores(table: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """Exact inner products [row, anchor]: look up each byte's subset sum, plane by plane from the sign down, and shift."""
    planes, groups, n = bits.shape
    total, plane, got = (np.zeros((n, table.shape[2]), table.dtype) for _ in range(3))
    for k in reversed(range(planes)):
        np.take(table[0], bits[k, 0], axis=0, out=plane, mode="clip")
        for g in range(1, groups):
            np.take(table[g], bits[k, g], axis=0, out=got, mode="clip")
            plane += got
        if k == planes - 1:
            np.negative(plane, out=total)
        else:
            total <<= 1
            total += plane
    return total


class Rows:
    """The rows of a cell as one set of bit planes, smaller ids first, a null id last."""

    def __init__(self, found: list[dict], width: int):
        groups = max([width // GROUP, *(b["groups"] for b in found)])
        self.planes, self.groups = max(b["planes"] for b in found), groups
        self.n = sum(b["n"] for b in found)
        bits = np.zeros((self.planes, groups, self.n), np.uint8)
        start = 0
        for b in found:
            part = np.frombuffer(b["bits"], np.uint8).reshape(b["planes"], b["groups"], b["n"])
            here = slice(start, start + b["n"])
            bits[: b["planes"], : b["groups"], here] = part
            bits[b["planes"] :, : b["groups"], here] = part[-1]  # the sign goes on
            start += b["n"]
        ids = [i for b in found for i in b["ids"]]
        order = np.lexsort((np.array([i or 0 for i in ids], np.int64), np.array([i is None for i in ids])))
        self.ids = [ids[i] for i in order]
        self.labels = np.array([x for b in found for x in b["labels"]], np.int64)[order]
        self.block = np.repeat([b["block"] for b in found], [b["n"] for b in found])[order]
        self.at = np.concatenate([np.arange(b["n"]) for b in found])[order]
        self.bits = np.ascontiguousarray(bits[:, :, order])

    def kind(self, anchors: np.ndarray) -> type:
        """The integer type that no sum overflows."""
        most = max((sum(map(abs, a.tolist())) for a in anchors), default=0) << self.planes
        if most >= 1 << 63:
            raise OverflowError("a score does not fit in 64 bits")
        return np.int32 if most < 1 << 31 else np.int64

    def scored(self, anchors: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """Scores [anchor, row] of the given rows."""
        table, out = tables(anchors, self.kind(anchors)), np.empty((len(anchors), len(rows)), np.int64)
        for start in range(0, len(rows), ROWS_AT_ONCE):
            part = rows[start : start + ROWS_AT_ONCE]
            out[:, start : start + len(part)] = scores(table, self.bits[:, :, part]).T
        return out


def _together(anchors: list[dict], width: int) -> np.ndarray:
    out = np.zeros((len(anchors), width), np.int64)
    for i, a in enumerate(anchors):
        out[i, : len(a["vector"])] = a["vector"]
    return out


def _best(values: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k greatest values, the first of equal ones first."""
    if len(values) > 4 * k:
        least = np.partition(values, len(values) - k)[len(values) - k]
        near = np.flatnonzero(values >= least)
        return near[np.argsort(-values[near], kind="stable")[:k]]
    return np.argsort(-values, kind="stable")[:k]


def nearest_same(anchors: list[dict], rows: Rows, k: int) -> Iterator[tuple]:
    """The k best rows of each anchor's own label, itself left out."""
    by_label: dict[int, list[dict]] = {}
    for a in anchors:
        by_label.setdefault(a["label"], []).append(a)
    for label, own in by_label.items():
        same = np.flatnonzero(rows.labels == label)
        for start in range(0, len(own) if len(same) else 0, ANCHORS_AT_ONCE):
            part = own[start : start + ANCHORS_AT_ONCE]
            for a, values in zip(part, rows.scored(_together(part, rows.groups * GROUP), same)):
                others = np.flatnonzero((rows.block[same] != a["block"]) | (rows.at[same] != a["at"]))
                for j in others[_best(values[others], k)]:
                    yield a["block"], a["at"], rows.ids[same[j]], int(values[j])


def nearest_other(anchors: list[dict], rows: Rows, k: int, low: int, high: int) -> Iterator[tuple]:
    """For each positive of each anchor the k best rows of another label between ``low`` and ``high`` per cent of its score."""
    every = np.arange(rows.n)
    for start in range(0, len(anchors), ANCHORS_AT_ONCE):
        part = anchors[start : start + ANCHORS_AT_ONCE]
        for a, values in zip(part, rows.scored(_together(part, rows.groups * GROUP), every)):
            bounds = {p["score"]: (-(-low * p["score"] // 100), high * p["score"] // 100) for p in a["positives"]}
            allowed = (rows.labels != a["label"]) & (values >= min(x for x, _ in bounds.values())) & (values <= max(y for _, y in bounds.values()))
            near = np.flatnonzero(allowed)
            near = near[np.argsort(-values[near], kind="stable")]
            falling = -values[near]
            for rank, p in enumerate(a["positives"]):
                least, most = bounds[p["score"]]
                first = np.searchsorted(falling, -most, "left")
                for j in near[first : first + k]:
                    if values[j] < least:
                        break
                    yield a["block"], a["at"], a["anchor_id"], rank, p["id"], p["score"], rows.ids[j], int(values[j])


# --- the grid --------------------------------------------------------------------

def in_cells(anchors: DataFrame, packed: DataFrame, across: int, down: int, found, schema: str) -> DataFrame:
    """Let every anchor meet every block: anchors in ``down`` rows, blocks in ``across`` columns of a grid of cells.

    An anchor is copied into each column and a block into each row, and one
    call of ``found`` (anchors, rows) has a cell's share of both.
    """
    names = [x.split()[0] for x in schema.split(", ")]

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        a, b = left.to_pylist(), right.to_pylist()
        made = []
        if a and b:
            rows = Rows(b, max(len(x["vector"]) for x in a))
            made = list(found(a, rows))
        kinds = {"long": pa.int64(), "int": pa.int32()}
        types = [kinds[x.split()[1]] for x in schema.split(", ")]
        return pa.Table.from_arrays([pa.array([m[i] for m in made], t) for i, t in enumerate(types)], names=names)

    def dealt(part: Column, n: int) -> Column:
        return F.pmod(F.xxhash64(part), F.lit(n)).cast("int")

    spot = F.xxhash64("block", "at")
    left = anchors.withColumns({"_r": dealt(spot, down), "_c": F.explode(F.sequence(F.lit(0), F.lit(across - 1)))})
    right = packed.drop("anchors").withColumns({"_c": dealt(F.col("block"), across), "_r": F.explode(F.sequence(F.lit(0), F.lit(down - 1)))})
    return left.groupBy("_r", "_c").cogroup(right.groupBy("_r", "_c")).applyInArrow(run, schema)


def first_rows(df: DataFrame, group: list[str], value: str, key: str, k: int, name: str) -> DataFrame:
    """The k rows of each group with the highest value, ties by smaller key, numbered from 1.

    Spark keeps the first k of a group in each task before the shuffle.
    """
    order = Window.partitionBy(*group).orderBy(F.desc(value), F.asc_nulls_last(key))
    return df.withColumn(name, F.row_number().over(order)).filter(F.col(name) <= k)


def prepared(embeddings: DataFrame) -> DataFrame:
    """vec_id, label and vector of doubles of the rows that take part."""
    vector = F.col("embedding").cast("array<double>")
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    # a null component makes forall null or false, so only what is certainly finite passes
    shifted = F.when(F.col("vec_id") % 7 == 0, (F.col("label").cast("long") + 1) % 10).otherwise(F.col("label").cast("long"))
    rows = embeddings.filter("label is not null and embedding is not null").filter(F.coalesce(finite, F.lit(False)))
    return rows.select(F.col("vec_id").cast("long").alias("vec_id"), shifted.alias("label"), vector.alias("vector"))


def hard_negatives(rows: DataFrame, every: int = 50, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95) -> DataFrame:
    """Hard negatives of rows (vec_id long, label long, vector array<double> of finite numbers).

    Components become floor(256 * x).  A row's score is its exact integer inner
    product with an anchor, a row whose vec_id is divisible by ``every``.  An
    anchor's positives are its ``positives`` best other rows of the same label;
    for each the result has the ``negatives`` best rows of another label whose
    score lies between ``low`` and ``high`` per cent of the positive's.

    Rows are packed into bit planes.  For each group of eight dimensions an
    anchor block has a table of all subset sums; a row's packed byte of a plane
    is the index, and planes are added with shifts.  Anchors and row blocks
    meet in a grid whose cells have a bounded number of both; only a cell's best
    rows leave it.  One pass scores rows of the anchor's label, the next one
    the others, so that a pair is scored about once.

    Ties of score go to the smaller vec_id, a null vec_id last (a row without
    vec_id is no anchor but may be found).  Rows that repeat a vec_id are rows
    of their own: each is an anchor, and each may be positive or negative.  Of
    vectors of unequal length the shorter one counts as ending in zeros.  A
    score beyond 64 bits fails the job.  An anchor without positives, or a
    positive without negatives, has no row; an empty table gives none.

    Returns anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score.  Runs jobs; packed blocks and positives are stored in the
    shared folder.
    """
    rows = rows.select("vec_id", "label", "vector").hint("rebalance")
    packed = stage(blocks(rows, every).withColumn("block", F.monotonically_increasing_id()), "packed-vectors")
    anchors = stage(anchors_of(packed), "anchors")
    n, m = packed.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum(F.size("anchors")), F.lit(0))).first()
    down = max(1, -(-m // CELL_ANCHORS))
    across = max(-(-n // CELL_ROWS), -(-LEAST_CELLS // down))
    spot = ["block", "at"]
    same = in_cells(
        anchors, packed, across, down, lambda a, b: nearest_same(a, b, positives),
        "block long, at int, positive_id long, positive_score long")
    best = first_rows(same, spot, "positive_score", "positive_id", positives, "rank").groupBy(*spot).agg(F.transform(
        F.sort_array(F.collect_list(F.struct("rank", F.col("positive_id").alias("id"), F.col("positive_score").alias("score")))),
        lambda p: F.struct(p["id"].alias("id"), p["score"].alias("score"))).alias("positives"))
    with_best = stage(anchors.join(best, spot), "positives")
    other = in_cells(
        with_best, packed, across, down, lambda a, b: nearest_other(a, b, negatives, low, high),
        "block long, at int, anchor_id long, place int, positive_id long, positive_score long, negative_id long, negative_score long")
    found = first_rows(other, [*spot, "place"], "negative_score", "negative_id", negatives, "rank")
    return found.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
