"""A trie of conversation prefixes: heads burst by aggregation, suffix containers sorted and swept."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from signalframe.plans.running import running_sums
from signalframe.plans.staging import stage

#: Turns that a container holds; a larger one bursts.
CONTAINER_TURNS = 256
#: Conversation ids in one piece of a node's list of ends.
PIECE_IDS = 50_000

LANES = [f"_lane{i}" for i in range(4)]
_NOTHING = hashlib.sha256(b"").hexdigest()


# --- conversations as rows of turns --------------------------------------------------

def turn_id(role: Column, text: Column) -> Column:
    """Sixteen bytes that stand for a turn; role and text are not null."""
    return F.substring(F.unhex(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256)), 1, 16)


def ordered_turns(conversations: DataFrame) -> DataFrame:
    """conv_id, pos (from 1), turn id and bytes of the text; the text itself moves no further."""
    role, text = (F.coalesce(c, F.lit("")) for c in ("role", "text"))
    turns = conversations.filter("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", turn_id(role, text).alias("id"), F.octet_length(text).cast("long").alias("bytes"))
    return running_sums(turns, ["turn", "id"], {"pos": F.lit(1)}, ["conv_id"]).drop("turn")


def rebuilt(turns: DataFrame, every: int = 5, most: int = 9) -> DataFrame:
    """conv_id, depth, id, bytes of each conversation with its first turns taken from the first of its family.

    The first h turns come from conversation c - c % ``every`` (as far as it
    has them), the others are c's own after its first h; h = crc32(c) % ``most``.
    Every conversation also has a row of depth 0.  ``size`` is its number of turns.
    """
    own = turns.groupBy("conv_id").agg(F.max("pos").alias("length"))
    own = own.select("conv_id", "length", (F.col("conv_id") - F.col("conv_id") % every).alias("first"),
                     (F.crc32(F.col("conv_id").cast("string").cast("binary")) % most).alias("h"))
    lengths = own.select(F.col("conv_id").alias("first"), F.col("length").alias("first_length"))
    taken = F.least("h", F.coalesce("first_length", F.lit(0).cast("long")))
    families = stage(own.join(lengths, "first", "left").select(
        "conv_id", "first", "h", taken.alias("taken"), (taken + F.greatest(F.col("length") - F.col("h"), F.lit(0))).alias("size")), "families")
    # at most most - 1 turns of a conversation, and fewer than 2 * every conversations a family
    heads = turns.filter(F.col("pos") < most).select(F.col("conv_id").alias("first"), "pos", "id", "bytes")
    shared = heads.join(families, "first").filter(F.col("pos") <= F.col("h"))
    rest = turns.join(families.drop("first"), "conv_id").filter(F.col("pos") > F.col("h"))
    return (
        families.select("conv_id", F.lit(0).cast("long").alias("depth"), F.lit(b"").alias("id"), F.lit(0).cast("long").alias("bytes"), "size")
        .unionAll(shared.select("conv_id", F.col("pos").alias("depth"), "id", "bytes", "size"))
        .unionAll(rest.select("conv_id", (F.col("taken") + F.col("pos") - F.col("h")).alias("depth"), "id", "bytes", "size"))
    )


def prefix_keys(rows: DataFrame) -> DataFrame:
    """Add to each (conv_id, depth, id) the key of its prefix and that of the prefix before: equal keys, equal prefixes.

    A key digests the sums of four 32-bit parts of the hashes of (depth, turn)
    up to it, 128 bits together.  Sums run over range partitions, so a
    conversation with very many turns is spread over tasks.
    """
    mixed = F.md5(F.concat(F.col("depth").cast("string"), F.lit(":"), F.hex("id")))
    own = [F.when(F.col("depth") > 0, F.conv(F.substring(mixed, 8 * i + 1, 8), 16, 10).cast("long")).otherwise(0) for i in range(4)]
    summed = running_sums(stage(rows, "rebuilt"), ["depth"], dict(zip(LANES, own)), ["conv_id"])

    def key(depth: Column, lanes: list[Column]) -> Column:
        return F.unhex(F.md5(F.concat_ws(",", depth, *lanes)))

    before = [F.col(c) - x for c, x in zip(LANES, own)]
    return summed.select(
        "conv_id", "depth", "bytes", "size", key(F.col("depth"), [F.col(c) for c in LANES]).alias("key"),
        F.when(F.col("depth") > 0, key(F.col("depth") - 1, before)).alias("parent"))


# --- bursting ---------------------------------------------------------------------

def landmark(depth: Column) -> Column:
    """Depths at which containers may hang: 0, 1, 2, 4, 8, ..."""
    return depth.bitwiseAND(depth - 1) == 0


def burst(rows: DataFrame, limit: int) -> DataFrame:
    """Add to each row the depth and key of the container that takes its conversation's suffix.

    A container hangs under a head and holds the turns that follow it.  One
    with more than ``limit`` turns bursts by the next turn ids, as far as the
    next landmark; all containers at all landmarks are weighed in one
    aggregate, and a conversation's suffix goes to the first one that is small
    enough.  ``at`` is its depth, or the conversation's size if none is:
    turns up to ``at`` are nodes of heads.
    """
    marks = rows.filter(landmark(F.col("depth")) | (F.col("depth") == 0)).select("conv_id", "depth", "size", "key")
    weights = stage(marks.groupBy("key").agg(
        F.sum(F.col("size") - F.col("depth")).alias("weight"), F.min("conv_id").alias("head_conv")), "container-weights")
    small = F.when(F.col("weight") <= limit, F.struct("depth", "key", "head_conv"))
    ends = marks.join(weights, "key").groupBy("conv_id").agg(F.min(small).alias("c"), F.max("size").alias("_size"))
    ends = stage(ends.select("conv_id", F.coalesce("c.depth", "_size").alias("at"), F.col("c.key").alias("head"), "c.head_conv"), "containers")
    return rows.join(ends, "conv_id")


# --- containers -------------------------------------------------------------------

_SWEPT = [
    ("head", pa.binary()), ("conv_id", pa.int64()), ("depth", pa.int64()), ("parent_conv_id", pa.int64()), ("n_convs", pa.int64()),
    ("n_children", pa.int64()), ("n_leaves", pa.int64()), ("saved_tokens", pa.int64()), ("ends_sha256", pa.string())]
_SWEPT_DDL = ("head binary, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, "
              "saved_tokens long, ends_sha256 string")


def ends_digest(ids: list[int]) -> str:
    return hashlib.sha256(",".join(map(str, sorted(ids))).encode()).hexdigest()


class Container:
    """Nodes of one container, from its suffixes in sorted order."""

    def __init__(self, head: bytes, head_conv: int, at: int):
        self.head, self.head_conv, self.at = head, head_conv, at
        self.open: list[int] = []  # nodes on the path of the last suffix
        self.last: list[bytes] = []
        self.parent, self.least, self.n, self.children, self.bytes, self.ends = [], [], [], [], [], []

    def add(self, conv: int, keys: list[bytes], sizes: list[int]) -> None:
        same = 0
        while same < min(len(keys), len(self.last)) and keys[same] == self.last[same]:
            same += 1
        del self.open[same:]
        for size in sizes[same:]:
            parent = self.open[-1] if self.open else -1
            if parent >= 0:
                self.children[parent] += 1
            self.open.append(len(self.parent))
            for column, value in ((self.parent, parent), (self.least, conv), (self.n, 0), (self.children, 0), (self.bytes, size), (self.ends, [])):
                column.append(value)
        for node in self.open:
            self.n[node] += 1
            self.least[node] = min(self.least[node], conv)
        self.ends[self.open[-1]].append(conv)
        self.last = keys

    def rows(self) -> Iterator[tuple]:
        """A row for each node; one with ``head`` and the sums of the container, and no depth."""
        leaves = [int(c == 0) for c in self.children]
        saved = [(n - 1) * b for n, b in zip(self.n, self.bytes)]
        depth: list[int] = []
        for p in self.parent:
            depth.append(self.at + 1 if p < 0 else depth[p] + 1)
        total = [0, 0, 0]
        for k in reversed(range(len(self.parent))):  # a node comes after its parent
            p = self.parent[k]
            if p >= 0:
                leaves[p] += leaves[k]
                saved[p] += saved[k]
            else:
                total = [total[0] + 1, total[1] + leaves[k], total[2] + saved[k]]
            yield (None, self.least[k], depth[k], self.head_conv if p < 0 else self.least[p], self.n[k], self.children[k],
                   leaves[k], saved[k], ends_digest(self.ends[k]) if self.ends[k] else _NOTHING)
        yield (self.head, None, None, None, None, *total, None)


def swept(rows: DataFrame) -> DataFrame:
    """The nodes below ``at`` of rows with containers: each container's suffixes meet in one task, sorted, and are swept once."""
    below = rows.filter(F.col("depth") > F.col("at"))
    suffix = F.sort_array(F.collect_list(F.struct("depth", "key", "bytes")))
    # a suffix has at most the turns of its container
    suffixes = below.groupBy("head", "conv_id").agg(F.first("head_conv").alias("head_conv"), F.first("at").alias("at"), suffix.alias("s"))
    laid = suffixes.select("head", "conv_id", "head_conv", "at", F.col("s.key").alias("keys"), F.col("s.bytes").alias("sizes"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, (_, t) in enumerate(_SWEPT)], names=[n for n, _ in _SWEPT])

        now = None
        for batch in batches:
            made: list[tuple] = []
            for r in batch.to_pylist():
                if now is None or now.head != r["head"]:
                    made += now.rows() if now else ()
                    now = Container(r["head"], r["head_conv"], r["at"])
                now.add(r["conv_id"], r["keys"], r["sizes"])
            yield out(made)
        if now:
            yield out(list(now.rows()))

    return laid.repartition("head").sortWithinPartitions("head", "keys", "conv_id").mapInArrow(run, _SWEPT_DDL)


# --- heads ------------------------------------------------------------------------

def head_ends(rows: DataFrame) -> DataFrame:
    """key and digest of the sorted ids of the conversations that end at each head node.

    Ids are range-partitioned, so those of one node are spread, and joined to
    pieces of text; a node's pieces are then digested one after the other.
    """
    ends = stage(rows.filter((F.col("depth") == F.col("size")) & (F.col("depth") <= F.col("at"))).select("key", "conv_id"), "ends")

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, ids = None, []

        def flush() -> tuple:
            return key, ids[0], ",".join(map(str, ids))

        for batch in batches:
            made = []
            for k, c in zip(batch.column("key").to_pylist(), batch.column("conv_id").to_pylist()):
                if ids and (k != key or len(ids) == PIECE_IDS):
                    made.append(flush())
                    ids = []
                key = k
                ids.append(c)
            yield pa.RecordBatch.from_arrays([pa.array([m[i] for m in made], t) for i, t in enumerate((pa.binary(), pa.int64(), pa.string()))], names=["key", "first", "piece"])
        if ids:
            yield pa.RecordBatch.from_pylist([dict(zip(("key", "first", "piece"), flush()))], pa.schema([("key", pa.binary()), ("first", pa.int64()), ("piece", pa.string())]))

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, digest = None, None
        shape = pa.schema([("key", pa.binary()), ("ends_sha256", pa.string())])
        for batch in batches:
            made = []
            for k, piece in zip(batch.column("key").to_pylist(), batch.column("piece").to_pylist()):
                if digest is None or k != key:
                    made += [{"key": key, "ends_sha256": digest.hexdigest()}] if digest else []
                    key, digest = k, hashlib.sha256(piece.encode())
                else:
                    digest.update(b"," + piece.encode())
            yield pa.RecordBatch.from_pylist(made, shape)
        if digest:
            yield pa.RecordBatch.from_pylist([{"key": key, "ends_sha256": digest.hexdigest()}], shape)

    cut = ends.repartitionByRange("key", "conv_id").sortWithinPartitions("key", "conv_id").mapInArrow(pieces, "key binary, first long, piece string")
    return cut.repartition("key").sortWithinPartitions("key", "first").mapInArrow(digests, "key binary, ends_sha256 string")


def head_nodes(rows: DataFrame, totals: DataFrame) -> DataFrame:
    """The nodes down to ``at``; ``totals`` has the sums of the containers (head, n_children, n_leaves, saved_tokens)."""
    heads = rows.filter(F.col("depth") <= F.col("at"))
    nodes = stage(heads.groupBy("key").agg(
        F.min("conv_id").alias("conv_id"), F.min("depth").alias("depth"), F.min("parent").alias("parent"), F.min("bytes").alias("bytes"),
        F.count("*").alias("n_convs")), "head-nodes")
    zero = F.lit(0).cast("long")
    below = nodes.filter("parent is not null").select(F.col("parent").alias("key"), F.lit(1).cast("long").alias("c"), zero.alias("l"), zero.alias("s"))
    below = below.unionAll(totals.select(F.col("head").alias("key"), "n_children", "n_leaves", "saved_tokens"))
    below = stage(below.groupBy("key").agg(*[F.sum(c).alias(c) for c in "cls"]), "below-heads")
    own = nodes.join(below, "key", "left").select(
        *nodes.columns, F.coalesce("c", zero).alias("n_children"),
        (F.coalesce("l", zero) + F.when(F.coalesce("c", zero) == 0, 1).otherwise(0)).alias("leaves"),
        (F.coalesce("s", zero) + (F.col("n_convs") - 1) * F.col("bytes")).alias("saved"))
    own = stage(own, "head-sums")
    # a node's value stands at its smallest conversation; summed up each conversation from its end, and then over a
    # node's conversations, it counts once for each node above
    value = own.select("conv_id", "depth", "leaves", "saved")
    path = heads.select("conv_id", "depth", "key").join(value, ["conv_id", "depth"], "left")
    path = stage(path.select("conv_id", (-F.col("depth")).alias("up"), "key", F.coalesce("leaves", zero).alias("l"), F.coalesce("saved", zero).alias("s")), "head-paths")
    summed = running_sums(path, ["up"], {"l_up": F.col("l"), "s_up": F.col("s")}, ["conv_id"])
    trees = summed.groupBy("key").agg(F.sum("l_up").alias("n_leaves"), F.sum("s_up").alias("saved_tokens"))
    above = nodes.select(F.col("key").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    out = own.join(stage(trees, "head-trees"), "key").join(stage(head_ends(rows), "head-ends"), "key", "left").join(above, "parent", "left")
    return out.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                      F.coalesce("ends_sha256", F.lit(_NOTHING)).alias("ends_sha256"))


def prefix_trie(conversations: DataFrame, limit: int = CONTAINER_TURNS) -> DataFrame:
    """A row for each distinct beginning of the rebuilt conversations (conv_id, turn, role, text).

    Turns are put in order, null first, rows of equal turn by the digest of role
    and text; null role and text are empty.  The first h turns of each conversation
    are taken from the first of its family, see ``rebuilt``.  Rows without
    conv_id belong to no conversation and are left out; an empty table has no
    node, not even the root.  Repeated rows are turns of their own.

    A burst trie: containers hold the suffixes below a head, and one with more
    than ``limit`` turns bursts by the next turn ids.  Heads are aggregates, so
    a beginning, or a whole conversation, that very many share never meets in
    one task; what is left in a container is sorted and swept by one.  Only
    digests of turns move, never texts.

    Returns conv_id (smallest member), depth, parent_conv_id (null for the
    root), n_convs, n_children, n_leaves, saved_tokens and ends_sha256.  Runs
    jobs; intermediate tables are stored in the shared folder.
    """
    turns = stage(ordered_turns(conversations.select("conv_id", "turn", "role", "text")), "turns")
    keyed = stage(prefix_keys(rebuilt(turns)), "prefix-keys")
    rows = stage(burst(keyed, limit), "burst")
    found = stage(swept(rows), "swept")
    totals = found.filter("depth is null").select("head", "n_children", "n_leaves", "saved_tokens")
    return head_nodes(rows, totals).unionAll(found.filter("depth is not null").drop("head"))
