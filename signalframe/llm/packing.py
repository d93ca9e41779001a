"""Best-fit packing of documents into sequences of several permitted lengths."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterator, Sequence
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from signalframe.plans.staging import stage

#: Permitted sequence lengths.
CAPACITIES = (512, 1024, 2048, 4096, 8192)
#: Cost of a sequence besides its length, in tokens.
OVERHEAD = 64
#: Groups into which the pieces of one length are dealt for numbering.
DEALT = 4096


def token_count(text: Column) -> Column:
    """Runs of letters and digits, and other signs one by one; null counts as empty."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[\p{L}\p{N}]+|[^\s\p{L}\p{N}]")).cast("long")


class Plan:
    """Bins that hold the same lengths, with how many there are, and the places each length got.

    ``runs`` has a row for each stretch of pieces: length, first rank of the
    stretch, pieces a bin, first bin, position in the bin.  Bins are numbered
    by ``bins``: first bin, number, content, capacity.
    """

    def __init__(self, runs: np.ndarray, bins: np.ndarray):
        self.runs, self.bins = runs, bins


def best_fit(counts: dict[int, int], opened: Callable[[int], int]) -> tuple[list[list[int]], list[tuple[int, int, int]]]:
    """Place equal pieces, longest first, into the open bins that they fill best; else open one of size ``opened(length)``.

    Bins in the same state are one entry, split when only some of them get a
    piece, so the work depends on the number of lengths and not on that of
    pieces.  A state keeps its bins as one range of numbers; pieces go to a
    range in order.  Returns the runs and the closed bins (first, number, content).
    """
    runs: list[list[int]] = []
    states: dict[int, list[list[int]]] = defaultdict(list)  # room -> [first bin, number, content]
    following = 0
    for length in sorted((x for x in counts if counts[x]), reverse=True):
        left, rank = counts[length], 0

        def fill(state: list[int], room: int) -> None:
            """Put pieces into the bins of a state: as many as fit into each bin, then what is left into one."""
            nonlocal left, rank
            first, number, content = state
            each = room // length
            full = min(number, left // each)
            if full:
                runs.append([length, rank, each, first, content])
                rank, left = rank + full * each, left - full * each
                states[room - each * length].append([first, full, content + each * length])
            if full < number and left:  # fewer pieces than one bin takes
                runs.append([length, rank, left, first + full, content])
                states[room - left * length].append([first + full, 1, content + left * length])
                rank, left, full = rank + left, 0, full + 1
            if full < number:
                states[room].append([first + full, number - full, content])

        for room in sorted(r for r in states if r >= length and states[r]):
            if not left:
                break
            for state in states.pop(room):
                if left:
                    fill(state, room)
                else:
                    states[room].append(state)
        if left:
            size = opened(length)
            number = -(-left // (size // length))
            following += number
            fill([following - number, number, 0], size)
    return runs, [(first, number, content) for same in states.values() for first, number, content in same]


def plan(counts: dict[int, int], capacities: Sequence[int] = CAPACITIES, overhead: int = OVERHEAD) -> Plan:
    """The cheapest of the packings that open bins of some of the permitted lengths.

    Tried are all sets of lengths that hold the longest piece, each with two
    rules for the size to open: the cheapest a token if filled with pieces of
    that length, and the largest of the set.  Afterwards every bin shrinks to
    the smallest permitted length that holds its contents; the total of those
    lengths, with ``overhead`` a bin, is the cost.
    """
    capacities = sorted(set(capacities))
    longest, best = max((x for x in counts if counts[x]), default=0), None
    for k in range(1, len(capacities) + 1):
        for chosen in combinations(capacities, k):
            if chosen[-1] < longest:
                continue
            rules = [lambda length, c=chosen: max(c)]
            if k > 1:
                rules.append(lambda length, c=chosen: min((x for x in c if x >= length), key=lambda x: ((x + overhead) / (x // length * length), x)))
            for rule in rules:
                runs, bins = best_fit(counts, rule)
                sized = [(first, number, content, next(c for c in capacities if c >= content)) for first, number, content in bins]
                cost = sum(number * (size + overhead) for _, number, _, size in sized)
                if best is None or cost < best[0]:
                    best = cost, runs, sized
    _, runs, sized = best or (0, [], [])
    return Plan(np.array(sorted(runs), np.int64).reshape(-1, 5), np.array(sorted(sized), np.int64).reshape(-1, 4))


def pieces(counted: DataFrame, longest: int) -> DataFrame:
    """doc_id, piece, piece_start, length: documents above ``longest`` tokens are cut into pieces, none is lost."""
    n = F.greatest(F.ceil(F.col("n_tokens") / longest), F.lit(1))
    cut = counted.select("doc_id", "n_tokens", F.explode(F.sequence(F.lit(0), (n - 1).cast("int"))).alias("piece"))
    start = F.col("piece").cast("long") * longest
    return cut.select("doc_id", "piece", start.alias("piece_start"), F.least(F.lit(longest).cast("long"), F.col("n_tokens") - start).alias("length"))


def ranked(cut: DataFrame) -> DataFrame:
    """Number the pieces of each length from 0, in ``rank``.

    Pieces of a length are dealt into DEALT groups by hash, numbered there, and
    the groups' sizes are added up, so that a length that many pieces share is
    no single task.
    """
    dealt = stage(cut.withColumn("_group", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(DEALT)).cast("int")), "pieces")
    sizes = dealt.groupBy("length", "_group").agg(F.count("*").alias("_n"))
    before = F.coalesce(F.sum("_n").over(W.partitionBy("length").orderBy("_group").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    sizes = stage(sizes.select("length", "_group", before.alias("_before")), "piece-groups")
    number = F.row_number().over(W.partitionBy("length", "_group").orderBy("doc_id", "piece")) - 1
    numbered = dealt.withColumn("_rank", number.cast("long"))
    return numbered.join(sizes, ["length", "_group"]).withColumn("rank", F.col("_rank") + F.col("_before")).drop("_group", "_rank", "_before")


def placed(numbered: DataFrame, made: Plan) -> DataFrame:
    """Look up the bin and position of every numbered piece in the plan."""
    runs, bins = made.runs, made.bins

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shift = np.int64(40)
        keys, firsts = (runs[:, 0] << shift) + runs[:, 1], bins[:, 0]
        for batch in batches:
            length, rank = batch.column("length").to_numpy(zero_copy_only=False), batch.column("rank").to_numpy(zero_copy_only=False)
            at = runs[np.searchsorted(keys, (length << shift) + rank, side="right") - 1]
            place = rank - at[:, 1]
            bin_id, offset = at[:, 3] + place // at[:, 2], at[:, 4] + place % at[:, 2] * length
            own = bins[np.searchsorted(firsts, bin_id, side="right") - 1]
            kept = [batch.column(c) for c in ("doc_id", "piece", "piece_start", "length")]
            yield pa.RecordBatch.from_arrays(
                [*kept, *map(pa.array, (bin_id, offset, own[:, 3], own[:, 2]))],
                names=["doc_id", "piece", "piece_start", "length", "bin_id", "bin_offset", "bin_capacity", "bin_tokens"],
            )

    kept = numbered.select("doc_id", "piece", "piece_start", "length", "rank")
    fields = ", ".join(f"{n} {t}" for n, t in kept.dtypes if n != "rank")
    return kept.mapInArrow(run, f"{fields}, bin_id long, bin_offset long, bin_capacity long, bin_tokens long")


def packed(counted: DataFrame, capacities: Sequence[int] = CAPACITIES, overhead: int = OVERHEAD) -> DataFrame:
    """Pack documents (doc_id, n_tokens) into bins of the permitted lengths, by best fit over all of them.

    Documents above the largest length are cut into pieces of it.  The pieces
    are counted by length, at most as many rows as the largest length has
    tokens.  Best-fit decreasing runs on those counts: its states are groups
    of equal bins, so it packs all of the corpus as one.  Every piece then
    finds its place by its rank among the pieces of its length.

    Returns a row for each piece: doc_id, piece, piece_start, length, bin_id,
    bin_offset, bin_capacity, bin_tokens.  Documents without tokens (null,
    negative or zero counts) have no piece.  Rows that repeat a doc_id are packed
    each, in any order among equal lengths.  No documents, no rows.  Runs jobs.
    """
    counted = counted.filter("n_tokens > 0").select("doc_id", F.col("n_tokens").cast("long"))
    numbered = stage(ranked(pieces(counted, max(capacities))), "numbered-pieces")
    counts = {r["length"]: r["count"] for r in numbered.groupBy("length").count().collect()}
    return placed(numbered, plan(counts, capacities, overhead))
