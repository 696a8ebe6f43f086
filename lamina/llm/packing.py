"""Documents into few sequences of bounded length, by linear grouping.

What is to be packed is known by its lengths alone, and there are no more
lengths than a sequence has places. So the driver plans on the histogram:

1. Large lengths, sorted, are cut into groups of equal cardinality, and each is
   rounded up to the longest of its group: few sizes are left.
2. Configurations of these sizes are chosen one after the other, each the
   fullest that the remaining demand allows (a bounded knapsack), and used as
   often as the demand lasts.
3. The actual lengths take the places of their groups, longest first.
4. Small lengths go, longest first, to the fullest sequences that still hold
   them, and what remains opens new ones.

The plan says for each length which sequences its first, second, ... piece
goes to, in runs of ranks. Spark numbers the pieces of each length and looks
their ranks up; no piece passes the driver.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lamina.llm import frames, wordpieces

CAPACITY = 2048
END = 0  # id that ends a document
SMALL_SHARES = (16, 8, 4, 2)  # lengths up to this part of the capacity are small; the best plan counts
GROUPS = 256
ROWS_PER_RANKING = 50_000  # pieces of one length that one window numbers

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


@dataclass
class Bins:
    """So many sequences that hold pieces of the same lengths, in this order."""

    count: int
    lengths: list[int]


def _groups(large: list[tuple[int, int]], wanted: int) -> list[list[list[int]]]:
    """Runs of ``[length, count]``, longest first, of equal cardinality but for the last."""
    total = sum(n for _, n in large)
    share = -(-total // wanted)
    out: list[list[list[int]]] = []
    room = 0
    for length, n in large:
        while n:
            if not room:
                out.append([])
                room = share
            took = min(n, room)
            out[-1].append([length, took])
            n, room = n - took, room - took
    return out


def _fullest(sizes: np.ndarray, demand: np.ndarray, capacity: int) -> list[int]:
    """How many of each size fill a sequence most, none beyond its demand."""
    # reach[s]: index of the size last added to come to sum s, so that sizes
    # before it stand; found size by size, longest first.
    reach = np.full(capacity + 1, -1)
    used = np.zeros(capacity + 1, np.int64)
    seen = np.zeros(capacity + 1, bool)
    seen[0] = True
    for i in np.flatnonzero(demand > 0):
        size = int(sizes[i])
        fresh_used = np.zeros(capacity + 1, np.int64)
        for _ in range(min(int(demand[i]), capacity // size)):
            new = np.zeros(capacity + 1, bool)
            new[size:] = seen[:-size] & (fresh_used[:-size] < demand[i])
            new &= ~seen
            if not new.any():
                break
            at = np.flatnonzero(new)
            fresh_used[at] = fresh_used[at - size] + 1
            reach[at] = i
            used[at] = fresh_used[at]
            seen |= new
        if seen[capacity]:
            break
    total = int(np.flatnonzero(seen)[-1])
    chosen = [0] * len(sizes)
    while total:
        i = int(reach[total])
        chosen[i] += 1
        total -= int(sizes[i])
    return chosen


def _configurations(sizes: np.ndarray, demand: np.ndarray, capacity: int) -> Iterator[tuple[int, list[int]]]:
    """``(times, groups of a sequence)`` until the demand is met."""
    demand = demand.copy()
    while demand.any():
        # The longest size left is the hardest to place, so it is always in.
        first = int(np.flatnonzero(demand)[0])
        rest = demand.copy()
        rest[first] -= 1
        chosen = np.array(_fullest(sizes, rest, capacity - int(sizes[first])))
        chosen[first] += 1
        used = chosen > 0
        times = int((demand[used] // chosen[used]).min())
        demand -= times * chosen
        yield times, np.repeat(np.arange(len(sizes)), chosen).tolist()


def _substitute(times: int, places: list[int], groups: list[list[list[int]]]) -> list[Bins]:
    """The configuration with actual lengths, as few kinds of sequences as they make."""
    made = [Bins(times, [])]
    for g in places:
        after = []
        for bins in made:
            left = bins.count
            while left:
                run = groups[g][0]
                took = min(left, run[1])
                after.append(Bins(took, [*bins.lengths, run[0]]))
                left -= took
                run[1] -= took
                if not run[1]:
                    groups[g].pop(0)
        made = after
    return made


def _best_fit(made: list[Bins], small: list[tuple[int, int]], capacity: int) -> list[Bins]:
    by_gap: dict[int, list[Bins]] = defaultdict(list)
    gaps: list[int] = []

    def put(bins: Bins, gap: int) -> None:
        if not by_gap[gap]:
            insort(gaps, gap)
        by_gap[gap].append(bins)

    for bins in made:
        put(bins, capacity - sum(bins.lengths))
    for length, n in small:
        while n:
            at = bisect_left(gaps, length)
            if at == len(gaps):
                put(Bins(-(-n // (capacity // length)), []), capacity)
                continue
            gap = gaps[at]
            bins = by_gap[gap].pop()
            if not by_gap[gap]:
                gaps.pop(at)
            # As many as fit; the last sequence may get fewer.
            each = min(gap // length, max(1, n // bins.count))
            if n < bins.count:
                put(Bins(bins.count - n, bins.lengths), gap)
                bins, each = Bins(n, bins.lengths), 1
            n -= each * bins.count
            put(Bins(bins.count, bins.lengths + [length] * each), gap - each * length)
    return [bins for found in by_gap.values() for bins in found]


def plan(histogram: dict[int, int], capacity: int = CAPACITY, groups: int = GROUPS) -> list[Bins]:
    """Sequences for so many pieces of each length from 1 to the capacity; none for none."""
    lengths = sorted(((n, c) for n, c in histogram.items() if c), reverse=True)
    if lengths and not 0 < lengths[-1][0] <= lengths[0][0] <= capacity:
        raise ValueError("lengths go from 1 to the capacity")
    plans = (_plan(lengths, capacity, groups, share) for share in SMALL_SHARES)
    return min(plans, key=lambda made: sum(bins.count for bins in made))


def _plan(lengths: list[tuple[int, int]], capacity: int, groups: int, share: int) -> list[Bins]:
    large = [x for x in lengths if x[0] > capacity // share]
    # Neighbouring groups that are rounded to one length are one size.
    merged: list[list[list[int]]] = []
    for g in _groups(large, groups):
        if merged and merged[-1][0][0] == g[0][0]:
            merged[-1] += g
        else:
            merged.append(g)
    sizes = np.array([g[0][0] for g in merged], np.int64)
    demand = np.array([sum(n for _, n in g) for g in merged], np.int64)
    made: list[Bins] = []
    for times, places in _configurations(sizes, demand, capacity):
        made += _substitute(times, places, merged)
    return _best_fit(made, lengths[len(large) :], capacity)


def _pieces(tokenizer: str, end: int, capacity: int, with_ids: bool):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = wordpieces.pieces(tokenizer)
        last = np.array([end], "<u4").tobytes()
        width = 4 * capacity
        for pdf in batches:
            out = []
            for doc_id, ids in zip(pdf["doc_id"], own.encode(pdf["text"].tolist())):
                ids += last
                for k, at in enumerate(range(0, len(ids), width)):
                    cut = ids[at : at + width]
                    row = (doc_id, k, at // 4, len(cut) // 4, zlib.crc32(cut))
                    out.append((*row, cut) if with_ids else row)
            made = pd.DataFrame(out, columns=[f.split()[0] for f in PIECES.split(", ")] + ["ids"] * with_ids)
            yield made.astype({"doc_id": "Int64"})

    return run


def pieces(
    docs: DataFrame,
    tokenizer: str = wordpieces.TOKENIZER,
    end: int = END,
    capacity: int = CAPACITY,
    with_ids: bool = False,
) -> DataFrame:
    """The ids of every whole text with the end id, cut where they are longer than a sequence.

    A null or empty text is one piece, the end id. A row without an id gives
    pieces without one; repeated rows give repeated pieces.
    """
    frames.small_batches(docs.sparkSession)
    schema = PIECES + ", ids binary" * with_ids
    return frames.whole_text(docs).mapInPandas(_pieces(tokenizer, end, capacity, with_ids), schema)


def pack(cut: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``sequence_id`` and ``offset`` for every piece; all columns of ``cut`` stay.

    ``cut`` is a stored table, since it is read twice. No pieces, no rows.
    """
    spark = cut.sparkSession
    # No more rows than a sequence has places.
    histogram = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count("*").alias("n")).collect()}
    runs, first, ranked = [], 0, defaultdict(int)
    for bins in plan(histogram, capacity):
        offset = 0
        for length in bins.lengths:
            begin = ranked[length]
            runs.append((length, begin, begin + bins.count, first, offset))
            ranked[length] = begin + bins.count
            offset += length
        first += bins.count
    schema = "length long, begin long, stop long, first long, offset long"
    # At most so many runs as the plan has places of sequences of one kind;
    # that is bounded by the lengths, not by the pieces.
    places = F.broadcast(spark.createDataFrame(runs, schema))
    salts = F.broadcast(
        spark.createDataFrame(
            [(n, -(-c // ROWS_PER_RANKING)) for n, c in histogram.items()], "length long, salts long"
        )
    )
    identity = ["doc_id", "piece", "start", "ids_crc32"]
    dealt = cut.join(salts, "length").withColumn("salt", F.pmod(F.xxhash64(*identity), "salts")).drop("salts")
    counts = dealt.groupBy("length", "salt").agg(F.count("*").alias("n"))
    running = W.partitionBy("length").orderBy("salt").rowsBetween(W.unboundedPreceding, -1)
    before = counts.select("length", "salt", F.coalesce(F.sum("n").over(running), F.lit(0)).alias("before"))
    own = W.partitionBy("length", "salt").orderBy(*identity)
    ranked = (
        dealt.withColumn("rank", F.row_number().over(own) - 1)
        .join(before, ["length", "salt"])
        .withColumn("rank", F.col("rank") + F.col("before"))
    )
    return (
        ranked.join(places, "length")
        .where("rank >= begin AND rank < stop")
        .withColumn("sequence_id", F.col("first") + F.col("rank") - F.col("begin"))
        .select(*[F.col(c) for c in cut.columns], "sequence_id", "offset")
    )


def sequences(packed: DataFrame) -> DataFrame:
    """``sequence_id``, ``n_tokens``, ``ids`` from packed pieces with their ids.

    A group has no more pieces than a sequence has places.
    """
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    hexes = F.transform(parts, lambda p: F.hex(p["ids"]))
    return packed.groupBy("sequence_id").agg(
        F.sum("length").alias("n_tokens"), F.unhex(F.concat_ws("", hexes)).alias("ids")
    )


def packed(docs: DataFrame) -> DataFrame:
    return pack(frames.written(pieces(docs), "pieces"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents' pieces with their sequences."""
    return packed(frames.documents(spark, sf_dir)).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"
    )
