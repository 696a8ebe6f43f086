"""Nearest vectors by inner product through multi-index hashing.

Vectors become 64-bit codes: signs of projections that iterative quantization
learns on a bounded sample. A shard's codes are split into four substrings,
and each substring has an index of its own. If two codes differ in r bits at
most, one of their substrings differs in r / 4 at most; so probing each index
with all substrings that near retrieves every code within r bits, and these
are ranked by the inner product of their original vectors in double precision.
The radius is the one that holds nearly all neighbours of the sample; where it
finds fewer than are asked for, it grows until it does.

Equal vectors are one entry, which remembers as many of its smallest ids as a
list of neighbours can use, so copies cost nothing and are found all the same.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lamina.llm import frames

NEIGHBOURS = 20
EVERY = 20  # ids divisible by this are queries
SAMPLE = 20_000  # vectors that the projections are learnt from; the index holds every one
ASKED = 400  # vectors of the sample that the radius is learnt from
RECALL = 0.97  # share of the sample's neighbours that the radius holds
ROUNDS = 30
BITS, PARTS = 64, 4
PART_BITS = BITS // PARTS
SHARD = 1 << 14
QUERY_BLOCK = 1 << 12


@dataclass(frozen=True)
class Coder:
    """Projections, the norm that vectors are scaled by, and the radius to probe."""

    projection: np.ndarray
    largest: float
    radius: int

    def codes(self, vectors: np.ndarray) -> np.ndarray:
        """Codes of entries: vectors lengthened to one norm, so that angles order inner products."""
        scaled = vectors / self.largest
        rest = np.sqrt(np.maximum(0, 1 - np.einsum("ij,ij->i", scaled, scaled)))
        return _pack(np.c_[scaled, rest] @ self.projection)

    def query_codes(self, vectors: np.ndarray) -> np.ndarray:
        return _pack(np.c_[vectors, np.zeros(len(vectors))] @ self.projection)


def _pack(projected: np.ndarray) -> np.ndarray:
    return np.packbits(projected > 0, axis=1, bitorder="little").view("<u8").ravel()


def learn(vectors: np.ndarray, largest: float, share: float, neighbours: int = NEIGHBOURS) -> Coder:
    """Iterative quantization of a sample, and the radius its neighbours need.

    ``share`` is the sample's part of all vectors: the n-th neighbour among all
    is about the (n x share)-th in the sample, and the next whole one is farther.
    """
    random = np.random.default_rng(0)
    scaled = vectors / largest
    rest = np.sqrt(np.maximum(0, 1 - np.einsum("ij,ij->i", scaled, scaled)))
    data = np.c_[scaled, rest]
    _, _, axes = np.linalg.svd(data.T @ data)
    width = data.shape[1]
    start = axes[: min(width, BITS)].T
    turn = np.linalg.qr(random.normal(size=(BITS, BITS)))[0][: start.shape[1]]
    projection = start @ turn
    for _ in range(ROUNDS):
        signs = np.where(data @ projection > 0, 1.0, -1.0)
        left, _, right = np.linalg.svd(data.T @ signs, full_matrices=False)
        projection = left @ right
    draft = Coder(projection, largest, BITS)
    asked = random.permutation(len(vectors))[:ASKED]
    near = max(1, math.ceil(neighbours * share))
    if len(vectors) <= near:
        return draft
    scores = vectors[asked] @ vectors.T
    scores[np.arange(len(asked)), asked] = -np.inf
    best = np.argpartition(-scores, near - 1, axis=1)[:, :near]
    far = draft.query_codes(vectors[asked])[:, None] ^ draft.codes(vectors)[best]
    distances = np.sort(np.bitwise_count(far).ravel())
    return Coder(projection, largest, int(distances[math.ceil(RECALL * len(distances)) - 1]))


@cache
def _masks() -> tuple[np.ndarray, np.ndarray]:
    """Differences of a substring by their number of bits, and how many have up to each number."""
    every = np.arange(1 << PART_BITS, dtype=np.uint16)
    weight = np.bitwise_count(every)
    return every[np.argsort(weight, kind="stable")], np.cumsum(np.bincount(weight))


class Index:
    """Codes of one shard with an index for each substring."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, coder: Coder) -> None:
        order = np.argsort(ids, kind="stable")  # then equal scores come in order of ids
        self.ids, self.vectors, self.coder = ids[order], vectors[order], coder
        self.codes = coder.codes(self.vectors)
        self.places, self.begins = [], []
        for part in self.codes.view("<u2").reshape(-1, PARTS).T:
            self.places.append(np.argsort(part, kind="stable"))
            counts = np.bincount(part, minlength=1 << PART_BITS)
            self.begins.append(np.r_[0, np.cumsum(counts)])

    def within(self, code: np.uint64, radius: int) -> np.ndarray:
        """Places of every code at most ``radius`` bits away."""
        masks, upto = _masks()
        each, extra = divmod(radius, PARTS)
        hit = np.zeros(len(self.codes), bool)
        for part in range(PARTS):
            # All four differing in more than their share would exceed the radius.
            reach = min(each if part <= extra else each - 1, PART_BITS)
            if reach < 0:
                continue
            own = np.uint16(int(code) >> part * PART_BITS & (1 << PART_BITS) - 1)
            probes = masks[: upto[reach]] ^ own
            begins = self.begins[part][probes]
            counts = self.begins[part][probes.astype(np.int64) + 1] - begins
            full = counts > 0
            begins, counts = begins[full], counts[full]
            run = np.arange(counts.sum()) + np.repeat(begins - np.cumsum(counts) + counts, counts)
            hit[self.places[part][run]] = True
        found = np.flatnonzero(hit)
        return found[np.bitwise_count(self.codes[found] ^ code) <= radius]

    def nearest(self, vector: np.ndarray, code: np.uint64, wanted: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the best found, at least ``wanted`` if the shard has them."""
        radius = self.coder.radius
        found = self.within(code, radius)
        while len(found) < min(wanted, len(self.codes)) and radius < BITS:
            radius = min(BITS, radius + PARTS)
            found = self.within(code, radius)
        scores = np.einsum("ij,j->i", self.vectors[found], vector)
        best = np.argsort(-scores, kind="stable")[:wanted]
        return self.ids[found[best]], scores[best]


def taking_part(vector: str) -> Column:
    """Not null, not zero, every component finite."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.col(vector).isNotNull() & finite & F.exists(vector, lambda x: x != 0)


def _matrix(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_numpy()).astype(np.float64)


def _search(coder: Coder, wanted: int):
    def run(asked: pd.DataFrame, entries: pd.DataFrame) -> pd.DataFrame:
        empty = pd.DataFrame({"query": [], "entry": [], "score": []})
        if not len(asked) or not len(entries):
            return empty
        index = Index(entries["entry"].to_numpy(), _matrix(entries["vector"]), coder)
        vectors = _matrix(asked["vector"])
        out = [
            (np.full(len(ids), q), ids, scores)
            for q, vector, code in zip(asked["query"], vectors, coder.query_codes(vectors))
            for ids, scores in [index.nearest(vector, code, wanted)]
        ]
        return pd.DataFrame(dict(zip(["query", "entry", "score"], map(np.concatenate, zip(*out)))))

    return run


def search(
    vectors: DataFrame, is_query: Column, id_col: str, vector_col: str, neighbours: int = NEIGHBOURS
) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score``: the nearest other rows of every query row.

    Ties go to the smaller id; all candidates where there are fewer. Vectors
    that are null, zero or not finite throughout, rows without an id and
    vectors not of the commonest length (of equally common ones the longest)
    take no part. Of rows that repeat an id with its vector one counts. No
    queries or no rows, no result.
    """
    spark = vectors.sparkSession
    frames.small_batches(spark, 4096)
    rows = vectors.select(
        F.col(id_col).cast("long").alias("vec_id"),
        F.col(vector_col).cast("array<double>").alias("vector"),
        F.coalesce(is_query, F.lit(False)).alias("asks"),
    ).where(F.col("vec_id").isNotNull() & taking_part("vector"))
    widths = rows.groupBy(F.size("vector").alias("width")).count()
    commonest = widths.orderBy(F.desc("count"), F.desc("width")).first()
    rows = rows.where(F.size("vector") == (commonest["width"] if commonest else 0))
    # Equal vectors become one entry under their smallest id; a hot vector is
    # limited to the ids that a list can use before it is shuffled.
    first = W.partitionBy("vector").orderBy("vec_id")
    entries = frames.written(
        rows.select("vec_id", "vector")
        .withColumn("place", F.dense_rank().over(first))
        .where(F.col("place") <= neighbours + 1)
        .groupBy("vector")
        .agg(F.min("vec_id").alias("entry"), F.array_sort(F.collect_set("vec_id")).alias("ids")),
        "entries",
    )
    norm = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda s, x: s + x * x))
    total, largest = entries.agg(F.count("*"), F.max(norm)).first()
    schema = "query_id long, rank int, vec_id long, score double"
    if not total:
        return spark.createDataFrame([], schema)
    sample = entries.select("entry", "vector").orderBy(F.xxhash64("entry"), "entry").limit(SAMPLE).toPandas()
    coder = learn(_matrix(sample["vector"]), largest, len(sample) / total, neighbours)

    asking = frames.written(
        rows.where("asks").select(F.col("vec_id").alias("query_id"), "vector").distinct()
        .join(entries.select("entry", "vector"), "vector")
        .select("query_id", F.col("entry").alias("query")),
        "asking",
    )
    queries = entries.join(asking.select("query").distinct(), F.col("entry") == F.col("query"), "left_semi")
    shards = math.ceil(total / SHARD)
    blocks = max(1, math.ceil(asking.count() / QUERY_BLOCK))
    every_shard = F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard")
    every_block = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block")
    dealt = F.pmod(F.xxhash64("entry"), F.lit(shards)).cast("int").alias("shard")
    block = F.pmod(F.xxhash64("entry", F.lit(1)), F.lit(blocks)).cast("int").alias("block")
    left = queries.select(F.col("entry").alias("query"), F.col("vector").alias("vector"), block, every_shard)
    right = entries.select(F.col("entry").alias("entry"), F.col("vector").alias("vector"), dealt, every_block)
    found = (
        left.groupBy("shard", "block")
        .cogroup(right.groupBy("shard", "block"))
        .applyInPandas(_search(coder, neighbours + 1), "query long, entry long, score double")
    )
    best = W.partitionBy("query").orderBy(F.desc("score"), "entry")
    few = found.withColumn("n", F.row_number().over(best)).where(F.col("n") <= neighbours + 1)
    named = few.join(entries.select("entry", "ids"), "entry").select(
        "query", "score", F.explode("ids").alias("vec_id")
    )
    best = W.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    lists = named.withColumn("n", F.row_number().over(best)).where(F.col("n") <= neighbours + 1)
    own = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        asking.join(lists, "query")
        .where("vec_id != query_id")
        .withColumn("rank", F.row_number().over(own))
        .where(F.col("rank") <= neighbours)
        .select("query_id", "rank", "vec_id", "score")
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest vectors of every one whose id is divisible by 20, among all others."""
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return search(vectors, F.col("vec_id") % EVERY == 0, "vec_id", "embedding")
