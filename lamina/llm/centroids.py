"""Centroid clustering in exact whole numbers, with heap-ordered bounds.

Vectors lie in blocks. Every block holds, for each cluster, a heap of its
vectors by their gap: a lower bound of the distance to any other centroid less
an upper bound of the distance to the own one. Moving centroids can close a gap
by no more than the own centroid's drift plus the largest drift of another, and
this sum accumulates as the cluster's offset. A vector enters the heap with its
gap plus the offset of that time, so no entry is touched as centroids move: only
those at the top whose entry the offset has reached are popped and rescanned
exactly against all centroids. The others can't have changed their cluster.

A heap is kept as an ascending array, which is in heap order; what expired is
its front. Bounds are floating point with slack on the safe side, distances and
sums are whole numbers, so the outcome equals that of scanning everything.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lamina.llm import frames
from lamina.session import scratch_folder
from lamina.sources import folders

DIMENSIONS = 64
SCALE = 64
CLUSTERS = 16
ROUNDS = 3
SEED = 1

VECTORS_PER_BLOCK = 2048
BLOCKS_PER_BATCH = 16
# A squared distance of two vectors within this is below 2**62.
LARGEST = 1 << 27
SLACK = 1e-9

POINTS = "ids array<bigint>, points binary, width int"
HEAPS = "own binary, members binary, keys binary, sizes array<int>"
BLOCKS = f"{POINTS}, {HEAPS}, moved array<bigint>, rescanned bigint"
ASSIGNED = "vec_id bigint, cluster int, distance bigint"
RESULT = f"{ASSIGNED}, cluster_inertia bigint, inertia bigint, centroid_sha256 string"

Batches = Iterator[pa.RecordBatch]


@dataclass(frozen=True)
class Clustering:
    """The rows of :func:`clustered`, the final centroids, and vectors rescanned in each assignment."""

    rows: DataFrame
    centroids: list[list[int]]
    rescanned: list[int]


# --- blocks ---------------------------------------------------------------------


def _whole_numbers(batch: pa.RecordBatch, dimensions: int, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """Which rows of a batch are proper vectors, and their scaled whole-number components."""
    lists = batch.column(1)
    lengths = lists.value_lengths().fill_null(-1).to_numpy(zero_copy_only=False)
    right = np.flatnonzero(lengths == dimensions)
    picked = lists.take(pa.array(right))
    # A null component reads as NaN, so one test finds all that is not finite.
    values = picked.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(right), dimensions)
    finite = np.isfinite(values).all(axis=1)
    scaled = np.floor(scale * values[finite])
    if scaled.size and np.abs(scaled).max() > LARGEST:
        raise ArithmeticError(f"a component times {scale} is over {LARGEST}: its distances don't fit a long")
    return right[finite], scaled.astype(np.int64)


def _narrow(points: np.ndarray) -> np.ndarray:
    """The same numbers in as few bytes as hold them."""
    most = max(int(np.abs(points).max(initial=0)), 0)
    return points.astype(np.int16 if most < 1 << 15 else np.int32)


def _into_blocks(dimensions: int, scale: int) -> Callable[[Batches], Batches]:
    def run(batches: Batches) -> Batches:
        for batch in batches:
            rows, points = _whole_numbers(batch, dimensions, scale)
            ids = batch.column(0).take(pa.array(rows))
            for low in range(0, len(rows), VECTORS_PER_BLOCK):
                part = _narrow(points[low : low + VECTORS_PER_BLOCK])
                held = ids.slice(low, len(part)).to_pylist()
                yield _batch(POINTS_SCHEMA, [[held], [part.tobytes()], [part.itemsize]])

    return run


def _batch(schema: pa.Schema, columns: list[list]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


POINTS_SCHEMA = pa.schema([("ids", pa.list_(pa.int64())), ("points", pa.binary()), ("width", pa.int32())])
BLOCKS_SCHEMA = pa.schema(
    [
        *POINTS_SCHEMA,
        ("own", pa.binary()),
        ("members", pa.binary()),
        ("keys", pa.binary()),
        ("sizes", pa.list_(pa.int32())),
        ("moved", pa.list_(pa.int64())),
        ("rescanned", pa.int64()),
    ]
)


def _points(row: dict, dimensions: int) -> np.ndarray:
    kind = np.int16 if row["width"] == 2 else np.int32
    return np.frombuffer(row["points"], kind).astype(np.int64).reshape(-1, dimensions)


# --- one assignment --------------------------------------------------------------


def _scan(points: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Nearest centroid (ties: the smaller number), and roots of the least and second least distance."""
    distances = np.empty((len(points), len(centroids)), np.int64)
    for c, centre in enumerate(centroids):
        apart = points - centre
        distances[:, c] = np.einsum("ij,ij->i", apart, apart)
    nearest = distances.argmin(axis=1)
    rows = np.arange(len(points))
    upper = np.sqrt(distances[rows, nearest].astype(np.float64))
    distances[rows, nearest] = np.iinfo(np.int64).max
    second = distances.min(axis=1).astype(np.float64)
    lower = np.sqrt(second) if len(centroids) > 1 else np.full(len(points), np.inf)
    return nearest.astype(np.int32), upper, lower


def _entries(upper: np.ndarray, lower: np.ndarray, offset: np.ndarray) -> np.ndarray:
    """Gaps as heap entries, rounded to the safe side."""
    return lower * (1 - SLACK) - upper * (1 + SLACK) + offset * (1 - SLACK)


def step(
    points: np.ndarray, heaps: tuple | None, centroids: np.ndarray, offsets: np.ndarray
) -> tuple[np.ndarray, list[np.ndarray], list[np.ndarray], np.ndarray, int]:
    """Assign one block anew: own clusters, heaps (members, entries), what the sums change by, rescans.

    ``heaps`` are those of the assignment before, None at the first one.
    """
    k, width = centroids.shape
    moved = np.zeros((k, width + 1), np.int64)
    if heaps is None:
        own, members, keys = np.full(len(points), -1, np.int32), [np.empty(0, np.int32)] * k, [np.empty(0)] * k
        popped = np.arange(len(points))
    else:
        own, members, keys = heaps[0].copy(), list(heaps[1]), list(heaps[2])
        fronts = [int(np.searchsorted(keys[c], offsets[c] * (1 + SLACK) + SLACK, "right")) for c in range(k)]
        popped = np.concatenate([members[c][:n] for c, n in enumerate(fronts)]).astype(np.int64)
        for c, n in enumerate(fronts):
            members[c], keys[c] = members[c][n:], keys[c][n:]
    if not len(popped):
        return own, members, keys, moved, 0
    nearest, upper, lower = _scan(points[popped], centroids)
    entries = _entries(upper, lower, offsets[nearest])
    changed = nearest != own[popped]
    for at, sign in ((own[popped], -1), (nearest, 1)):
        use = changed & (at >= 0)
        np.add.at(moved[:, :width], at[use], sign * points[popped[use]])
        np.add.at(moved[:, width], at[use], sign)
    own[popped] = nearest
    for c in np.unique(nearest):
        mine = nearest == c
        both = np.concatenate([keys[c], entries[mine]])
        order = np.argsort(both, kind="stable")
        keys[c] = both[order]
        members[c] = np.concatenate([members[c], popped[mine].astype(np.int32)])[order]
    return own, members, keys, moved, len(popped)


def _held_heaps(row: dict) -> tuple:
    cuts = np.cumsum(row["sizes"])[:-1]
    members = np.split(np.frombuffer(row["members"], np.int32), cuts)
    keys = np.split(np.frombuffer(row["keys"], np.float64), cuts)
    return np.frombuffer(row["own"], np.int32), members, keys


def _assign(centroids: np.ndarray, offsets: np.ndarray, first: bool) -> Callable[[Batches], Batches]:
    def run(batches: Batches) -> Batches:
        for batch in batches:
            for row in batch.to_pylist():
                points = _points(row, centroids.shape[1])
                heaps = None if first else _held_heaps(row)
                own, members, keys, moved, rescanned = step(points, heaps, centroids, offsets)
                yield _batch(
                    BLOCKS_SCHEMA,
                    [
                        [row["ids"]],
                        [row["points"]],
                        [row["width"]],
                        [own.tobytes()],
                        [np.concatenate(members).astype(np.int32).tobytes()],
                        [np.concatenate(keys).tobytes()],
                        [[len(m) for m in members]],
                        [moved.ravel().tolist()],
                        [rescanned],
                    ],
                )

    return run


def _distances(centroids: np.ndarray) -> Callable[[Batches], Batches]:
    """A row for every vector of the blocks, with its exact distance."""
    schema = pa.schema([("vec_id", pa.int64()), ("cluster", pa.int32()), ("distance", pa.int64())])

    def run(batches: Batches) -> Batches:
        for batch in batches:
            for row in batch.to_pylist():
                own = np.frombuffer(row["own"], np.int32)
                apart = _points(row, centroids.shape[1]) - centroids[own]
                yield _batch(schema, [row["ids"], own, np.einsum("ij,ij->i", apart, apart)])

    return run


# --- the rounds ------------------------------------------------------------------


def _totals(batches: Batches) -> Batches:
    """One row for each number that a task's blocks change the sums by."""
    total, rescanned = None, 0
    for batch in batches:
        for row in batch.to_pylist():
            # Python's whole numbers: a task may have any number of vectors.
            add = np.array(row["moved"], object)
            total = add if total is None else total + add
            rescanned += row["rescanned"]
    if total is not None:
        slots = [-1, *np.flatnonzero(total).tolist()]
        amounts = [str(rescanned), *[str(total[i]) for i in slots[1:]]]
        yield pa.RecordBatch.from_pydict({"slot": pa.array(slots, pa.int32()), "amount": amounts})


def _leaders(seed: int, dimensions: int, count: int) -> Callable[[Batches], Batches]:
    """Of a task's vectors those with the least hashes of their ids."""
    def run(batches: Batches) -> Batches:
        best: list[tuple[str, list[int]]] = []
        for batch in batches:
            for row in batch.to_pylist():
                hashes = [hashlib.sha256(f"{seed}:{i}".encode()).hexdigest() if i is not None else "x" for i in row["ids"]]
                points = _points(row, dimensions)
                # Ids may repeat, so all rows up to the last of the least hashes are compared.
                last = sorted(hashes)[:count][-1]
                best += [(h, points[j].tolist()) for j, h in enumerate(hashes) if h <= last]
                best = sorted(best)[:count]
        yield pa.RecordBatch.from_pydict(
            {
                "hash": pa.array([h for h, _ in best], pa.string()),
                "point": pa.array([p for _, p in best], pa.list_(pa.int64())),
            }
        )

    return run


def _first_centroids(blocks: DataFrame, seed: int, dimensions: int, count: int) -> np.ndarray:
    found = blocks.select("ids", "points", "width").mapInArrow(
        _leaders(seed, dimensions, count), "hash string, point array<bigint>"
    )
    best = found.orderBy("hash", "point").limit(count).collect()
    return np.array([r["point"] for r in best], np.int64).reshape(len(best), dimensions)


def clustered(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    *,
    clusters: int = CLUSTERS,
    rounds: int = ROUNDS,
    dimensions: int = DIMENSIONS,
    scale: int = SCALE,
    seed: int = SEED,
) -> Clustering:
    """Cluster, distance, inertias and centroid hash of every proper vector.

    A vector takes part if it has exactly ``dimensions`` components, none null
    or non-finite; each becomes floor(scale * x). The first centroids are the
    vectors whose ids have the smallest SHA-256 of ``seed:id``. Rows that share
    an id are vectors of their own, the smaller components first; rows without
    an id are clustered, but come last as first centroids. Fewer vectors than
    clusters give fewer clusters, no proper vector gives no row. Of equal
    distances the smaller cluster wins, and an empty cluster keeps its centroid.
    A component whose distances a long can't hold is an error.

    What a round leaves is a table in the shared folder; the one before it is
    deleted then. The driver holds centroids, sums and offsets, no vectors.
    """
    spark = vectors.sparkSession
    source = vectors.select(
        F.col(id_col).cast("bigint").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vector")
    )
    held = scratch_folder(spark, "vectors")
    source.mapInArrow(_into_blocks(dimensions, scale), POINTS).write.parquet(held)
    with frames.batches_of(spark, BLOCKS_PER_BATCH):
        blocks = spark.read.schema(POINTS).parquet(held)
        centroids = _first_centroids(blocks, seed, dimensions, clusters)
        k = len(centroids)
        if not k:
            return Clustering(spark.createDataFrame([], RESULT), [], [])
        sums = np.zeros((k, dimensions + 1), object)
        offsets, rescans = np.zeros(k), []
        for turn in range(rounds + 1):
            path = scratch_folder(spark, "clusters")
            blocks.mapInArrow(_assign(centroids, offsets, turn == 0), BLOCKS).write.parquet(path)
            folders.delete(spark, held)
            held, blocks = path, spark.read.schema(BLOCKS).parquet(path)
            changes = (
                blocks.select("moved", "rescanned")
                .mapInArrow(_totals, "slot int, amount string")
                .groupBy("slot")
                .agg(F.sum(F.col("amount").cast("decimal(38,0)")).alias("amount"))
                .collect()
            )
            for change in changes:
                if change["slot"] < 0:
                    rescans.append(int(change["amount"]))
                else:
                    sums[divmod(change["slot"], dimensions + 1)] += int(change["amount"])
            if turn < rounds:
                before = centroids
                means = [s[:-1] // s[-1] if s[-1] else before[c] for c, s in enumerate(sums)]
                centroids = np.array(means).astype(np.int64)
                drift = np.sqrt(((centroids - before) ** 2).sum(axis=1).astype(np.float64)) * (1 + SLACK)
                others = [np.delete(drift, c).max(initial=0.0) for c in range(k)]
                offsets = offsets + drift + np.array(others)
        assigned = frames.written(blocks.mapInArrow(_distances(centroids), ASSIGNED), "assigned")
        folders.delete(spark, held)
    totals = assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("total")).collect()
    each = {r["cluster"]: int(r["total"]) for r in totals}
    marks = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    facts = [(c, each.get(c, 0), sum(each.values()), marks[c]) for c in range(k)]
    of_cluster = spark.createDataFrame(facts, "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    # A row for each cluster, however many vectors there are.
    return Clustering(assigned.join(F.broadcast(of_cluster), "cluster").select(*_names(RESULT)), centroids.tolist(), rescans)


def _names(schema: str) -> list[str]:
    return [c.split()[0] for c in schema.split(", ")]


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clusters of all vectors of ``embeddings`` after three rounds."""
    return clustered(spark.read.parquet(f"{sf_dir}/embeddings.parquet")).rows


def _sql() -> str:
    """The rounds in plain SQL: every vector against every centroid."""
    far = "list_sum(list_transform(list_zip(v.p, c.p), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT"
    mean = "((sum(x) - ((sum(x) % count(*)) + count(*)) % count(*)) // count(*))::BIGINT"
    parts = [
        f"""kept AS MATERIALIZED (
    SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)::BIGINT) AS p
    FROM embeddings
    WHERE len(embedding) = {DIMENSIONS} AND len(list_filter(embedding, lambda x: isfinite(x))) = {DIMENSIONS}
)""",
        f"""c0 AS MATERIALIZED (
    SELECT row_number() OVER (ORDER BY sha256('{SEED}:' || vec_id), p) - 1 AS c, p
    FROM kept ORDER BY c LIMIT {CLUSTERS}
)""",
    ]
    for turn in range(ROUNDS + 1):
        parts.append(
            f"""d{turn} AS MATERIALIZED (
    SELECT v.r, c.c, {far} AS d FROM kept v CROSS JOIN c{turn} c
)"""
        )
        parts.append(
            f"""a{turn} AS MATERIALIZED (
    SELECT r, min(d) AS distance, arg_min(c, (d, c)) AS c FROM d{turn} GROUP BY r
)"""
        )
        if turn < ROUNDS:
            parts.append(
                f"""c{turn + 1} AS MATERIALIZED (
    WITH cells AS (
        SELECT c, unnest(p) AS x, generate_subscripts(p, 1) AS i FROM a{turn} JOIN kept USING (r)
    ), means AS (
        SELECT c, i, {mean} AS x FROM cells GROUP BY c, i
    ), moved AS (
        SELECT c, list(x ORDER BY i) AS p FROM means GROUP BY c
    )
    SELECT c{turn}.c, coalesce(moved.p, c{turn}.p) AS p FROM c{turn} LEFT JOIN moved USING (c)
)"""
            )
    return f"""
WITH {", ".join(parts)}
SELECT vec_id, c::INTEGER AS cluster, distance,
       (sum(distance) OVER (PARTITION BY c))::BIGINT AS cluster_inertia,
       (sum(distance) OVER ())::BIGINT AS inertia,
       sha256(array_to_string(f.p, ',')) AS centroid_sha256
FROM a{ROUNDS} JOIN kept USING (r) JOIN c{ROUNDS} f USING (c)
"""


SQL = _sql()
