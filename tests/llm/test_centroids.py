"""Heap-ordered clustering against plain Lloyd rounds, and odd vectors."""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pytest

from lamina.llm import centroids

SCHEMA = "vec_id long, embedding array<float>, cluster int, ids long, moved string"


def table(spark, rows):
    return spark.createDataFrame([(i, v, 1, 2, "m") for i, v in rows], SCHEMA)


def plain(rows, clusters=centroids.CLUSTERS, rounds=centroids.ROUNDS, dimensions=centroids.DIMENSIONS):
    """Every vector against every centroid, in Python's whole numbers."""
    kept = []
    for i, v in rows:
        if v is not None and len(v) == dimensions and all(x is not None and math.isfinite(x) for x in v):
            kept.append((i, [math.floor(64 * float(np.float32(x))) for x in v]))
    def order(row):
        named = row[0] is not None
        return (not named, hashlib.sha256(f"1:{row[0]}".encode()).hexdigest() if named else "", row[1])

    centres = [p for _, p in sorted(kept, key=order)[:clusters]]

    def nearest(p):
        return min((sum((a - b) ** 2 for a, b in zip(p, c)), n) for n, c in enumerate(centres))

    for _ in range(rounds):
        homes = [nearest(p)[1] for _, p in kept]
        for n in range(len(centres)):
            mine = [p for (_, p), h in zip(kept, homes) if h == n]
            if mine:
                centres[n] = [sum(column) // len(mine) for column in zip(*mine)]
    found = [(i, *reversed(nearest(p))) for i, p in kept]
    inertia = {n: sum(d for _, c, d in found if c == n) for n in range(len(centres))}
    marks = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres]
    return sorted(
        ((i, c, d, inertia[c], sum(inertia.values()), marks[c]) for i, c, d in found), key=repr
    )


def collected(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_equals_plain_rounds(spark):
    chance = np.random.default_rng(3)
    centres = chance.normal(size=(9, 64))
    rows = [(i, (centres[i % 9] + chance.normal(size=64) * 0.7).tolist()) for i in range(400)]
    assert collected(centroids.clustered(table(spark, rows)).rows) == plain(rows)


def test_ties_repeats_and_empty_clusters(spark):
    # Few different vectors: equal centroids, equal distances, clusters that lose all.
    chance = np.random.default_rng(4)
    shapes = (chance.integers(-1, 2, (5, 64)) / 64).tolist()
    rows = [(i % 40, shapes[i * i % 5]) for i in range(120)]
    assert collected(centroids.clustered(table(spark, rows)).rows) == plain(rows)


def test_improper_vectors_take_no_part(spark):
    good = [(i, [float(i + j) / 7 for j in range(64)]) for i in range(30)]
    bad = [
        (100, None),
        (101, []),
        (102, [1.0] * 63),
        (103, [1.0] * 65),
        (104, [1.0] * 63 + [None]),
        (105, [1.0] * 63 + [float("nan")]),
        (106, [float("-inf")] + [1.0] * 63),
        (None, [0.5] * 64),
        (None, None),
    ]
    rows = bad[:4] + good + bad[4:]
    assert collected(centroids.clustered(table(spark, rows)).rows) == plain(rows)


def test_few_or_no_vectors(spark):
    few = [(i, [float(i)] * 64) for i in range(3)]
    assert collected(centroids.clustered(table(spark, few)).rows) == plain(few)
    assert centroids.clustered(table(spark, [(1, [0.0] * 64)])).rows.first()["distance"] == 0
    none = centroids.clustered(table(spark, [(1, None)])).rows
    assert none.collect() == [] and none.columns == centroids._names(centroids.RESULT)


def test_a_distance_over_a_long_is_an_error(spark):
    with pytest.raises(Exception, match="don't fit a long"):
        centroids.clustered(table(spark, [(1, [1e30] * 64)])).rows.collect()


def test_only_expired_gaps_are_rescanned(spark):
    chance = np.random.default_rng(5)
    centres = chance.normal(size=(16, 64)) * 20
    rows = [(i, (centres[i % 16] + chance.normal(size=64) * 0.1).tolist()) for i in range(800)]
    found = centroids.clustered(table(spark, rows), clusters=16, rounds=5)
    assert found.rescanned[0] == 800
    assert found.rescanned[-1] < 80
    assert collected(found.rows) == plain(rows, rounds=5)


def test_a_step_pops_what_the_offset_reaches():
    chance = np.random.default_rng(6)
    points = chance.integers(-100, 100, (500, 64))
    centres = points[:8].copy()
    own, members, keys, moved, rescanned = centroids.step(points, None, centres, np.zeros(8))
    assert rescanned == 500 and moved[:, 64].sum() == 500
    for k, m in zip(keys, members):
        assert (np.diff(k) >= 0).all() and len(k) == len(m)
    assert sorted(np.concatenate(members)) == list(range(500))
    offsets = np.array([np.median(np.concatenate(keys))] * 8)
    again = centroids.step(points, (own, members, keys), centres, offsets)
    assert 0 < again[4] < 500
    assert (again[0] == own).all() and not again[3].any()


def test_the_session_keeps_its_batches(spark):
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    centroids.clustered(table(spark, [(1, [0.0] * 64)])).rows.collect()
    assert spark.conf.get(key) == before
