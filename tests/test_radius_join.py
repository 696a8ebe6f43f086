"""The radius join against all pairs, around poles, the antimeridian and in crowded cells."""

from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F

from lamina.functions import geo


def located(spark, points, name):
    return spark.createDataFrame(points, f"{name} int, {name}_lon double, {name}_lat double")


def joined(points, centres, metres):
    return geo.radius_join(points, centres, metres, point_at=("p_lon", "p_lat"), centre_at=("c_lon", "c_lat"))


def spheroid(lon1, lat1, lon2, lat2):
    f, g = math.radians(lat1 + lat2) / 2, math.radians(lat1 - lat2) / 2
    d = math.radians(lon1 - lon2) / 2
    s = math.sin(g) ** 2 * math.cos(d) ** 2 + math.cos(f) ** 2 * math.sin(d) ** 2
    c = math.cos(g) ** 2 * math.cos(d) ** 2 + math.sin(f) ** 2 * math.sin(d) ** 2
    if s == 0:
        return 0.0
    if c < 1e-9:
        return 2 * geo.EARTH_RADIUS_M * math.asin(min(1.0, math.sqrt(s)))
    w = math.atan(math.sqrt(s / c))
    r = math.sqrt(s * c) / w
    more = (3 * r - 1) / (2 * c) * math.sin(f) ** 2 * math.cos(g) ** 2
    less = (3 * r + 1) / (2 * s) * math.cos(f) ** 2 * math.sin(g) ** 2
    return 2 * w * geo.EQUATOR_RADIUS_M * (1 + geo.FLATTENING * (more - less))


def sphere(n, seed):
    """Places all over the globe, many of them near the poles, the antimeridian and each other."""
    draw = random.Random(seed)
    made = []
    for i in range(n):
        lon = draw.choice((draw.uniform(-180, 180), 180 - draw.uniform(-1, 1) ** 4 * 3, draw.choice((-180.0, 180.0, 0.0))))
        lon = lon - 360 if lon > 180 else lon
        lat = draw.choice((draw.uniform(-90, 90), draw.choice((-1, 1)) * (90 - draw.random() ** 4 * 8), draw.gauss(0, 2)))
        made.append((i, lon, max(-90.0, min(90.0, lat))))
    return made


@pytest.mark.parametrize("metres", [1_000.0, 70_000.0, 900_000.0, 6_000_000.0, 19_000_000.0])
def test_all_pairs_and_no_others(spark, monkeypatch, metres):
    monkeypatch.setattr(geo, "CROWD", 25)
    points, centres = sphere(500, 1), sphere(120, 2) + [(1000, 0.0, 90.0), (1001, 180.0, 0.0), (1002, 7.0, -90.0)]
    found = joined(located(spark, points, "p"), located(spark, centres, "c"), metres)
    want = {}
    for c, lon, lat in centres:
        for p, x, y in points:
            away = spheroid(lon, lat, x, y)
            if away <= metres:
                want[c, p] = away
    rows = found.collect()
    got = {(r["c"], r["p"]): r["distance_m"] for r in rows}
    assert len(rows) == len(got) and got.keys() == want.keys()
    assert want and all(math.isclose(got[k], want[k], rel_tol=1e-7, abs_tol=1e-3) for k in want)


def test_known_distances_on_the_spheroid(spark):
    # Lengths of one degree on WGS84; the formula leaves out the square of the flattening.
    cases = [((0, 0, 1, 0), 111_319.491), ((0, 0, 0, 1), 110_574.389), ((0, 89, 0, 90), 111_693.865)]
    for (lon1, lat1, lon2, lat2), metres in cases:
        e = geo.spheroid_m(f"{lon1}D", f"{lat1}D", f"{lon2}D", f"{lat2}D")
        assert spark.sql(f"SELECT {e} AS d").first()["d"] == pytest.approx(metres, rel=2e-5)


def test_rows_without_a_place_and_repeated_rows(spark):
    nan = float("nan")
    bad = [(2, None, 0.0), (3, 0.0, None), (4, nan, 0.0), (5, 0.0, 91.0), (6, math.inf, 0.0)]
    points = located(spark, [(1, 0.0, 0.0), (1, 0.0, 0.0), *bad], "p")
    centres = located(spark, [(7, 0.0, 0.0), *bad], "c")
    rows = joined(points, centres, 10.0).collect()
    assert [(r["c"], r["p"], r["distance_m"]) for r in rows] == [(7, 1, 0.0)] * 2
    assert joined(points.limit(0), centres, 10.0).count() == 0
    with pytest.raises(ValueError, match="both sides"):
        geo.radius_join(points, points, 10.0, point_at=("p_lon", "p_lat"), centre_at=("p_lon", "p_lat"))
    with pytest.raises(ValueError, match="positive"):
        joined(points, centres, 0.0)


def test_the_plan_has_no_cross_join_and_a_crowd_is_dealt(spark, monkeypatch):
    monkeypatch.setattr(geo, "CROWD", 100)
    points = spark.range(4_000).selectExpr("int(id) AS p", "id / 1e6D AS p_lon", "0D AS p_lat")
    centres = located(spark, [(1, 0.001, 0.0)], "c")
    found = joined(points, centres, 50_000.0)
    assert found.count() == 4_000
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan and "share" in plan


def test_tasks_go_with_the_pairs_and_none_is_lost(spark, monkeypatch):
    monkeypatch.setattr(geo, "CROWD", 50)
    monkeypatch.setattr(geo, "TASK_PAIRS", 2 * 50 * 50, raising=False)
    points = spark.range(2_000).selectExpr("int(id) AS p", "id / 1e6D AS p_lon", "0D AS p_lat")
    centres = spark.range(300).selectExpr("int(id) AS c", "id / 1e6D AS c_lon", "0.001D AS c_lat")
    found = joined(points, centres, 50_000.0)
    tasks = found.groupBy(F.spark_partition_id().alias("task")).count().collect()
    assert sum(r["count"] for r in tasks) == found.select("c", "p").distinct().count() == 600_000
    # More tasks than the session's four partitions, though the bytes are few.
    assert len(tasks) > 20 and max(r["count"] for r in tasks) < 100_000
