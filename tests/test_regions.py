"""Points in polygons by a grid, against plain ray casting."""

import math
import random

import pytest
from pyspark.sql import functions as F

from tapflow.operators import regions

RING = "gu string, ring array<struct<lon:double,lat:double>>"
POINT = "id long, lon double, lat double"


def holds(lon, lat, ring):
    crossed = 0
    for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1]):
        if (y1 > lat) != (y2 > lat) and lon < (x2 - x1) * (lat - y1) / (y2 - y1) + x1:
            crossed += 1
    return crossed % 2 == 1


def brute_force(points, polygons):
    out = {}
    for i, lon, lat in points:
        names = [gu for gu, ring in polygons if gu is not None and len(ring) >= 3 and None not in (lon, lat) and holds(lon, lat, ring)]
        out[i] = min(names, default=None)
    return out


def found(spark, points, polygons, size):
    df = regions.attach_region_by_area(spark.createDataFrame(points, POINT).repartition(3), spark.createDataFrame(polygons, RING), size)
    return {r.id: r.gu for r in df.collect()}


@pytest.mark.parametrize("size", [0.3, 1.0, 50.0])
def test_equal_to_plain_ray_casting(spark, size):
    rng = random.Random(5)
    polygons = []
    for i in range(12):
        x, y, n = rng.uniform(-9, 9), rng.uniform(-9, 9), rng.randrange(3, 40)
        polygons.append((f"g{i:02d}", [(x + rng.uniform(0.5, 4) * math.cos(2 * math.pi * k / n), y + rng.uniform(0.5, 4) * math.sin(2 * math.pi * k / n)) for k in range(n)]))
    polygons.append(("h", [(0.0, 0.0), (6.0, 0.0), (6.0, 6.0), (3.0, 1.0), (0.0, 6.0), (0.0, 0.0)]))  # closed, not convex
    points = [(i, rng.uniform(-13, 13), rng.uniform(-13, 13)) for i in range(2000)]
    points += [(5000 + k, *corner) for k, corner in enumerate(c for _, ring in polygons for c in ring)]
    assert found(spark, points, polygons, size) == brute_force(points, polygons)


def test_points_on_shared_borders_belong_to_one_neighbour(spark):
    squares = [(f"s{i}{j}", [(i, j), (i + 1.0, j), (i + 1.0, j + 1.0), (i, j + 1.0)]) for i in (0.0, 1.0) for j in (0.0, 1.0)]
    points = [(int(4 * x * 100 + 4 * y), x, y) for x in (0.0, 0.25, 1.0, 1.5, 2.0) for y in (0.0, 0.5, 1.0, 1.75, 2.0)]
    for size in (0.25, 1.0, 0.7):
        result = found(spark, points, squares, size)
        assert result == brute_force(points, squares)
        assert sum(v is not None for v in result.values()) == 16  # the upper and right ends are outside


def test_missing_values_empty_tables_and_clashing_columns(spark):
    points = [(1, 0.5, 0.5), (2, None, 0.5), (3, 0.5, None), (4, float("nan"), 0.5), (5, 0.5, 0.5)]
    polygons = [("a", [(0.0, 0.0), (1.0, 0.0), (1.0, 1.0), (0.0, 1.0)]), (None, [(0.0, 0.0), (1.0, 0.0), (1.0, 1.0)]), ("b", [(0.0, 0.0), (1.0, 1.0)]), ("c", [])]
    assert found(spark, points, polygons, 1.0) == {1: "a", 2: None, 3: None, 4: None, 5: "a"}
    assert found(spark, points, [], 1.0) == dict.fromkeys(range(1, 6))
    assert found(spark, points[:0] or spark.createDataFrame([], POINT).collect(), polygons, 1.0) == {}
    named = spark.createDataFrame(points[:1], POINT).withColumns({n: F.lit(n) for n in ("cell_x", "point", "regions", "sides")})
    row = regions.attach_region_by_area(named, spark.createDataFrame(polygons, RING), 1.0).first()
    assert row.gu == "a" and all(row[n] == n for n in ("cell_x", "point", "regions", "sides"))


def test_no_all_pairs_join_and_only_borders_carry_edges(spark):
    ring = [(10 + 8 * math.cos(t / 20 * math.pi), 10 + 8 * math.sin(t / 20 * math.pi)) for t in range(40)]
    polygons = spark.createDataFrame([("a", ring)], RING)
    cover = regions.covered_cells(polygons, 0.5).select(F.inline("regions")).groupBy("whole").agg(F.count("*").alias("n"), F.count("sides").alias("with_sides")).collect()
    by = {r.whole: r for r in cover}
    assert by[True].with_sides == 0 and by[False].n == by[False].with_sides and by[True].n > 2 * by[False].n
    plan = regions.attach_region_by_area(spark.range(9).select("id", (F.col("id") * 1.5).alias("lon"), (F.col("id") * 0.5).alias("lat")), polygons, 0.5)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    with pytest.raises(Exception, match="too fine"):
        regions.covered_cells(polygons, 0.001).collect()


def test_border_cells_carry_only_edges_that_come_in(spark):
    """Long thin spikes: a cell has the few edges that pass it, not the ring's 4000."""
    rng = random.Random(3)
    ring = [(10 + (2, 5)[k % 2] * math.cos(k * math.pi / 2000), 10 + (2, 5)[k % 2] * math.sin(k * math.pi / 2000)) for k in range(4000)]
    polygons = spark.createDataFrame([("a", ring)], RING)
    carried = regions.covered_cells(polygons, 0.5).select(F.inline("regions")).agg(F.sum(F.size("sides"))).first()[0]
    assert carried < 12 * len(ring)  # 4000 in each of some 350 cells before
    points = [(i, rng.uniform(4, 16), rng.uniform(4, 16)) for i in range(1000)] + [(2000 + k, *ring[k]) for k in range(0, 4000, 9)]
    assert found(spark, points, [("a", ring)], 0.5) == brute_force(points, [("a", ring)])
