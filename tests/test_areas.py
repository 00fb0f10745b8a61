"""Points in polygons against every edge, whatever the cells; rings put together."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from wattshed.operators import areas as ar

RINGS = "name string, rings array<array<array<double>>>"


def star(rng, x, y, size, corners, turn=1):
    """A ring with its centre at x, y that never crosses itself."""
    angles = [2 * math.pi * i / corners for i in range(corners)]
    ring = [[x + (r := size * rng.uniform(0.5, 1)) * math.cos(a), y + r * math.sin(a)] for a in angles]
    ring = ring[::turn]
    return [*ring, ring[0]]


def shapes_of(rng):
    many = star(rng, 0.0, 0.0, 40.0, 700)
    return [
        ("many edges", [many, star(rng, 0.0, 0.0, 12.0, 90, -1), star(rng, 0.0, 0.0, 4.0, 5)]),
        ("two parts", [star(rng, 60.0, 10.0, 9.0, 6), star(rng, 80.0, 10.0, 8.0, 40), star(rng, 80.0, 10.0, 3.0, 3)]),
        ("over the first", [star(rng, 30.0, 10.0, 25.0, 12)]),
        ("tiny", [star(rng, 20.001, 20.001, 0.01, 7)]),
        ("on the grid", [[[-8.0, -8.0], [8.0, -8.0], [8.0, 8.0], [-8.0, 8.0], [-8.0, -8.0]], [[-4.0, -4.0], [-4.0, 4.0], [4.0, 4.0], [4.0, -4.0], [-4.0, -4.0]]]),
        ("nothing", [[], [[1.0, 1.0]]]),
    ]


def inside(shapes, xs, ys):
    out = set()
    for name, rings in shapes:
        crossed, on = np.zeros(len(xs), dtype=int), np.zeros(len(xs), dtype=bool)
        for ring in rings:
            for (x1, y1), (x2, y2) in zip(ring, ring[1:], strict=False):
                spans = (y1 > ys) != (y2 > ys)
                if y1 != y2:
                    crossed += spans & (xs < x1 + (ys - y1) * (x2 - x1) / (y2 - y1))
                turn = (x2 - x1) * (ys - y1) - (y2 - y1) * (xs - x1)
                on |= (turn == 0) & (min(x1, x2) <= xs) & (xs <= max(x1, x2)) & (min(y1, y2) <= ys) & (ys <= max(y1, y2))
        out |= {(i, name) for i in np.flatnonzero((crossed % 2 == 1) & ~on).tolist()}
    return out


@pytest.mark.parametrize("cell", [0.5, 4.0, 17.0])
def test_points_match_every_edge(spark, cell):
    rng = random.Random(cell)
    shapes = shapes_of(rng)
    pairs = [(rng.uniform(-50, 100), rng.uniform(-50, 50)) for _ in range(2500)]
    pairs += [(rng.gauss(20.001, 0.01), rng.gauss(20.001, 0.01)) for _ in range(100)]
    pairs += [(float(x), float(y)) for x in range(-9, 10) for y in range(-9, 10)]
    corners = [tuple(p) for _, rings in shapes for ring in rings for p in ring]
    xs, ys = (np.array(v) for v in zip(*pairs, *corners, strict=True))
    points = spark.createDataFrame([(i, float(x), float(y)) for i, (x, y) in enumerate(zip(xs, ys, strict=True))], "id int, x double, y double")
    odd = spark.createDataFrame([(-1, None, 0.0), (-2, 0.0, None), (-3, math.nan, 0.0)], points.schema)
    found = ar.points_in_polygons(points.unionByName(odd).repartition(4), "x", "y", spark.createDataFrame(shapes, RINGS), "name", "rings", cell)
    assert found.columns == ["id", "x", "y", "name"]
    got = [(r["id"], r["name"]) for r in found.collect()]
    assert len(got) == len(set(got)) and set(got) == inside(shapes, xs, ys)


def test_most_points_need_no_edge_and_nothing_holds_a_polygon(spark):
    shapes = spark.createDataFrame([("s", [star(random.Random(1), 0.0, 0.0, 40.0, 12)])], RINGS)
    border, runs = ar.cell_cover(ar.polygon_edges(shapes, "name", "rings"), "name", 1.0)
    inner = runs.where("inside").toPandas()
    assert inner["run"].sum() > 2 * border.select("_row", "_cell").distinct().count() and (inner["run"] > 0).all()
    points = spark.range(10).select(F.col("id").cast("double").alias("x"), F.lit(0.5).alias("y"))
    plan = ar.points_in_polygons(points, "x", "y", shapes, "name", "rings", 1.0)._jdf.queryExecution().executedPlan().toString()
    for bad in ("collect_list", "CartesianProduct", "BroadcastNestedLoopJoin", "lambdafunction"):
        assert bad not in plan


def test_repeated_points_and_columns_of_any_name(spark, rows):
    shapes = spark.createDataFrame([("s", [[[0.0, 0.0], [9.0, 0.0], [9.0, 9.0], [0.0, 9.0], [0.0, 0.0]]])], RINGS)
    points = spark.createDataFrame([(0.5, 0.25, True), (0.5, 0.25, True), (5.0, 5.0, None)], "x double, y double, border boolean")
    for cell in (2.0, 100.0):
        found = ar.points_in_polygons(points, "x", "y", shapes, "name", "rings", cell)
        assert rows(found) == [(0.5, 0.25, True, "s"), (0.5, 0.25, True, "s"), (5.0, 5.0, None, "s")]
    assert ar.points_in_polygons(points, "x", "y", shapes.limit(0), "name", "rings", 2.0).collect() == []


def square(x, y, n, back=False):
    ring = [[x, y], [x + n, y], [x + n, y + n], [x, y + n], [x, y]]
    return ring[::-1] if back else ring


def test_rings_are_put_together(spark):
    loose = [
        ("a", square(0.0, 0.0, 10.0, True)), ("a", square(1.0, 1.0, 6.0)), ("a", square(2.0, 2.0, 3.0, True)),
        ("a", square(20.0, 0.0, 4.0)), ("a", square(8.0, 8.0, 1.0)), ("b", square(0.5, 0.5, 30.0)),
        ("b", square(1.0, 1.0, 0.0)), (None, square(3.0, 3.0, 2.0)[:-1]), ("c", [[0.0, 0.0], [1.0, 1.0]]),
    ]
    rings = spark.createDataFrame(loose, "k string, points array<array<double>>").repartition(3)
    got = {r["k"]: r["parts"] for r in ar.assemble_rings(rings, "k", "points", 2.0).collect()}
    assert got["a"] == [
        [square(0.0, 0.0, 10.0), square(1.0, 1.0, 6.0, True), square(8.0, 8.0, 1.0, True)],
        [square(20.0, 0.0, 4.0)],
        [square(2.0, 2.0, 3.0)],
    ]
    assert got["b"] == [[square(0.5, 0.5, 30.0)]] and got[None] == [[square(3.0, 3.0, 2.0)]] and set(got) == {"a", "b", None}
