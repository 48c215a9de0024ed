"""Outlines of boxes and rasterised polygons against plain Python."""

from __future__ import annotations

import math
import random

from pyspark.sql import functions as F

from relievo.functions import geometry
from relievo.operators import grid, outlines


def cells_of(boxes):
    return {(x, y) for a, b, c, d in boxes for x in range(a, c) for y in range(b, d)}


def area(points):
    return sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(points, points[1:] + points[:1])) / 2


def check(spark, boxes):
    frame = spark.createDataFrame([tuple(map(float, b)) for b in boxes], "xmin double, ymin double, xmax double, ymax double")
    got = outlines.outline_rings(frame).collect()
    assert sum(r["area"] for r in got) == len(cells_of(boxes))
    edges = set()
    for r in got:
        pts = [(p["x"], p["y"]) for p in r["ring"]]
        assert pts[0] == pts[-1] and r["n_points"] == len(pts) - 1 and area(pts[:-1]) == r["area"] and r["is_hole"] == (r["area"] < 0)
        for (ax, ay), (bx, by) in zip(pts, pts[1:]):
            assert (ax == bx) != (ay == by)
            n = int(abs(bx - ax) + abs(by - ay))
            edges |= {(ax + (bx - ax) * k / n, ay + (by - ay) * k / n, ax + (bx - ax) * (k + 1) / n, ay + (by - ay) * (k + 1) / n) for k in range(n)}
    cells = cells_of(boxes)
    border = set()
    for x, y in cells:
        border |= {e for e, n in (((x, y, x + 1, y), (x, y - 1)), ((x + 1, y, x + 1, y + 1), (x + 1, y)), ((x + 1, y + 1, x, y + 1), (x, y + 1)), ((x, y + 1, x, y), (x - 1, y))) if n not in cells}
    assert edges == border
    return got


def test_rings(spark):
    assert [r["n_points"] for r in check(spark, [(0, 0, 3, 2)])] == [4]
    ring = check(spark, [(0, 0, 5, 1), (0, 4, 5, 5), (0, 0, 1, 5), (4, 0, 5, 5), (2, 2, 3, 3)])  # a frame with an island in its hole
    assert sorted(r["area"] for r in ring) == [-9, 1, 25]
    assert sorted(r["area"] for r in check(spark, [(0, 0, 1, 1), (1, 1, 2, 2)])) == [1, 1]  # a touch at a corner joins nothing
    r = random.Random(4)
    boxes = [(x := r.randrange(20), y := r.randrange(20), x + r.randrange(1, 5), y + r.randrange(1, 4)) for _ in range(50)]
    check(spark, boxes + boxes[:5])
    comb = [(0, 0, 120, 1)] + [(2 * k, 1, 2 * k + 1, 3) for k in range(60)]
    assert [r["n_points"] for r in check(spark, comb)] == [242]
    assert outlines.outline_rings(spark.createDataFrame([], "xmin double, ymin double, xmax double, ymax double")).count() == 0


def test_units_and_negative_places(spark):
    frame = spark.createDataFrame([(-30.0, -15.0, -15.0, 0.0), (-15.0, -15.0, 0.0, 0.0)], "xmin double, ymin double, xmax double, ymax double")
    row = outlines.outline_rings(frame, 15.0).collect()
    assert [(r["x"], r["y"], r["n_points"], r["area"]) for r in row] == [(-30.0, -15.0, 4, 450.0)]


def star(seed, cx, cy, n, size):
    r = random.Random(seed)
    pts = [(cx + size * r.uniform(0.2, 1) * math.cos(2 * math.pi * k / n), cy + size * r.uniform(0.2, 1) * math.sin(2 * math.pi * k / n)) for k in range(n)]
    return [*pts, pts[0]]


def test_scan_lines_equal_the_test_of_each_cell(spark):
    rings = [(1, star(1, 8.0, 9.0, 400, 9.0)), (2, star(2, 12.0, 6.0, 7, 8.0)), (3, [(0.5, 0.5), (4.5, 0.5), (4.5, 3.5), (0.5, 3.5), (0.5, 0.5)]), (4, [(1.0, 1.0), (1.0, 1.0)]), (5, [(30.0, 2.5), (31.0, 2.5), (30.0, 2.5)])]
    polygons = spark.createDataFrame(rings, "ring_id int, ring array<struct<x:double,y:double>>")
    cells = spark.range(24 * 24).select(F.floor(F.col("id") / 24).alias("i"), (F.col("id") % 24).alias("j"), F.lit("z").alias("inside_of"))
    for ystart, ystep in ((0.0, 1.0), (20.0, -0.9)):
        x, y = F.col("j") + 0.5, grid.cell_centre(F.col("i"), ystart, ystep)
        got = {(r["i"], r["j"]): r["inside"] for r in outlines.inside_rings(cells, polygons, x, ystart, ystep).collect()}
        want = cells.crossJoin(polygons).groupBy("i", "j").agg(F.max(geometry.contains(F.col("ring"), x, y)).alias("inside"))
        assert got == {(r["i"], r["j"]): r["inside"] for r in want.collect()} and len(got) == 576


def test_holes_and_tiles(spark):
    box = lambda a, b, c, d: [(a, b), (c, b), (c, d), (a, d), (a, b)]
    rows = [("a", 1, box(0.0, 0.0, 6.0, 6.0)), ("a", 1, box(2.0, 2.0, 4.0, 4.0)), ("b", 7, box(0.0, 0.0, 1.0, 1.0))]
    polygons = spark.createDataFrame(rows, "tile_id string, lake int, ring array<struct<x:double,y:double>>")
    cells = spark.createDataFrame([(t, i, j) for t in "abc" for i in range(7) for j in range(7)], "tile_id string, i int, j int")
    out = outlines.inside_rings(cells, polygons, F.col("j") + 0.5, 0.0, 1.0, ring_id=["lake"], by=["tile_id"]).where("inside").collect()
    assert {(r["tile_id"], r["i"], r["j"]) for r in out} == {("a", i, j) for i in range(6) for j in range(6) if not (2 <= i < 4 and 2 <= j < 4)} | {("b", 0, 0)}
    assert outlines.inside_rings(cells.limit(0), polygons, F.col("j") + 0.5, 0.0, 1.0, ring_id=["lake"], by=["tile_id"]).count() == 0
    assert outlines.inside_rings(cells, polygons.limit(0), F.col("j") + 0.5, 0.0, 1.0, ring_id=["lake"], by=["tile_id"]).where("inside").count() == 0


def test_nearest_valid_at_any_distance(spark):
    r = random.Random(9)
    grids = {"a": (17, 23, 0.05), "b": (9, 40, 0.3), "c": (6, 6, 0.0), "d": (30, 30, 0.01)}
    cells, holes = [], []
    for t, (h, w, share) in grids.items():
        for i in range(h):
            for j in range(w):
                cells.append((t, i, j, float(r.randrange(50)))) if r.random() < share else holes.append((t, i, j))
    c = spark.createDataFrame([*cells, ("a", 99, 99, None)], "tile_id string, i int, j int, value double")
    h = spark.createDataFrame(holes, "tile_id string, i int, j int")
    want = {}
    for t, i, j in holes:
        best = min((((i - a) ** 2 + (j - b) ** 2, v) for u, a, b, v in cells if u == t), default=None)
        if best:
            want[t, i, j] = (math.sqrt(best[0]), best[1])
    got = {(x["tile_id"], x["i"], x["j"]): (x["distance"], x["value"]) for x in grid.nearest_valid(c, h).collect()}
    assert got == want and max(d for d, _ in want.values()) > 9
    near = grid.nearest_valid(c, h, 2.0)
    assert {(x["tile_id"], x["i"], x["j"]) for x in near.collect()} == {k for k, (d, _) in want.items() if d <= 2}
    assert grid.nearest_valid(c.limit(0), h).count() == 0 and grid.nearest_valid(c, h.limit(0)).count() == 0
