"""Projections there and back, and rasters brought to geographic cells."""

from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from relievo.functions import geometry
from relievo.operators import grid


def metres(lon0, lat0, lon1, lat1):
    """The distance of nearby places on a sphere."""
    d = math.radians((lon1 - lon0 + 540) % 360 - 180) * math.cos(math.radians(lat0))
    return 6378137 * math.hypot(d, math.radians(lat1 - lat0))


def test_every_utm_zone_there_and_back(spark):
    rows = [(z, s, z * 6 - 183 + d, lat if not s else -lat) for z in range(1, 61) for s in (False, True) for d in (-3.5, -3.0, -1.25, 0.0, 0.5, 3.0) for lat in (0.0, 0.001, 23.4, 45.0, 66.5, 84.0)]
    df = spark.createDataFrame(rows, "zone int, south boolean, lon double, lat double").withColumn("epsg", 32600 + F.col("zone") + F.when(F.col("south"), 100).otherwise(0))
    df = df.withColumn("p", geometry.project(F.col("lon"), F.col("lat"), F.col("epsg"))).withColumn("q", geometry.unproject(F.col("p.x"), F.col("p.y"), F.col("epsg")))
    for r in df.collect():
        assert metres(r["lon"], r["lat"], r["q"]["x"], r["q"]["y"]) < 1e-3


@pytest.mark.parametrize("epsg", [3413, 3031])
def test_both_poles_there_and_back(spark, epsg):
    sign = 1 if epsg == 3413 else -1
    rows = [(float(lon), sign * lat) for lon in range(-180, 181, 15) for lat in (50.0, 60.0, 70.0, 71.0, 85.0, 89.999, 90.0)]
    df = spark.createDataFrame(rows, "lon double, lat double").withColumn("p", geometry.project(F.col("lon"), F.col("lat"), epsg))
    for r in df.withColumn("q", geometry.unproject(F.col("p.x"), F.col("p.y"), epsg)).collect():
        assert metres(r["lon"], r["lat"], r["q"]["x"], r["q"]["y"]) < 1e-3 and -180 <= r["q"]["x"] <= 180
    origin = spark.range(1).select(geometry.unproject(F.lit(0.0), F.lit(0.0), epsg).alias("q")).first()["q"]
    assert origin["y"] == pytest.approx(90 * sign)


def test_known_places(spark):
    # published coordinates: the CN Tower in zone 17, and the true scale of the polar grids
    q = spark.range(1).select(geometry.unproject(F.lit(630084.0), F.lit(4833438.0), 32617).alias("q"), geometry.project(F.lit(-45.0), F.lit(70.0), 3413).alias("p")).first()
    assert q["q"]["x"] == pytest.approx(-79.387139, abs=2e-5) and q["q"]["y"] == pytest.approx(43.642567, abs=2e-5)
    assert q["p"]["x"] == pytest.approx(0, abs=1e-6) and q["p"]["y"] == pytest.approx(-2187890, rel=2e-3)


def test_a_code_without_formula_raises(spark):
    with pytest.raises(ValueError):
        geometry.unproject(F.lit(0.0), F.lit(0.0), 4326)
    with pytest.raises(Exception, match="no formula"):
        spark.range(1).select(geometry.unproject(F.lit(0.0), F.lit(0.0), F.col("id").cast("int"))).collect()


def plane(spark, epsg, xleft, ytop, res, n):
    """A raster whose values are the latitudes of its cells' centres."""
    cells = spark.range(n * n).select(F.lit(1).alias("tile_id"), F.floor(F.col("id") / n).alias("i"), (F.col("id") % n).alias("j"))
    at = geometry.unproject(xleft + (F.col("j") + 0.5) * res, ytop - (F.col("i") + 0.5) * res, epsg)
    rasters = spark.createDataFrame([(1, epsg, float(xleft), float(ytop), float(res), -float(res), n, n)], "tile_id int, epsg int, xleft double, ytop double, xres double, yres double, xsize int, ysize int")
    return cells.withColumn("value", at["y"]), rasters


@pytest.mark.parametrize(("epsg", "xleft", "ytop"), [(32633, 300000, 5300000), (32733, 300000, 9000000), (32601, 200000, 7000000), (3413, -200000, 200000), (3031, 900000, 900000)])
def test_resampled_latitudes_are_latitudes(spark, epsg, xleft, ytop):
    cells, rasters = plane(spark, epsg, xleft, ytop, 10000, 40)
    step = 0.25
    out = grid.resampled(cells, rasters, step).collect()
    targets = grid.geographic_cells(rasters, step).collect()
    assert len(out) == len(targets) == len({(r["i"], r["j"]) for r in targets}) > 50
    assert all(0 <= r["j"] < 1440 and 0 <= r["i"] < 720 for r in out)
    edge = {(r["i"], r["j"]) for r in targets if min(r["x"], r["y"], 40 - r["x"], 40 - r["y"]) < 0.5}
    for r in out:
        if (r["i"], r["j"]) not in edge:
            assert r["value"] == pytest.approx(90 - (r["i"] + 0.5) * step, abs=0.02)
    # every geographic centre within the raster is there
    inside = spark.range(720 * 1440).select(F.floor(F.col("id") / 1440).alias("i"), (F.col("id") % 1440).alias("j"))
    inside = inside.where(F.col("i") < 360 if epsg in (32633, 32601, 3413) else F.col("i") >= 360)
    p = geometry.project(grid.cell_centre(F.col("j"), -180.0, step), grid.cell_centre(F.col("i"), 90.0, -step), epsg)
    if 32600 < epsg < 32800:  # the series holds near its own meridian only
        zone = epsg % 100 * 6 - 183
        lon = grid.cell_centre(F.col("j"), -180.0, step)
        inside = inside.where(F.abs(F.pmod(lon - zone + 180, F.lit(360.0)) - 180) < 12)
    inside = inside.withColumn("p", p).where(F.col("p.x").between(xleft, xleft + 400000 - 1e-9) & F.col("p.y").between(ytop - 400000 + 1e-9, ytop))
    assert inside.count() == len(out)


def test_nearest_and_cubic(spark):
    cells, rasters = plane(spark, 32633, 400000, 5300000, 5000, 20)
    for kind in ("nearest", "cubic"):
        out = grid.resampled(cells, rasters, 0.1, kind).collect()
        assert out and all(abs(r["value"] - (90 - (r["i"] + 0.5) * 0.1)) < 0.06 for r in out)
