"""Clustered photon files: codes, intervals, rows and bytes of a box."""

from __future__ import annotations

import random
import re

from pyspark.sql import functions as F

from relievo.plans.storage import new_folder
from relievo.sources import clustered, readers, writers


def code(x, y, bits=25):
    cell = lambda v, low, width: min((1 << bits) - 1, max(0, int((v - low) / width * (1 << bits) // 1)))
    a, b = cell(x, -180.0, 360.0), cell(y, -90.0, 180.0)
    return sum(((a >> k & 1) << 2 * k) | ((b >> k & 1) << (2 * k + 1)) for k in range(bits))


def places(seed, n):
    r = random.Random(seed)
    near = [(r.gauss(10, 0.01), r.gauss(45, 0.01)) for _ in range(n // 2)]
    return [*near, *((r.uniform(-180, 180), r.uniform(-90, 90)) for _ in range(n // 2)), (-180.0, -90.0), (180.0, 90.0), (200.0, -95.0), (0.0, 0.0)]


def test_codes_and_intervals(spark):
    pts = places(1, 400)
    df = spark.createDataFrame(pts, "x double, y double")
    got = [r[0] for r in df.select(clustered.morton(F.col("x"), F.col("y"))).collect()]
    assert got == [code(x, y) for x, y in pts]
    r = random.Random(7)
    for _ in range(60):
        x, y, w = r.uniform(-180, 170), r.uniform(-90, 80), 10 ** r.uniform(-6, 2)
        box = (x, y, x + w, y + w / 2)
        spans = clustered.box_intervals(box)
        assert 0 < len(spans) <= clustered.MOST_INTERVALS + 3 and all(a[1] + 1 < b[0] for a, b in zip(spans, spans[1:]))
        inside = [(box[0], box[1]), (min(180, box[2]), min(90, box[3])), *((r.uniform(box[0], min(180, box[2])), r.uniform(box[1], min(90, box[3]))) for _ in range(30))]
        assert all(any(a <= code(px, py) <= b for a, b in spans) for px, py in inside)
    assert clustered.box_intervals((1, 1, 0, 2)) == []
    assert clustered.box_intervals((-180, -90, 180, 90)) == [(0, 2**50 - 1)]


def test_a_box_reads_few_bytes_and_all_its_rows(spark):
    pts = places(2, 20000)
    df = spark.createDataFrame([(k, x, y, k % 5) for k, (x, y) in enumerate(pts)], "id int, longitude double, latitude double, class_code int")
    path = new_folder(spark, "clustered")
    files = clustered.write_clustered(df, path, files=40).cache()
    assert files.count() == 40 and files.agg(F.sum("n")).first()[0] == len(pts)
    # half of all photons lie within a few hundredths of a degree, and are in half of the files
    assert files.agg(F.max("n")).first()[0] < 2 * len(pts) / 40
    spans = sorted((r["z_min"], r["z_max"]) for r in files.collect())
    assert all(a[1] <= b[0] for a, b in zip(spans, spans[1:]))
    total = files.agg(F.sum("bytes")).first()[0]
    for box, share in (((9.99, 44.99, 10.0, 45.0), 0.5), ((-120.0, 10.0, -100.0, 30.0), 0.2), ((9.0, 44.0, 11.0, 46.0), 0.7), ((10.0, 45.0, 10.001, 45.001), 0.1)):
        rows = clustered.read_box(spark, path, files, box)
        assert rows.columns == df.columns
        want = {k for k, (x, y) in enumerate(pts) if box[0] <= x < box[2] and box[1] <= y < box[3]}
        assert {r["id"] for r in rows.collect()} == want
        assert clustered.files_for_box(files, box).agg(F.coalesce(F.sum("bytes"), F.lit(0))).first()[0] <= share * total
        opened = set(rows.inputFiles())
        assert len(opened) == clustered.files_for_box(files, box).count()
    assert clustered.read_box(spark, path, files, (5, 5, 4, 6)).count() == 0


def test_tiles_are_counted_as_they_were_written(spark):
    pts = [(x % 180, y) for x, y in places(3, 4000)[:-4]]
    df = spark.createDataFrame([(k, x, y, k % 5) for k, (x, y) in enumerate(pts)], "id int, longitude double, latitude double, class_code int")
    path = new_folder(spark, "tiles")
    counts = writers.write_photon_tiles(df, path, 5.0, block=4)
    assert counts.agg(F.sum("numphotons")).first()[0] == len(pts)
    key = lambda c: (F.floor(F.col(c) / 5.0) * 5.0).alias(c)
    want = {(r[0], r[1]): r[2] for r in df.groupBy(key("latitude"), key("longitude")).count().collect()}
    assert {(r["tile_lat"], r["tile_lon"]): r["numphotons"] for r in counts.collect()} == want
    known = counts.select(F.col("tile_lon").alias("xmin"), F.col("tile_lat").alias("ymin")).withColumns({"xmax": F.col("xmin") + 5, "ymax": F.col("ymin") + 5, "is_populated": F.lit(True)})
    box = (3.0, 41.0, 12.0, 46.5)
    rows = readers.photons_in_box(spark.read.parquet(path), known, box, 5.0, 4)
    assert {r["id"] for r in rows.collect()} == {k for k, (x, y) in enumerate(pts) if 3 <= x < 12 and 41 <= y < 46.5}
    assert re.search(r"PartitionFilters: \[[^\]]*block_lon[^\]]*>= 0", rows._jdf.queryExecution().executedPlan().toString())
