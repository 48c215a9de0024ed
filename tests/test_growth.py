"""Steps whose cost must not run ahead of their input."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from relievo.operators import joins
from relievo.plans import ranges
from relievo.sources import readers, writers


def test_pairs_of_one_tag_come_from_several_tasks(spark):
    files = spark.createDataFrame([(k, f"x_n40w100_{k}") for k in range(60)] + [(99, "no tag"), (98, None)], "key int, name string")
    b = files.select(F.col("key").alias("key_b"), F.col("name").alias("other"))
    out = joins.by_tag(files, b, "name", "other", r"n\d{2}w\d{3}", ["key_b"])
    assert sorted(out.columns) == ["companion", "key", "key_b", "name", "tag"]
    assert sorted((r["key"], r["key_b"]) for r in out.collect()) == [(x, y) for x in range(60) for y in range(60)]
    assert out.select(F.spark_partition_id()).distinct().count() > 1


def test_pairs_of_a_large_tag_take_few_bytes(spark, tmp_path):
    a = spark.range(800).select(F.col("id").alias("key"), F.lit("x_n40w100").alias("name"))
    b = spark.range(25000).select(F.col("id").alias("key_b"), F.lit("y_n40w100").alias("other"))
    out = joins.by_tag(a, b, "name", "other", r"n\d{2}w\d{3}", ["key_b"]).select("key", "key_b", "tag")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as where both sides are large
    try:
        out.write.parquet(str(tmp_path / "pairs"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    rows = spark.read.parquet(str(tmp_path / "pairs"))
    assert rows.agg(F.count("*"), F.sum("key"), F.sum("key_b")).first() == (20_000_000, 25000 * 319600, 800 * 312487500)
    assert sum(p.stat().st_size for p in (tmp_path / "pairs").glob("*.parquet")) < 20_000_000 / 2


def test_repeated_files_of_a_tag_are_all_paired(spark):
    files = spark.createDataFrame([(7, "x_n40w100")] * 1300 + [(8, "y_n40w100"), (9, None)], "key int, name string")
    out = joins.by_tag(files, files.select(F.col("key").alias("key_b"), F.col("name").alias("other")), "name", "other", r"n\d{2}w\d{3}", ["key_b"])
    assert {(r[0], r[1]): r[2] for r in out.groupBy("key", "key_b").count().collect()} == {(7, 7): 1300**2, (7, 8): 1300, (8, 7): 1300, (8, 8): 1}


def test_many_configurations_in_a_file(spark, tmp_path):
    texts = [f'dataset_name = "n{k}"\n\ndefault_ranking_score = {k}\ndataset_id_number = {k}\r\nis_active = {"True" if k % 2 else "false"}' for k in range(500)]
    writers.write_registry(spark.createDataFrame([(x,) for x in texts], "value string").repartition(3), str(tmp_path / "r"))
    assert len(list((tmp_path / "r").glob("*.txt"))) <= 3
    out = readers.registry(spark, str(tmp_path / "r" / "*.txt"), writers.RECORD).select("dset_name", "id_number", "is_active")
    assert sorted((r[1], r[0], r[2]) for r in out.collect()) == [(k, f"n{k}", k % 2 == 1) for k in range(500)]
    with pytest.raises(Exception, match="separator"):
        writers.write_registry(spark.createDataFrame([("a = 1\x1eb = 2",)], "value string"), str(tmp_path / "bad"))


def test_a_listing_tells_what_its_files_hold(spark, tmp_path):
    rows = spark.range(300).select((F.col("id") % 3).cast("double").alias("tile_lat"), (F.col("id") % 50).alias("tile_lon"))
    path = str(tmp_path / "a b" / "tiles")
    rows.repartition(2).write.partitionBy("tile_lat").parquet(path)
    listed = readers.list_files(spark, path, r"\.parquet$")
    out = readers.listed_values(listed, spark.read.parquet(path), ["tile_lon"], r"tile_lat=[^/]+/[^/]+$")
    assert out.select("path").distinct().count() == listed.count() == 6
    assert {(r["path"].split("tile_lat=")[1][:3], r["tile_lon"]) for r in out.collect()} == {(f"{k % 3}.0", k % 50) for k in range(300)}


def test_tile_folders_are_bounded(spark, tmp_path):
    # longitudes run on as in the fixtures; 120 turns of the globe
    photons = spark.range(20000).select("id", ((F.col("id") * 7919 % 43200) - 200.25).alias("longitude"), (F.col("id") % 9 + 40.5).alias("latitude"), F.lit(1).alias("class_code"))
    path = str(tmp_path / "tiles")
    counts = writers.write_photon_tiles(photons, path, 1.0, block=5)
    assert len(list((tmp_path / "tiles").glob("block_lat=*/block_lon=*"))) <= 2 * 72
    assert counts.agg(F.sum("numphotons")).first()[0] == 20000
    known = counts.select(F.col("tile_lon").alias("xmin"), F.col("tile_lat").alias("ymin")).withColumns({"xmax": F.col("xmin") + 1, "ymax": F.col("ymin") + 1, "is_populated": F.lit(True)})
    places = photons.collect()
    for box in ((3.0, 42.0, 55.5, 44.25), (170.5, 40.0, 199.0, 50.0), (-201.0, 41.0, -150.0, 47.5), (-1e3, 40.0, 1e5, 43.0), (30000.0, 40.0, 30100.0, 50.0), (175.0, 40.0, 531.0, 50.0)):
        got = readers.photons_in_box(spark.read.parquet(path), known, box, 1.0, 5)
        want = {r["id"] for r in places if box[0] <= r["longitude"] < box[2] and box[1] <= r["latitude"] < box[3]}
        assert want and {r["id"] for r in got.collect()} == want


@pytest.mark.parametrize("tile, block", [(0.1, 3), (0.25, 7), (5.0, 4), (30.0, 20)])
def test_blocks_of_a_box_hold_its_tiles(spark, tile, block):
    wide = tile * block
    xs = [k * 0.05 - 400 for k in range(16001)]
    table = spark.createDataFrame([(x,) for x in xs], "x double").withColumn("b", ranges.around(F.floor(F.col("x") / tile) * tile, wide))
    assert table.select("b").distinct().count() <= -(-360 // wide)
    rows = table.collect()
    for low, high in ((0.95, 1.0), (-180.0, -179.9), (179.9, 180.3), (170.0, 200.0), (-390.0, -200.0), (100.0, 399.0), (-400.0, 400.0)):
        kept = {r["x"] for r in table.where(ranges.around_between(F.col("b"), ranges.edge(low, tile), ranges.edge(high, tile), wide)).collect()}
        assert {r["x"] for r in rows if low <= r["x"] < high} <= kept
