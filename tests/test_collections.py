"""Catalogue links, entry lists with hooks, and fills by the nearest cell."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from relievo.operators import collections, grid

LINK = "array<struct<href:string,rel:string,inherited:boolean,title:string>>"
DATA = "https://example.org/ns/data#"


def test_links_by_the_catalogue_rules(spark):
    rows = [
        ("f", 1, [("https://a.example/x/one.h5", DATA, None, None), ("https://b.example/y/one.h5", DATA, False, "Download"), (None, DATA, False, None)]),
        ("f", 2, [("https://a.example/two.h5", None, None, None), ("https://a.example/three.h5", DATA, True, None), ("https://a.example/four.h5", "data", False, None)]),
        ("f", 3, [("https://a.example/five.h5", DATA, False, "OPeNDAP access"), ("https://a.example/two.h5", DATA, False, None), ("https://a.example/six.h5", DATA, False, None)]),
        ("g", 4, [("https://a.example/one.h5", DATA, False, None)]), ("g", 5, None), ("g", 6, []),
    ]
    entries = spark.createDataFrame(rows, f"feed string, place_no int, links {LINK}")
    out = collections.data_links(entries, "place_no", by=["feed"])
    assert sorted(tuple(r) for r in out.collect()) == [
        ("f", 1, 0, "https://a.example/x/one.h5"), ("f", 2, 0, "https://a.example/two.h5"), ("f", 3, 2, "https://a.example/six.h5"), ("g", 4, 0, "https://a.example/one.h5"),
    ]
    # one feed for all: names are told apart across it; links that say less are kept
    bare = spark.createDataFrame([(1, [("https://a.example/one.h5",)]), (2, [("https://b.example/one.h5",), ("https://b.example/two.h5",)])], "n int, links array<struct<href:string>>")
    assert sorted(r["href"] for r in collections.data_links(bare, "n").collect()) == ["https://a.example/one.h5", "https://b.example/two.h5"]
    assert collections.data_links(entries.limit(0), "place_no").count() == 0


def test_a_source_may_make_its_own_entries(spark):
    box = "xmin double, ymin double, xmax double, ymax double"
    tiles = spark.createDataFrame([(1, 0.0, 0.0, 10.0, 10.0), (2, 10.0, 0.0, 20.0, 10.0)], f"tile_id int, {box}")
    sources = spark.createDataFrame([("a4.tif", 7, 1.0, 1.0, 2.0, 2.0), ("a5.tif", 7, 3.0, 1.0, 12.0, 2.0), ("b.tif", 8, 1.0, 1.0, 2.0, 2.0), ("c.tif", 9, 1.0, 1.0, 2.0, 2.0)], f"filename string, source_id int, {box}")
    registry = spark.createDataFrame([(7, "a", 7, True), (8, "b", 5, True), (9, "c", 3, False)], "id_number int, dset_name string, ranking_score int, is_active boolean")
    finer = lambda e: e.withColumn("weight", F.col("weight") + F.regexp_extract("filename", r"(\d)\.", 1).cast("double") / 10)
    out = sorted(tuple(r) for r in collections.entry_lists(tiles, sources, registry, 10, {"a": finer}).collect())
    assert out == [(1, "a4.tif", 7.4, "a"), (1, "a5.tif", 7.5, "a"), (1, "b.tif", 5.0, "b"), (2, "a5.tif", 7.5, "a")]
    none = collections.entry_lists(tiles, sources, registry, 10, {"a": lambda e: e.limit(0)}).collect()
    assert [r["filename"] for r in none] == ["b.tif"]
    assert collections.entry_lists(tiles, sources, registry, 10, {}).count() == 4


def test_cut_and_fill_by_the_nearest(spark):
    cells = spark.createDataFrame([(0, i, j, float(j)) for i in range(3) for j in range(40)], "tile_id int, i int, j int, value double")
    inside = F.col("j").between(5, 30)
    out = {(r["i"], r["j"]): r["value"] for r in grid.cut_and_fill(cells, inside, 100, how="nearest").collect()}
    assert len(out) == 120 and out[1, 10] == 4.0 and out[1, 28] == 31.0
    near = grid.cut_and_fill(cells, inside, 2, how="nearest")
    assert near.count() == 120 - 3 * 22
    with pytest.raises(ValueError, match="no way"):
        grid.cut_and_fill(cells, inside, 2, how="other")
