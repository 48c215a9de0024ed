"""Small tables with answers by inspection."""

from __future__ import annotations

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from relievo.functions import datums, geometry, names
from relievo.operators import collections, filters, grid, joins, lakes, ranking, validation
from relievo.plans.components import connected_components
from relievo.plans.ranges import overlap_join
from relievo.sources import readers, writers
from relievo.streaming import jobs


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def got(df):
    return sorted(tuple(r) for r in df.collect())


def test_slope_of_a_plane_is_constant(spark):
    cells = frame(spark, [(0, i, j, 1000.0 * j) for i in range(5) for j in range(5)], "tile_id int, i int, j int, value double")
    out = grid.slope(cells, 0.01, -0.01).collect()
    assert len(out) == 9 and len({round(r["slope"], 9) for r in out}) == 1
    import math

    assert abs(out[0]["slope"] - math.degrees(math.atan(1000 / (0.01 * 111120)))) < 1e-9


def test_isolated_cells(spark):
    pixels = {"single": [(0, 0)], "pair": [(0, 5), (0, 6)], "triple": [(5, 0), (5, 1), (5, 2)], "four": [(9, 0), (10, 0), (11, 0), (11, 1)]}
    cells = frame(spark, [(0, i, j) for v in pixels.values() for i, j in v], "tile_id int, i int, j int")
    gone = {(r["i"], r["j"]) for r in grid.isolated(cells, 3).collect()}
    assert set(pixels["single"] + pixels["pair"] + pixels["triple"]) <= gone
    assert (11, 0) not in gone and (10, 0) not in gone
    corner = frame(spark, [(0, 0, 0), (0, 0, 1), (0, 1, 0), (1, 5, 5), (1, 5, 6), (1, 6, 5), (1, 6, 6)], "tile_id int, i int, j int")
    assert got(grid.isolated(corner, 3)) == [(0, 0, 0), (0, 0, 1), (0, 1, 0)]


def test_diagonal_lakes_stay_apart(spark):
    cells = frame(spark, [("a", 0, 0), ("a", 1, 1), ("b", 0, 0), ("b", 0, 1)], "tile_id string, i int, j int")
    assert [n for _, n in got(lakes.label(cells).groupBy("tile_id").agg(F.count_distinct("lake").alias("n")))] == [2, 1]


def test_components_of_a_long_path(spark):
    edges = frame(spark, [(k, k + 1) for k in range(60)] + [(100, 101), (7, 7), (None, 3)], "a long, b long")
    out = dict(got(connected_components(edges)))
    assert {out[k] for k in range(61)} == {0} and out[101] == 100
    assert connected_components(edges.limit(0)).count() == 0


def test_average_with_a_hole(spark):
    cells = frame(spark, [(0, i, j, float(i * 4 + j)) for i in range(4) for j in range(4) if (i, j) != (0, 0)], "tile_id int, i int, j int, value double")
    assert got(grid.average(cells, 2).where("i = 0 and j = 0").select("value", "n")) == [(pytest.approx((1 + 4 + 5) / 3), 3)]


def test_box_edges(spark):
    points = frame(spark, [(0.0, 0.0), (1.0, 1.0), (0.0, 1.0), (1.0, 0.0), (0.5, 0.5)], "x double, y double")
    box = (0, 0, 1, 1)
    assert got(filters.in_box(points, "x", "y", box)) == [(0.0, 0.0), (0.5, 0.5)]
    assert got(filters.in_box(points, "x", "y", box, "raster")) == [(0.0, 1.0), (0.5, 0.5)]
    assert filters.in_box(points, "x", "y", box, "closed").count() == 5
    with pytest.raises(ValueError):
        filters.in_box(points, "x", "y", box, "odd")


def test_overlap_join_drops_touching_boxes(spark):
    a = frame(spark, [(1, 0.0, 0.0, 1.0, 1.0), (2, 1.0, 0.0, 2.0, 1.0), (3, -7.5, -3.0, 9.0, 4.0)], "id int, xmin double, ymin double, xmax double, ymax double")
    pairs = {(r["l"]["id"], r["r"]["id"]) for r in overlap_join(a, a, 2.0).collect()}
    assert pairs == {(1, 1), (2, 2), (3, 3), (1, 3), (3, 1), (2, 3), (3, 2)}
    assert overlap_join(a, a, 2.0).count() == 7


def test_reject_list_golden(spark):
    rows = [("ATL03_20211117151120_08581302_005_01.h5", 30313, str(k)) for k in range(12)] + [("ATL03_20211117151120_08581302_005_01.h5", 30318, "x")]
    rows += [("g2", 900, "a"), ("g3", 5000, "a"), ("g4", 100, "a"), ("g4", 100, "b")]
    out = got(validation.reject_list(frame(spark, rows, "granule string, photon_count long, csv_filename string")))
    assert out == [("ATL03_20211117151120_08581302_005_01.h5", 13, 394074)]


def test_outlier_granules_against_all_pairs(spark):
    import itertools
    import random

    random.seed(3)
    stats = [(k, 20 + k % 3, random.choice([0.0, 1.0, 5.0, 50.0]) + random.random(), random.random()) for k in range(30)] + [(99, 25, 500.0, 1.0), (98, 5, 900.0, 1.0)]
    apart = {k: 0 for k, *_ in stats if _[0] >= 20}
    kept = [s for s in stats if s[1] >= 20]
    for a, b in itertools.combinations(kept, 2):
        if a[2] + 2 * a[3] < b[2] - 2 * b[3] or b[2] + 2 * b[3] < a[2] - 2 * a[3]:
            apart[a[0]] += 1
            apart[b[0]] += 1
    want = sorted(k for k, n in apart.items() if n >= 3 and n >= len(kept) - 2)
    out = validation.outlier_granules(frame(spark, stats, "g int, n int, mean double, std double"), ["g"])
    assert [k for k, *_ in got(out)] == want == [99]


def test_point_in_ring_with_hole_of_a_corner(spark):
    ring = F.array(*(F.struct(F.lit(float(x)).alias("x"), F.lit(float(y)).alias("y")) for x, y in [(0, 0), (4, 0), (4, 4), (0, 4), (0, 0)]))
    points = frame(spark, [(2.0, 2.0), (5.0, 2.0), (0.0, 2.0), (4.0, 2.0), (2.0, 0.0), (2.0, 4.0)], "x double, y double")
    assert [r[0] for r in points.select(geometry.contains(ring, F.col("x"), F.col("y"))).collect()] == [True, False, True, False, True, False]


def test_projections(spark):
    one = spark.range(1)
    xy = one.select(geometry.project(F.lit(15.0), F.lit(0.0), 32633).alias("u"), geometry.project(F.lit(-45.0), F.lit(70.0), 3413).alias("n"), geometry.project(F.lit(0.0), F.lit(-71.0), 3031).alias("s")).first()
    assert xy["u"]["x"] == pytest.approx(500000) and xy["u"]["y"] == pytest.approx(0, abs=1e-6)
    assert xy["n"]["x"] == pytest.approx(0, abs=1e-3) and xy["n"]["y"] == pytest.approx(-2187840.2, abs=1000)
    assert xy["s"]["y"] == pytest.approx(2082760, abs=1000)
    utm = one.select(geometry.to_utm(F.lit(9.0), F.lit(45.0), 32).alias("u")).first()["u"]
    assert utm["x"] == pytest.approx(500000) and utm["y"] == pytest.approx(4982950.4, abs=1)
    with pytest.raises(ValueError):
        geometry.project(F.lit(0.0), F.lit(0.0), 2154)


def test_names(spark):
    df = frame(spark, [(-5, 120), (45, -7)], "y int, x int")
    assert [r[0] for r in df.select(names.tile_tag(F.col("y"), F.col("x"))).collect()] == ["S05E120", "N45W007"]
    with pytest.raises(PySparkException):
        df.select(names.other_product(F.lit("abc"))).collect()
    assert df.select(datums.vertical_epsg(F.lit("5773")), datums.vertical_epsg(F.lit("EGM2008"))).first()[:] == (5773, 3855)


def test_supersede_does_not_depend_on_order(spark):
    rows = [(0, 0, 1.0, "a", 5.0), (0, 0, 2.0, "b", 7.0), (0, 0, 2.0, "a", 9.0), (1, 0, 1.0, "z", None)]
    schema = "i int, j int, weight double, filename string, elev double"
    assert got(ranking.supersede(frame(spark, rows, schema))) == got(ranking.supersede(frame(spark, rows[::-1], schema)))
    assert got(ranking.supersede(frame(spark, rows, schema)).where("i = 0")) == [(0, 0, 7.0, 2.0, "b")]


def test_rectangles_are_end_exclusive(spark):
    cells = frame(spark, [("t", i, 0) for i in range(5)], "tile_id string, i int, j int")
    boxes = frame(spark, [("t", 1, 3, 0, 1)], "tile_id string, i0 int, i1 int, j0 int, j1 int")
    assert [i for _, i, _ in got(filters.outside_rectangles(cells, boxes))] == [0, 3, 4]


def test_grid_differences(spark):
    a = frame(spark, [("t", 0.0, 1.0, 0.5, -0.5), ("u", 0.0, 1.0, 0.5, -0.5)], "tile_id string, xleft double, ytop double, xres double, yres double")
    b = a.withColumn("xleft", F.when(F.col("tile_id") == "u", 1e-6).otherwise(1e-15))
    assert got(filters.same_grid(a, b)) == [("u",)]


def test_files_round_trip(spark, tmp_path):
    (tmp_path / "a_config.ini").write_text('dataset_name = "A"\ndefault_ranking_score = 3.5\ndataset_id_number = 4\nis_active = True\n')
    (tmp_path / "b_config.ini").write_text("dataset_name = B # old\ndefault_ranking_score = __import__('os')\nis_active = False\n")
    out = got(readers.registry(spark, str(tmp_path / "*_config.ini")).select("dset_name", "ranking_score", "id_number", "is_active"))
    assert out == [("A", 3.5, 4, True), ("B", None, None, False)]
    (tmp_path / "g.asc").write_text("ncols 3\nnrows 2\nxllcorner 0\nyllcorner 0\ncellsize 1\nNODATA_value -9999\n1 2 -9999\n4 5 6\n")
    _, cells = readers.ascii_grids(spark, str(tmp_path / "g.asc"))
    assert [tuple(r)[1:] for r in sorted(cells.collect())] == [(0, 0, 1.0), (0, 1, 2.0), (1, 0, 4.0), (1, 1, 5.0), (1, 2, 6.0)]
    (tmp_path / "x.xml").write_text("<T><Row><F>1</F><F>20</F><F>Coast Office</F><F>4.5</F></Row><Row><F>2</F><F>x</F><F>USGS</F><F>8</F></Row></T>")
    assert got(readers.attribute_table(spark, str(tmp_path / "x.xml"))) == [(1, 20, "Coast Office", 4.5), (2, None, "USGS", 8.0)]
    listed = readers.list_files(spark, str(tmp_path), r"\.asc$", 0)
    assert [r["path"].rsplit("/", 1)[1] for r in listed.collect()] == ["g.asc"]


def test_results_and_tables(spark, tmp_path):
    rows = frame(spark, [(5, 1.0), (2, 1.0), (9, None), (9, float("nan")), (9, -99999.0)], "n_trim int, diff_mean double")
    writers.write_results(rows, str(tmp_path / "r.parquet"))
    assert readers.read_results(spark, [str(tmp_path / "r.parquet")], True).count() == 1
    writers.write_results(rows.where("n_trim = 5"), str(tmp_path / "r.csv"), "csv")
    assert readers.read_table(spark, str(tmp_path / "r.csv")).collect()[0]["n_trim"] == 5
    with pytest.raises(ValueError):
        readers.read_table(spark, "a.pickle")
    assert readers.empty_photons(spark).count() == 0
    import pyarrow as pa
    from pyarrow import feather

    feather.write_feather(pa.table({"a": [1, 2]}), str(tmp_path / "f.feather"))
    assert got(readers.read_feather(spark, str(tmp_path / "f.feather"), "a long")) == [(1,), (2,)]
    full = writers.dense(frame(spark, [("t", 0, 1, 2.0)], "tile_id string, i int, j int, value double"), frame(spark, [("t", 2, 2)], "tile_id string, xsize int, ysize int"))
    assert got(writers.grid_lines(full)) == [("t", 0, "-99999.0 2.0"), ("t", 1, "-99999.0 -99999.0")]


def test_upsert_twice_changes_nothing(spark):
    schema = "k int, v string, n int"
    old, new = frame(spark, [(1, "a", 1), (2, "b", 1)], schema), frame(spark, [(2, "c", 2), (3, "d", 1)], schema)
    once = jobs.upsert(old, new, ["k"], "n")
    assert got(once) == [(1, "a", 1), (2, "c", 2), (3, "d", 1)] == got(jobs.upsert(once, new, ["k"], "n"))


def test_lookups_that_must_succeed(spark):
    cells = frame(spark, [("t", 0, 0), ("t", 0, 1)], "tile_id string, i int, j int")
    table = frame(spark, [("t", 0, 0, 1.0)], "tile_id string, i int, j int, slope double")
    with pytest.raises(PySparkException):
        joins.lookup(cells, table, ["tile_id", "i", "j"], "slope").collect()
    with pytest.raises(PySparkException):
        joins.matched(cells.select(F.col("j").alias("g")), cells.where("j = 9").select(F.col("j").alias("g")), "g").collect()


def test_tiles_without_a_scheme_entry_raise(spark):
    scheme = frame(spark, [(1, 5), (2, 6), (2, 7)], "tile int, utm int")
    assert got(joins.unique_lookup(frame(spark, [(1,)], "tile int"), scheme, "tile")) == [(1, 5)]
    for missing in (2, 3):
        with pytest.raises(PySparkException, match="single entry"):
            joins.unique_lookup(frame(spark, [(missing,)], "tile int"), scheme, "tile").collect()


def test_lake_rules_look_at_the_lakes_own_cells(spark):
    # lake 1 is a ring whose box holds lake 2
    ring = [("t", 1, i, j) for i in range(5) for j in range(5) if i in (0, 4) or j in (0, 4)]
    cells = frame(spark, [*ring, ("t", 2, 2, 2), ("u", 3, 0, 0), ("v", 4, 0, 0)], "tile_id string, lake int, i int, j int")
    rules = frame(spark, [(1, "t", 2, 2, True, False), (2, "t", 0, 0, True, True), (3, "u", 9, 9, True, True), (4, "u", -1, -1, True, False)], "place int, tile_id string, row int, col int, decision boolean, all_other boolean")
    assert sorted((r["lake"], r["decision"]) for r in joins.exceptions(cells, rules).collect()) == [(1, True), (2, True), (3, False), (4, None)]


def test_land_of_a_hypsometry_is_masked(spark):
    cells = frame(spark, [(-100.0, 0), (-100.0, 1), (-500.0, 1), (50.0, 1), (50.0, 0), (100.0, 1)], "value double, land int")
    out = {(r["unit"], r["threshold"]): (r["all_above"], r["land_above"], r["pct_land"]) for r in validation.hypsometry_table(cells, F.col("land") > 0).collect()}
    assert len(out) == 527 and out["m", -11000.0] == (6, 3, 100.0) and out["m", -100.0] == (5, 3, 100.0) and out["m", 100.0] == (1, 1, pytest.approx(100 / 3))
    assert out["ft", 200.0] == (1, 1, pytest.approx(100 / 3)) and out["ft", 29200.0] == (0, 0, 0.0)
    none = validation.hypsometry(cells, 0.0, 10.0, 2, land=F.lit(0)).collect()
    assert [r["pct_land"] for r in none] == [0.0, 0.0]
    # a value on a threshold in feet counts there
    exact = frame(spark, [((-36000.0 + 200.0 * k) / validation.FEET_IN_METRE, 1) for k in range(327)], "value double, land int")
    feet = [r["all_above"] for r in validation.hypsometry(exact, *validation.FEET, scale=validation.FEET_IN_METRE).orderBy("threshold").collect()]
    assert feet == list(range(327, 0, -1))


def test_granules_are_stacked_in_each_bin(spark):
    rows = frame(spark, [(1, 0.1), (1, 0.2), (2, 0.1), (2, 0.9), (3, 0.9), (3, 1.0)], "g int, v double")
    assert got(validation.histogram(rows, "v", 0.0, 1.0, 2, ["g"])) == [(1, 0, 2, 2), (2, 0, 1, 3), (2, 1, 1, 1), (3, 1, 2, 3)]
    assert got(validation.histogram(rows, "v", 0.0, 1.0, 2)) == [(0, 3, 3), (1, 3, 6)]


def test_datum_names(spark):
    names_of = ["wgs84", "itrf2014", "navd88", "guvd04", "nmvd03", "asvd02", "prvd02", "vivd09", "egm2008", "egm96", "egm84", "msl", "wgs84(g1150)", "cgvd2013(cgg2013)", "cgvd2013", "cgvd2013(cgg2013a)", "unk", " 4326"]
    out = frame(spark, [(k, n) for k, n in enumerate(names_of)], "k int, n string").select("k", datums.vertical_epsg(F.col("n")).alias("e"))
    assert [e for _, e in got(out)] == [7912, 7912, 5703, 6644, 6644, 6643, 6641, 6641, 3855, 5773, 5798, 5174, 7660, 6647, 6647, 9245, None, 4326]


def test_lakes_across_tiles_of_many_columns(spark):
    cells = frame(spark, [("a", 0, 1 << 20), ("b", 1, 0), ("b", 1, 1), ("c", 2, 1), ("c", 2, 3)], "tile_id string, i int, j int")
    out = {(r["i"], r["j"]): r["lake"] for r in lakes.label(cells, across_tiles=True).collect()}
    assert len({out[0, 1 << 20], out[1, 0], out[2, 3]}) == 3 and out[1, 0] == out[1, 1] == out[2, 1] == 1 << 32


def test_catalogue_from_several_batches(spark, tmp_path):
    start = frame(spark, [("a", 0, None), ("b", 1, None)], "name string, xmin int, n int")
    box, schema = ["xmin"], "name string, xmin int, n int"

    def arrive(*rows):
        frame(spark, rows, schema).coalesce(1).write.mode("append").option("header", True).csv(f"{tmp_path}/spool")

    def run():
        jobs.upsert_stream(jobs.spool(spark, f"{tmp_path}/spool", schema), f"{tmp_path}/table", f"{tmp_path}/state", ["name"], "n", start, box).awaitTermination()
        return sorted(tuple(r) for r in jobs.latest(spark, f"{tmp_path}/table").collect())

    arrive(("a", 0, 3))
    assert run() == [("a", 0, 3), ("b", 1, None)]
    arrive(("a", 0, 2), ("b", 1, 7))
    arrive(("b", 1, 9))
    assert run() == [("a", 0, 3), ("b", 1, 9)]
    versions = sorted(p.name for p in tmp_path.glob("table/v*"))
    assert len(versions) <= 2
    arrive(("a", 5, 4))  # another box than the catalogue's
    with pytest.raises(Exception, match="does not fit"):
        run()
    with pytest.raises(PySparkException, match="does not fit"):
        jobs.matched(start, frame(spark, [("z", 0, 1)], schema), ["name"], box).collect()


def test_late_rows_miss_a_closed_window(spark, tmp_path):
    def arrive(name, *rows):
        frame(spark, rows, "cell int, ts string, v double").selectExpr("cell", "cast(ts as timestamp) ts", "v").coalesce(1).write.parquet(f"{tmp_path}/in/{name}")

    def run():
        rows = spark.readStream.schema("cell int, ts timestamp, v double").parquet(f"{tmp_path}/in/*")
        out = jobs.running_statistics(rows, ["cell"], "v")
        sink = out.writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/state").outputMode("append")
        sink.trigger(availableNow=True).start().awaitTermination()
        return sorted((r["cell"], str(r["window"]["start"])[:10], r["n"]) for r in spark.read.schema(out.schema).parquet(f"{tmp_path}/out").collect())

    arrive("1", (1, "2024-01-01 10:00:00", 1.0), (1, "2024-01-01 11:00:00", 3.0), (1, "2024-01-04 00:00:00", 5.0))
    assert run() == [(1, "2024-01-01", 2)]
    arrive("2", (1, "2024-01-01 12:00:00", 9.0), (2, "2024-01-03 01:00:00", 9.0), (1, "2024-01-08 00:00:00", 9.0))
    assert run() == [(1, "2024-01-01", 2), (1, "2024-01-04", 1), (2, "2024-01-03", 1)]


def test_tiles_validated_again(spark, tmp_path):
    photons = frame(spark, [(1, 1, 0, 5.0), (1, 2, 0, 7.0), (2, 2, 0, 9.0), (3, 1, 0, 4.0)], "tile_id int, granule_id1 int, granule_id2 int, h double")
    validate = lambda rows: rows.groupBy("tile_id").agg(F.count("*").alias("n"), F.avg("h").alias("mean"))
    path = str(tmp_path / "results")
    validate(photons).write.partitionBy("tile_id").parquet(path)
    before = {p: p.stat().st_mtime_ns for p in (tmp_path / "results").glob("tile_id=2/*.parquet")}
    jobs.revalidate(path, photons, frame(spark, [(1, 0)], "granule_id1 int, granule_id2 int"), validate)
    assert got(spark.read.parquet(path).select("tile_id", "n", "mean")) == [(1, 1, 7.0), (2, 1, 9.0)]
    assert before == {p: p.stat().st_mtime_ns for p in (tmp_path / "results").glob("tile_id=2/*.parquet")}


def test_frames_of_the_global_tiles(spark):
    assert {s: grid.tile_frame(spark, s).count() for s in (1, 15, 30, 60)} == {1: 64800, 15: 288, 30: 1, 60: 1}
    world = grid.tile_frame(spark, 60).first()
    assert (world["tile"], world["xsize"], world["ysize"], world["ytop"]) == ("S90W180", 21600, 10800, 90.0)
    assert grid.tile_frame(spark, 15).where("tile = 'N30E045'").first()["xsize"] == 3600
    with pytest.raises(ValueError):
        grid.tile_frame(spark, 3)


def test_cut_cells_are_filled_and_smoothed(spark):
    cells = frame(spark, [(0, i, j, 10.0 if (i, j) != (2, 2) else 99.0) for i in range(5) for j in range(5)], "tile_id int, i int, j int, value double")
    inside = (F.col("i").between(1, 3)) & (F.col("j").between(1, 3))
    for smooth in (0, 2):
        out = grid.cut_and_fill(cells, inside, 3, smooth)
        assert out.count() == 25 and {round(r["value"], 9) for r in out.collect()} == {10.0}
    steps = frame(spark, [(0, 0, 0, 0.0), (0, 0, 1, 50.0), (0, 0, 2, 9.0)], "tile_id int, i int, j int, value double")
    assert got(grid.cut_and_fill(steps, F.col("j") == 1, 1, 1).where("j = 1").select("value")) == [(pytest.approx(4.5),)]


def test_tables_written_back_and_missing_tiles(spark, tmp_path):
    path = str(tmp_path / "table")
    assert readers.read_photon_tiles(spark, path) is None
    writers.replace_table(frame(spark, [(1.0, 2.0)], "tile_lat double, tile_lon double"), path)
    writers.replace_table(spark.read.parquet(path).withColumn("more", F.lit(1)), path)
    assert spark.read.parquet(path).columns == ["tile_lat", "tile_lon", "more"] and spark.read.parquet(f"{path}.old").columns == ["tile_lat", "tile_lon"]
    assert readers.read_photon_tiles(spark, path, 1.0, 2.0).count() == 1 and readers.read_photon_tiles(spark, path, 1.0, 3.0) is None


def test_several_reference_systems_raise(spark):
    rows = frame(spark, [("a", 4326, 1.0, 2.0), ("a", 4326, 3.0, 4.0), ("b", 4326, 0.0, 0.0), ("b", 32633, 1.0, 1.0)], "c string, epsg int, x double, y double")
    assert got(validation.bounds(rows.where("c = 'a'"), "x", "y", ["c"], "epsg")) == [("a", 1.0, 2.0, 3.0, 4.0)]
    with pytest.raises(PySparkException, match="several reference systems"):
        validation.bounds(rows, "x", "y", ["c"], "epsg").collect()


def test_only_missing_outputs_are_made(spark):
    tasks, done = frame(spark, [(k, k * k) for k in range(6)], "k long, v long"), frame(spark, [(1,), (4,)], "k long")
    work = lambda rows: rows.assign(v=rows["v"] + 1)
    assert got(collections.map_missing(tasks, done, ["k"], work, "k long, v long")) == [(0, 1), (2, 5), (3, 10), (5, 26)]
    assert collections.map_missing(tasks, done, ["k"], work, "k long, v long", overwrite=True).count() == 6


def test_approximate_percentiles_are_near(spark):
    rows = spark.range(10000).select((F.col("id") / 100).alias("diff_mean"), F.lit(1).alias("n_trim"), F.lit(0.0).alias("canopy"), F.lit(0.0).alias("std"))
    exact, near = (validation.summary(rows, accuracy=a).first()["percentiles"] for a in (None, 10000))
    assert all(abs(a - b) <= 0.02 for a, b in zip(exact, near, strict=True))
