"""Forms that hold at scale, against the plain ones: level grids, selected percentiles, sketches, blocks of lakes."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from relievo.operators import lakes, validation
from relievo.plans.percentiles import percentiles
from relievo.plans.ranges import overlap_join

BOXES = "id int, xmin double, ymin double, xmax double, ymax double"


def boxes(seed, n):
    """Boxes of sides over six orders of magnitude, many in one corner, some that only touch."""
    r = random.Random(seed)
    out = []
    for k in range(n):
        side = 10 ** r.uniform(-3, 2.5)
        x, y = (r.uniform(-180, 180), r.uniform(-90, 90)) if k % 2 else (r.uniform(0, 0.5), r.uniform(0, 0.5))
        out.append((k, x, y, x + side, y + side * r.uniform(0.01, 1)))
    return [*out, (n, -180.0, -90.0, 180.0, 90.0), (n + 1, 0.0, 0.0, 1.0, 1.0), (n + 2, 1.0, 0.0, 2.0, 1.0), (n + 3, 1.0, 1.0, 2.0, 2.0), (n + 4, None, 0.0, 1.0, 1.0)]


def test_boxes_of_all_sizes_meet(spark):
    a, b = boxes(1, 150), boxes(2, 120)
    l, r = spark.createDataFrame(a, BOXES), spark.createDataFrame(b, BOXES)
    meets = lambda p, q: None not in p + q and p[1] < q[3] and p[3] > q[1] and p[2] < q[4] and p[4] > q[2]
    want = sorted((p[0], q[0]) for p in a for q in b if meets(p, q))
    for size in (0.001, 0.5, 1000.0):
        got = sorted((x["l"], x["r"]) for x in overlap_join(l, r, size).select(F.col("l.id").alias("l"), F.col("r.id").alias("r")).collect())
        assert got == want
    assert overlap_join(l.limit(0), r, 1.0).count() == 0


def test_a_world_box_among_small_ones(spark):
    world = spark.createDataFrame([(0, -180.0, -90.0, 180.0, 90.0)], BOXES)
    small = spark.createDataFrame([(k, k / 10, 0.0, k / 10 + 1e-4, 1e-4) for k in range(50)], BOXES)
    assert overlap_join(world, small, 1e-4).count() == 50  # with cells of one size the world would meet 10^13


@pytest.mark.parametrize("by", [(), ("g",), ("g", "h")])
def test_percentiles_are_exact(spark, by):
    r = random.Random(3)
    rows = [(None if k % 7 == 0 else k % 5, "x" if k % 3 else None, r.choice([None, float(r.randrange(6)), r.gauss(0, 1e3), 2.0])) for k in range(3000)] + [(99, "x", None), (98, "x", 1.5)]
    df = spark.createDataFrame(rows, "g int, h string, v double").repartition(6)
    shares = (0.0, 0.01, 0.1, 0.25, 1 / 3, 0.5, 0.9, 0.999, 1.0)
    got = {tuple(x[:-1]): x[-1] for x in percentiles(df, "v", shares, by).collect()}
    want = {tuple(x[:-1]): x[-1] for x in df.where("v is not null").groupBy(*by).agg(F.percentile("v", F.array(*map(F.lit, shares)))).collect()}
    assert got == want
    assert percentiles(df.limit(0), "v", shares, by).count() == 0


def test_one_large_group_is_sorted_by_bins(spark):
    df = spark.range(200_000).select((F.xxhash64("id") % 100_000).cast("double").alias("v"))
    assert percentiles(df, "v", (0.1, 0.5, 0.977)).first()["percentiles"] == df.agg(F.percentile("v", F.array(F.lit(0.1), F.lit(0.5), F.lit(0.977)))).first()[0]


def results(spark):
    r = random.Random(5)
    rows = [(k % 6 if k % 11 else None, k % 9 + 3, r.gauss(1, 5), r.choice([0.0, 0.0, 0.4]), abs(r.gauss(0, 1))) for k in range(4000)]
    return spark.createDataFrame(rows, "tile_id int, n_trim int, diff_mean double, canopy double, std double")


def test_summary_by_group_and_whole(spark):
    rows = results(spark)
    for by in ((), ("tile_id",)):
        exact = {tuple(x[c] for c in by): x for x in validation.summary(rows, by).collect()}
        d = F.array(*(F.lit(p / 100) for p in validation.PERCENTS))
        want = rows.groupBy(*by).agg(F.percentile("diff_mean", d).alias("p"), F.count("*").alias("n")).collect()
        assert len(exact) == len(want)
        for x in want:
            assert exact[tuple(x[c] for c in by)]["percentiles"] == x["p"] and exact[tuple(x[c] for c in by)]["n_cells"] == x["n"]
        assert validation.summary(rows, by, accuracy=10000).columns == validation.summary(rows, by).columns
    empty = validation.summary(rows.limit(0)).first()
    assert empty["n_cells"] == 0 and empty["percentiles"] is None
    assert validation.error_marks(rows).columns == validation.error_marks(rows, accuracy=1000).columns
    assert validation.clipped(rows, "diff_mean", 0.25, 0.75).count() == 2000


def test_sketches_roll_up(spark):
    rows = results(spark)
    sketches = validation.error_sketches(rows)
    assert sketches.count() == 7
    whole = validation.sketched_percentiles(sketches).first()
    v = np.sort([x["diff_mean"] for x in rows.collect()])
    assert whole["n"] == 4000
    for p, q in zip(validation.PERCENTS, whole["percentiles"]):
        assert abs(np.searchsorted(v, q) / 4000 - p / 100) < 0.02
    few = validation.sketched_percentiles(validation.error_sketches(rows.limit(101).coalesce(1), ()), ()).first()  # held exactly
    assert few["percentiles"][6] == float(np.sort([x["diff_mean"] for x in rows.limit(101).coalesce(1).collect()])[50])


def test_dense_cells_have_the_same_statistics(spark):
    r = random.Random(6)
    photons = spark.createDataFrame([(0, k % 3, 1, float(r.randrange(4000)) / 8, r.choice([0, 1, 1, 1, 2, 3])) for k in range(5000)] + [(0, 9, 9, 1.0, 1)] * 2, "tile_id int, i int, j int, h_geoid double, class_code int")
    cells = spark.createDataFrame([(0, i, 1, 10.0 * i) for i in range(3)] + [(0, 9, 9, 1.0)], "tile_id int, i int, j int, value double")
    plain, dense = validation.cell_statistics(photons, cells), validation.cell_statistics(photons, cells, dense=True)
    assert sorted(dense.columns) == sorted(plain.columns)
    rounded = lambda df: sorted(tuple(round(v, 9) if isinstance(v, float) else v for v in x) for x in df.select(*sorted(df.columns)).collect())
    assert rounded(dense) == rounded(plain) and len(rounded(plain)) == 3


def test_photons_equal_to_a_decile_stay(spark):
    heights = [1710.375, 1710.375, 5987.5]  # 0.8 * h + 0.2 * h, fused, is one unit above h
    low, high = np.percentile(heights, [10, 90])
    photons = spark.createDataFrame([(0, 0, 0, h, 1) for h in heights], "tile_id int, i int, j int, h_geoid double, class_code int")
    cells = spark.createDataFrame([(0, 0, 0, 100.0)], "tile_id int, i int, j int, value double")
    for dense in (False, True):
        r = validation.cell_statistics(photons, cells, dense=dense).first()
        assert (r["n_ground"], r["n_trim"], r["mean"], r["p10"]) == (3, 2, heights[0], low) and r["p90"] == pytest.approx(high)


@pytest.mark.parametrize("block", [3, 4, 7, 64])
def test_lakes_across_blocks(spark, block):
    r = random.Random(block)
    cells = {(t, i, j) for t in "ab" for i in range(25) for j in range(30) if r.random() < 0.6}
    cells |= {("c", i, 0) for i in range(40)} | {("c", 39, j) for j in range(40)} | {("c", 0, 39)}
    cells |= {("d", i, j) for i in range(20) for j in range(20) if i % 4 == 0 or (j == (19 if i // 4 % 2 else 0))}  # a winding lake
    left, want = set(cells), {}
    while left:
        stack = [left.pop()]
        part = set(stack)
        while stack:
            t, i, j = stack.pop()
            for n in ((t, i + 1, j), (t, i - 1, j), (t, i, j + 1), (t, i, j - 1)):
                if n in left:
                    left.discard(n)
                    part.add(n)
                    stack.append(n)
        least = min(i * (1 << 20) + j for _, i, j in part)
        want |= dict.fromkeys(part, least)
    df = spark.createDataFrame([(*c, "extra") for c in cells], "tile_id string, i int, j int, root string").repartition(3)
    out = lakes.label(df, block=block)
    assert out.columns == ["tile_id", "i", "j", "root", "lake"]
    assert {(x["tile_id"], x["i"], x["j"]): x["lake"] for x in out.collect()} == want
    assert lakes.label(df.limit(0), block=block).count() == 0
