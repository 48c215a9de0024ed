"""Grids: points to cells, cells to coordinates, tile tables, resampling, stencils."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def cell_index(at: Column, start: Column | float, step: Column | float) -> Column:
    """G1: the cell of a coordinate; a negative step counts downwards."""
    return F.floor((at - start) / step)


def cell_centre(index: Column, start: Column | float, step: Column | float) -> Column:
    """The coordinate of a cell's centre."""
    return start + (index + 0.5) * step


def corners(df: DataFrame) -> DataFrame:
    """SRC16, SRC17: the outline, bounds and absolute steps of rasters from their grid columns."""
    xr, yb = F.col("xleft") + F.col("xres") * F.col("xsize"), F.col("ytop") + F.col("yres") * F.col("ysize")
    return df.withColumns({
        "xmin": F.least("xleft", xr), "xmax": F.greatest("xleft", xr), "ymin": F.least("ytop", yb), "ymax": F.greatest("ytop", yb),
        "xstep": F.abs("xres"), "ystep": F.abs("yres"),
    })


def sub_raster(df: DataFrame, multiplier: int = 1, buffer: int = 0) -> DataFrame:
    """SRC18: the grid of the part of a raster that covers ``bx0..by1``, with a buffer of pixels, clamped."""
    i0 = F.greatest(F.lit(0), F.floor((F.col("by1") - F.col("ytop")) / F.col("yres")) - buffer)
    i1 = F.least(F.col("ysize"), F.ceil((F.col("by0") - F.col("ytop")) / F.col("yres")) + buffer)
    j0 = F.greatest(F.lit(0), F.floor((F.col("bx0") - F.col("xleft")) / F.col("xres")) - buffer)
    j1 = F.least(F.col("xsize"), F.ceil((F.col("bx1") - F.col("xleft")) / F.col("xres")) + buffer)
    return df.withColumns({"i0": i0, "i1": i1, "j0": j0, "j1": j1}).withColumns({
        "sub_xleft": F.col("xleft") + F.col("j0") * F.col("xres"), "sub_ytop": F.col("ytop") + F.col("i0") * F.col("yres"),
        "sub_xsize": (F.col("j1") - F.col("j0")) * multiplier, "sub_ysize": (F.col("i1") - F.col("i0")) * multiplier,
    })


def tile_grid(spark: SparkSession, size: int, bounds: Sequence[int] = (-180, -90, 180, 90)) -> DataFrame:
    """The tiles of a size in degrees over the bounds, named by their south-west corner."""
    xmin, ymin, xmax, ymax = bounds
    nx = (xmax - xmin) // size
    rows = spark.range(nx * ((ymax - ymin) // size))
    x, y = (F.col("id") % nx) * size + xmin, F.floor(F.col("id") / nx) * size + ymin
    from relievo.functions.names import tile_tag

    return rows.select(tile_tag(y, x).alias("tile"), x.alias("xmin"), y.alias("ymin"), (x + size).alias("xmax"), (y + size).alias("ymax"))


def tile_frame(spark: SparkSession, arc_seconds: int) -> DataFrame:
    """The global tiles of a resolution with their grids: 1 degree tiles at 1", 15 degrees at 15", one of the world at 30" and 60"."""
    if arc_seconds not in (1, 15, 30, 60):
        raise ValueError(f"no tiles of {arc_seconds} arc-seconds")
    if arc_seconds < 30:
        tiles, width, height = tile_grid(spark, arc_seconds), arc_seconds, arc_seconds
    else:
        tiles = spark.range(1).select(*(F.lit(v).cast("bigint").alias(c) for c, v in (("xmin", -180), ("ymin", -90), ("xmax", 180), ("ymax", 90))))
        from relievo.functions.names import tile_tag

        tiles, width, height = tiles.select(tile_tag(F.col("ymin"), F.col("xmin")).alias("tile"), "*"), 360, 180
    step = arc_seconds / 3600
    return tiles.withColumns({
        "xleft": F.col("xmin").cast("double"), "xres": F.lit(step), "ytop": F.col("ymax").cast("double"), "yres": F.lit(-step),
        "xsize": F.lit(width * 3600 // arc_seconds), "ysize": F.lit(height * 3600 // arc_seconds),
    })


def sub_tiles(cells: DataFrame, side: int) -> DataFrame:
    """Each cell's sub-tile ``(r, c)`` of ``side`` by ``side`` cells, and its place in it."""
    return cells.withColumns({"r": F.floor(F.col("i") / side), "c": F.floor(F.col("j") / side)}).withColumns({"sub_i": F.col("i") - F.col("r") * side, "sub_j": F.col("j") - F.col("c") * side})


def split_boxes(boxes: DataFrame, parts: int, x: str = "xmin", y: str = "ymin", size: float = 1.0) -> DataFrame:
    """Each box as ``parts`` by ``parts`` smaller ones; those beyond the south pole are dropped."""
    step = size / parts
    out = boxes.withColumn("r", F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))).withColumn("c", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    return out.withColumns({"sub_xmin": F.col(x) + F.col("c") * step, "sub_ymin": F.col(y) + F.col("r") * step}).where("sub_ymin >= -90")


def outward(boxes: DataFrame, y: str = "ymin") -> DataFrame:
    """Order boxes by distance from the equator, north before south."""
    return boxes.withColumn("place", F.abs(F.col(y) + 0.5)).orderBy("place", F.col(y).desc())


def average(cells: DataFrame, k: int, value: str = "value") -> DataFrame:
    """Mean over k by k blocks; missing cells do not count. One shuffle, combined map-side."""
    return cells.groupBy("tile_id", F.floor(F.col("i") / k).alias("i"), F.floor(F.col("j") / k).alias("j")).agg(F.avg(value).alias(value), F.count(value).alias("n"))


def nearest(cells: DataFrame, k: int, value: str = "value") -> DataFrame:
    """The cell at the centre of each k by k block, one up and left of it for even k."""
    at = (k - 1) // 2
    return cells.where((F.col("i") % k == at) & (F.col("j") % k == at)).select(
        "tile_id", F.floor(F.col("i") / k).alias("i"), F.floor(F.col("j") / k).alias("j"), value
    )


def nearest_at(cells: DataFrame, targets: DataFrame, value: str = "value") -> DataFrame:
    """The value of the cell that holds each target ``(id, tile_id, y, x)``, given in units of cells; null without one."""
    at = targets.withColumns({"i": F.floor("y"), "j": F.floor("x")})
    return at.join(cells.select("tile_id", "i", "j", value), ["tile_id", "i", "j"], "left").select("id", "tile_id", "y", "x", value)


def average_without_creep(cells: DataFrame, k: int, value: str = "value") -> DataFrame:
    """Block means where the nearest cell has a value."""
    return average(cells, k, value).join(nearest(cells, k, value).where(F.col(value).isNotNull()).select("tile_id", "i", "j"), ["tile_id", "i", "j"], "left_semi")


def _cubic(t: Column) -> Column:
    """The cubic-convolution kernel with a = -0.5."""
    t = F.abs(t)
    near = (1.5 * t - 2.5) * t * t + 1.0
    far = ((-0.5 * t + 2.5) * t - 4.0) * t + 2.0
    return F.when(t <= 1, near).when(t < 2, far).otherwise(0.0)


def interpolate(cells: DataFrame, points: DataFrame, kind: str = "bilinear", value: str = "value") -> DataFrame:
    """Values at fractional cell positions ``(id, tile_id, y, x)`` in units of cells.

    A point explodes to its 4 (bilinear) or 16 (cubic) neighbours; what is missing
    loses its weight. One shuffle on the cell, one on the point.
    """
    reach = {"bilinear": (0, 1), "cubic": (-1, 2)}[kind]
    steps = F.sequence(F.lit(reach[0]), F.lit(reach[1]))
    # centres lie at half cells
    spread = points.withColumns({"fy": F.col("y") - 0.5, "fx": F.col("x") - 0.5})
    spread = spread.withColumn("di", F.explode(steps)).withColumn("dj", F.explode(steps))
    spread = spread.withColumns({"i": F.floor("fy") + F.col("di"), "j": F.floor("fx") + F.col("dj")})
    ty, tx = F.col("fy") - F.col("i"), F.col("fx") - F.col("j")
    weight = (1 - F.abs(ty)) * (1 - F.abs(tx)) if kind == "bilinear" else _cubic(ty) * _cubic(tx)
    spread = spread.withColumn("w", weight).where("w <> 0")
    joined = spread.join(cells.select("tile_id", "i", "j", F.col(value).alias("v")), ["tile_id", "i", "j"])
    return joined.groupBy("id").agg(F.try_divide(F.sum(F.col("w") * F.col("v")), F.sum("w")).alias(value))


def geographic_cells(rasters: DataFrame, step: float, edge_points: int = 16) -> DataFrame:
    """GEO1: the cells of a geographic grid that projected rasters meet: row ``i`` from the north pole, column ``j`` from 180 W.

    A raster is a row with ``tile_id``, ``epsg`` and its grid (``xleft``, ``ytop``,
    ``xres``, ``yres``, ``xsize``, ``ysize``). Its outline, ``edge_points`` on each side, goes back to
    degrees and gives a box, with a rim of cells for what bulges between the points; a raster over a
    pole has all longitudes. Each cell comes with its centre as ``lon`` and ``lat``, and with the place
    ``(y, x)`` of the centre in the raster, in units of raster cells; only centres
    within the raster stay. Columns are counted around the globe once.
    """
    from relievo.functions import geometry

    xr, yb = F.col("xleft") + F.col("xres") * F.col("xsize"), F.col("ytop") + F.col("yres") * F.col("ysize")
    ring = geometry.densified(geometry.box_ring(F.least("xleft", xr), F.least("ytop", yb), F.greatest("xleft", xr), F.greatest("ytop", yb)), edge_points)
    polar = F.col("epsg").isin(3413, 3031)
    over_pole = polar & (F.least("xleft", xr) <= 0) & (F.greatest("xleft", xr) >= 0) & (F.least("ytop", yb) <= 0) & (F.greatest("ytop", yb) >= 0)
    # the outline of a polar raster may cross the date line, where its longitudes jump
    rows = rasters.withColumn("__ring", F.transform(ring, lambda p: geometry.unproject(p["x"], p["y"], F.col("epsg"))))
    lon, lat = F.transform("__ring", lambda p: p["x"]), F.transform("__ring", lambda p: p["y"])
    all_round = over_pole | (polar & (F.array_max(lon) - F.array_min(lon) > 180))
    west, east = F.when(all_round, -180.0).otherwise(F.array_min(lon)), F.when(all_round, 180.0).otherwise(F.array_max(lon))
    south = F.when(over_pole & (F.col("epsg") == 3031), -90.0).otherwise(F.array_min(lat))
    north = F.when(over_pole & (F.col("epsg") == 3413), 90.0).otherwise(F.array_max(lat))
    n_rows, n_columns = round(180 / step), round(360 / step)
    i0, i1 = F.greatest(F.lit(0), F.floor((90 - north) / step) - 1), F.least(F.lit(n_rows - 1), F.floor((90 - south) / step) + 1)
    j0 = F.floor((west + 180) / step) - 1
    j1 = F.least(F.floor((east + 180) / step) + 1, j0 + n_columns - 1)
    cells = rows.withColumn("i", F.explode(F.sequence(i0.cast("long"), i1.cast("long")))).withColumn("j", F.explode(F.sequence(j0.cast("long"), j1.cast("long"))))
    cells = cells.withColumn("j", F.pmod("j", F.lit(n_columns).cast("long"))).withColumns({"lon": cell_centre(F.col("j"), -180.0, step), "lat": cell_centre(F.col("i"), 90.0, -step)})
    at = geometry.with_projected(cells, "lon", "lat", "epsg", "__at")
    place = F.struct(((F.col("__at.y") - F.col("ytop")) / F.col("yres")).alias("y"), ((F.col("__at.x") - F.col("xleft")) / F.col("xres")).alias("x"))
    # as rows of a generator, so that the filter below is not pushed down with a copy of the formulas for each bound
    at = at.select("tile_id", "i", "j", "lon", "lat", "xsize", "ysize", F.inline(F.array(place)))
    return at.where("x >= 0 and x < xsize and y >= 0 and y < ysize").select("tile_id", "i", "j", "lon", "lat", "y", "x")


def resampled(cells: DataFrame, rasters: DataFrame, step: float, kind: str = "bilinear", value: str = "value") -> DataFrame:
    """GEO1 with G8 to G10: projected rasters on a geographic grid, driven by the target's cells.

    ``kind`` is nearest, bilinear or cubic. Each raster's part is a tile of the
    result; cells without any value nearby have no row.
    """
    targets = geographic_cells(rasters, step)
    points = targets.select(F.struct("tile_id", "i", "j").alias("id"), "tile_id", "y", "x")
    values = nearest_at(cells, points, value) if kind == "nearest" else interpolate(cells, points, kind, value)
    return values.where(F.col(value).isNotNull()).select("id.*", value)


def snapped_extent(cells: DataFrame, k: int, value: str = "value") -> DataFrame:
    """The extent of valid cells, moved outward to multiples of k."""
    ok = cells.where(F.col(value).isNotNull())
    return ok.groupBy("tile_id").agg(
        (F.floor(F.min("i") / k) * k).alias("i0"), (F.ceil((F.max("i") + 1) / k) * k).alias("i1"),
        (F.floor(F.min("j") / k) * k).alias("j0"), (F.ceil((F.max("j") + 1) / k) * k).alias("j1"),
    )


def downsampled(cells: DataFrame, k: int, land: DataFrame | None = None, how: str = "average", value: str = "value") -> DataFrame:
    """Coarser cells over the snapped extent of valid ones: block means or nearest values, of the given land cells alone.

    Rows and columns count from the extent's corner ``(i0, j0)``, which comes along.
    """
    ok = cells.where(F.col(value).isNotNull())
    coarse = {"average": average, "nearest": nearest}[how](ok, k, value).select("tile_id", "i", "j", value)
    if land is not None:
        coarse = coarse.join(land.select("tile_id", "i", "j"), ["tile_id", "i", "j"], "left_semi")
    corner = snapped_extent(ok, k, value).select("tile_id", "i0", "j0")
    moved = coarse.join(corner, "tile_id").withColumns({"i": F.col("i") - F.expr(f"i0 div {k}"), "j": F.col("j") - F.expr(f"j0 div {k}")})
    return moved.select("tile_id", "i0", "j0", "i", "j", value)


def mosaic(cells: DataFrame, offsets: DataFrame, value: str = "value") -> DataFrame:
    """Tiles pasted into one grid by whole-cell offsets; of overlapping cells the last listed wins."""
    moved = cells.join(offsets, "tile_id")
    return moved.groupBy((F.col("i") + F.col("di")).alias("i"), (F.col("j") + F.col("dj")).alias("j")).agg(
        F.max_by(value, F.struct("listed", "tile_id")).alias(value)
    )


def _neighbours(rows: DataFrame, offsets: Sequence[tuple]) -> DataFrame:
    """Each row once for every offset ``(di, dj, *weights)``."""
    names = ["di", "dj", *(f"w{k}" for k in range(len(offsets[0]) - 2))]
    each = F.array(*(F.struct(*(F.lit(v).alias(n) for n, v in zip(names, o, strict=True))) for o in offsets))
    return rows.select("*", F.inline(each)).withColumns({"i": F.col("i") + F.col("di"), "j": F.col("j") + F.col("dj")})


#: Horn's weights for the falls along x and y.
HORN = [(-1, -1, 1, 1), (-1, 0, 0, 2), (-1, 1, -1, 1), (0, -1, 2, 0), (0, 0, 0, 0), (0, 1, -2, 0), (1, -1, 1, -1), (1, 0, 0, -2), (1, 1, -1, -1)]


def slope(cells: DataFrame, xstep: float, ystep: float, scale: float = 111120.0, value: str = "value", edges: bool = False) -> DataFrame:
    """Slope in degrees over cells whose eight neighbours have values.

    With ``edges`` all cells with a value get one; a missing neighbour, at an edge
    or a hole, counts with the cell's own value. Every cell gives signed shares to
    its neighbours, which add them up.
    """
    spread = _neighbours(cells.where(F.col(value).isNotNull()), [(-di, -dj, wx, wy, int(di == dj == 0)) for di, dj, wx, wy in HORN])
    own = F.max(F.when(F.col("w2") == 1, F.col(value)))
    # all weights sum to zero, so what is missing has the negated sum of those that are there
    fall = lambda w: F.sum(F.col(w) * F.col(value)) - own * F.sum(w)
    sums = spread.groupBy("tile_id", "i", "j").agg(fall("w0").alias("gx"), fall("w1").alias("gy"), F.count("*").alias("n"), own.alias("own"))
    gx, gy = F.col("gx") / (8 * abs(xstep) * scale), F.col("gy") / (8 * abs(ystep) * scale)
    return sums.where("own is not null" if edges else "n = 9").select("tile_id", "i", "j", F.degrees(F.atan(F.sqrt(gx * gx + gy * gy))).alias("slope"))


_CROSS = [(-1, 0), (1, 0), (0, -1), (0, 1)]


def isolated(cells: DataFrame, least: int = 3) -> DataFrame:
    """Cells from which at most ``least`` cells are in reach, themselves included, over two steps to four neighbours.

    The first hop counts neighbours, the second adds what each neighbour has
    besides the cell itself. Up to three cells the count is exact.
    """
    keys = ["tile_id", "i", "j"]
    here = cells.select(*keys)
    hop = lambda rows, extra: _neighbours(rows, _CROSS).groupBy(*keys).agg(extra).join(here, keys, "right")
    first = hop(here, F.count("*").alias("n")).withColumn("n", F.coalesce("n", F.lit(0)))
    second = _neighbours(first.select(*keys, F.greatest(F.col("n") - 1, F.lit(0)).alias("c")), _CROSS).groupBy(*keys).agg(F.sum("c").alias("m"))
    both = first.join(second, keys, "left")
    return both.where(1 + F.col("n") + F.coalesce("m", F.lit(0)) <= least).select(*keys)


def fill(cells: DataFrame, holes: DataFrame, reach: int, value: str = "value") -> DataFrame:
    """Inverse-distance means for holes from valid cells at most ``reach`` cells away."""
    offsets = [(di, dj, float((di * di + dj * dj) ** -0.5)) for di in range(-reach, reach + 1) for dj in range(-reach, reach + 1) if 0 < di * di + dj * dj <= reach * reach]
    wanted = _neighbours(holes.select("tile_id", "i", "j", F.col("i").alias("hi"), F.col("j").alias("hj")), offsets)
    joined = wanted.join(cells.where(F.col(value).isNotNull()), ["tile_id", "i", "j"])
    return joined.groupBy("tile_id", F.col("hi").alias("i"), F.col("hj").alias("j")).agg((F.sum(F.col("w0") * F.col(value)) / F.sum("w0")).alias(value))


def nearest_valid(cells: DataFrame, holes: DataFrame, reach: float | None = None, value: str = "value") -> DataFrame:
    """G18 at any distance: for each hole the nearest valid cell of its tile, its distance in cells and its value.

    Two passes, one along columns and one along rows, whatever the distance: each
    hole's column carries the nearest valid cell above and below it, and in a row the
    least of (column distance)^2 + (row distance)^2 follows from the lower envelope of
    parabolas. Ties go to the value that is smaller. A group is a column or a row of a tile.
    ``reach`` leaves out what is farther away; a tile without a valid cell has no rows.
    """
    ok = cells.where(F.col(value).isNotNull()).select("tile_id", "i", "j", F.col(value).cast("double").alias("v"))
    spots = holes.select("tile_id", "i", "j").distinct()
    # the columns of a tile that hold any valid cell, in each row that has holes
    rows = spots.select("tile_id", "i").distinct().join(ok.select("tile_id", "j").distinct(), "tile_id")
    line = ok.select("tile_id", "i", "j", "v", F.lit(True).alias("valid")).unionByName(rows.select("tile_id", "i", "j", F.lit(None).cast("double").alias("v"), F.lit(False).alias("valid")))
    column = Window.partitionBy("tile_id", "j").orderBy("i")
    seen = F.when(F.col("valid"), F.struct("i", "v"))
    above = F.last(seen, True).over(column.rangeBetween(Window.unboundedPreceding, 0))
    below = F.first(seen, True).over(column.rangeBetween(0, Window.unboundedFollowing))
    near = line.withColumns({"a": above, "b": below}).where("not valid").select(
        "tile_id", "i", "j", F.array_min(F.filter(F.array(
            F.struct((F.col("i") - F.col("a.i")).alias("d"), F.col("a.v").alias("v")), F.struct((F.col("b.i") - F.col("i")).alias("d"), F.col("b.v").alias("v")),
        ), lambda s: s["d"].isNotNull())).alias("n"),
    )
    both = near.select("tile_id", "i", "j", F.col("n.d").cast("double").alias("d"), F.col("n.v").alias("v")).unionByName(
        spots.select("tile_id", "i", "j", F.lit(None).cast("double").alias("d"), F.lit(None).cast("double").alias("v"))
    )
    kinds = dict(both.dtypes)
    found = both.groupBy("tile_id", "i").applyInArrow(_row_distances, f"tile_id {kinds['tile_id']}, i {kinds['i']}, j {kinds['j']}, distance double, `value` double")
    found = found.withColumnRenamed("value", value)
    return found if reach is None else found.where(F.col("distance") <= reach)


def _row_distances(table: pa.Table) -> pa.Table:
    """One row of a tile: columns with the distance and value of their nearest valid cell, and holes, which have none."""
    j, d, v = (table.column(c).to_numpy(zero_copy_only=False) for c in ("j", "d", "v"))
    site = ~np.isnan(d)
    order = np.lexsort((v[site], j[site]))
    sj, sd, sv = (x[site][order].astype(float) for x in (j, d, v))
    # parabolas y = (x - sj)^2 + sd^2 in the order of their centres; ``from_x`` is where each begins to be the least
    hull, from_x = [], []
    for k in range(len(sj)):
        x = -np.inf
        while hull:
            h = hull[-1]
            x = ((sd[k] ** 2 + sj[k] ** 2) - (sd[h] ** 2 + sj[h] ** 2)) / (2 * (sj[k] - sj[h]))
            if x >= from_x[-1]:
                break
            hull.pop()
            from_x.pop()
            x = -np.inf
        hull.append(k)
        from_x.append(x)
    holes = np.flatnonzero(~site)
    if not hull or not len(holes):
        return pa.table({c: table.column(c).slice(0, 0) for c in ("tile_id", "i", "j")} | {"distance": pa.array([], pa.float64()), "value": pa.array([], pa.float64())})
    at = j[holes].astype(float)
    hull = np.array(hull)
    k = np.searchsorted(from_x, at, "right") - 1
    square = lambda p: (at - sj[p]) ** 2 + sd[p] ** 2
    best, least = hull[k], square(hull[k])
    # where parabolas meet distances are equal: of neighbours in the envelope the smaller value counts
    step, tied = 1, np.ones(len(at), bool)
    while tied.any():
        left = hull[np.maximum(k - step, 0)]
        tied &= (k >= step) & (square(left) == least)
        best = np.where(tied & (sv[left] < sv[best]), left, best)
        step += 1
    out = table.select(["tile_id", "i", "j"]).take(pa.array(holes))
    return out.append_column("distance", pa.array(np.sqrt(square(best)))).append_column("value", pa.array(sv[best]))


def cut_and_fill(cells: DataFrame, inside: Column, reach: int, smooth: int = 0, value: str = "value", how: str = "mean") -> DataFrame:
    """Cells for which ``inside`` holds are cut out and filled from the others; ``smooth`` rounds of 3 by 3 means over what was filled.

    ``how`` is mean, the inverse-distance mean of all valid cells within reach, whose work grows with
    the square of the reach, or nearest, the value of the nearest one, whose work does not.
    Cells that nothing within reach can fill have no row.
    """
    keys = ["tile_id", "i", "j"]
    ok = cells.where(F.col(value).isNotNull())
    cut = F.coalesce(inside, F.lit(False))
    kept, holes = ok.where(~cut).select(*keys, value), cells.where(cut).select(*keys)
    if how not in ("mean", "nearest"):
        raise ValueError(f"no way to fill called {how}")
    filled = fill(kept, holes, reach, value) if how == "mean" else nearest_valid(kept, holes, reach, value).select(*keys, value)
    block = [(di, dj) for di in (-1, 0, 1) for dj in (-1, 0, 1)]
    for _ in range(smooth):
        spread = _neighbours(kept.unionByName(filled), block).groupBy(*keys).agg(F.avg(value).alias("mean"))
        filled = filled.join(spread, keys).select(*keys, F.col("mean").alias(value))
    return kept.unionByName(filled)


def shifted(cells: DataFrame, offsets: DataFrame, sign: int = 1, value: str = "value") -> DataFrame:
    """Values plus (or minus) an offset grid on the same cells."""
    return cells.join(offsets, ["tile_id", "i", "j"]).withColumn(value, F.col(value) + sign * F.col("offset")).drop("offset")


#: The height column of each vertical datum.
HEIGHTS = {"ellipsoid": "h_ellipsoid", "wgs84": "h_ellipsoid", "geoid": "h_geoid", "egm2008": "h_geoid", "meantide": "h_meantide"}


def height(datum: str) -> Column:
    """The height column of a datum, chosen while the plan is built."""
    if datum.lower() not in HEIGHTS:
        raise ValueError(f"unknown vertical datum: {datum}")
    return F.col(HEIGHTS[datum.lower()])


def wrapped(x: Column) -> Column:
    """A longitude brought back into -180..180."""
    return F.when(x < -180, x + 360).when(x > 180, x - 360).otherwise(x)


def land_mask(base: DataFrame, lakes: DataFrame | None = None, buildings: DataFrame | None = None, urban: DataFrame | None = None, extra: DataFrame | None = None) -> DataFrame:
    """MASK1: base and extra land without the layers that are given."""
    keys = ["tile_id", "i", "j"]
    land = base.select(*keys)
    if extra is not None:
        land = land.unionByName(extra.select(*keys)).distinct()
    for layer in (lakes, buildings, urban):
        if layer is not None:
            land = land.join(layer.select(*keys), keys, "left_anti")
    return land


def has_land(cells: DataFrame, mask: str = "land") -> DataFrame:
    """MASK2: per tile, whether any cell is land."""
    return cells.groupBy("tile_id").agg((F.max(mask) > 0).alias("has_land"))
