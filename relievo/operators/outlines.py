"""Polygons over grids: outlines of sets of boxes (GEO8), rasterised polygons (F19, GEO5, GEO7)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from relievo.operators.grid import cell_centre
from relievo.plans.storage import delete, materialize, new_folder, scratch

#: Steps of an edge in grid units, anticlockwise around a cell: east, north, west, south.
_STEPS = ((1, 0), (0, 1), (-1, 0), (0, -1))


def outline_edges(boxes: DataFrame, unit: float = 1.0) -> DataFrame:
    """The border of a union of boxes as straight edges ``(x0, y0, x1, y1, dir)`` with the inside on the left.

    Boxes have sides on multiples of ``unit``; they may overlap, touch or repeat.
    They become distinct unit cells; an edge that two cells share vanishes, and
    what is left of a line is joined to straight edges between corners. Coordinates
    are in units.
    """
    whole = lambda c: F.round(F.col(c) / unit).cast("long")
    cells = boxes.select(*(whole(c).alias(c) for c in ("xmin", "ymin", "xmax", "ymax"))).where("xmin < xmax and ymin < ymax").distinct()
    cells = cells.withColumn("x", F.explode(F.expr("sequence(xmin, xmax - 1)"))).withColumn("y", F.explode(F.expr("sequence(ymin, ymax - 1)"))).select("x", "y").distinct()
    # an edge of a cell by its line, its place on the line and its direction: bottom, right, top, left
    sides = [("h", "y", "x", 0, 0), ("v", "x", "y", 1, 1), ("h", "y", "x", 1, 2), ("v", "x", "y", 0, 3)]
    each = F.array(*(F.struct(F.lit(a).alias("axis"), (F.col(line) + plus).alias("line"), F.col(at).alias("at"), F.lit(d).alias("dir")) for a, line, at, plus, d in sides))
    edges = cells.select(F.inline(each)).groupBy("axis", "line", "at").agg(F.count("*").alias("n"), F.min("dir").alias("dir")).where("n = 1")
    along = Window.partitionBy("axis", "line").orderBy("at")
    breaks = F.coalesce(((F.col("at") - F.lag("at").over(along)) != 1) | (F.lag("dir").over(along) != F.col("dir")), F.lit(True))
    runs = edges.withColumn("run", F.sum(breaks.cast("int")).over(along)).groupBy("axis", "line", "run", "dir").agg(F.min("at").alias("a"), (F.max("at") + 1).alias("b"))
    forward = F.col("dir") < 2
    start, stop = F.when(forward, F.col("a")).otherwise(F.col("b")), F.when(forward, F.col("b")).otherwise(F.col("a"))
    flat = F.col("axis") == "h"
    return runs.select(
        F.when(flat, start).otherwise(F.col("line")).alias("x0"), F.when(flat, F.col("line")).otherwise(start).alias("y0"),
        F.when(flat, stop).otherwise(F.col("line")).alias("x1"), F.when(flat, F.col("line")).otherwise(stop).alias("y1"), "dir",
    )


def outline_rings(boxes: DataFrame, unit: float = 1.0, max_rounds: int = 40) -> DataFrame:
    """GEO8: the rings ``(x, y, n_points, area, is_hole, ring)`` of the union of boxes.

    Each corner's edge is followed by the one that starts where it ends; where four
    edges meet at a point the one to the left, so parts that touch there stay rings of
    their own. Rings are closed by pointer doubling: in a round every edge learns of
    twice as many successors, so a ring of n edges takes log2(n) rounds of one join each. A second such
    series counts each edge's steps to the end of its ring, which orders the points.
    ``x, y`` is where a ring's least edge begins; outer rings run anticlockwise and have a
    positive area, holes clockwise and a negative one; areas add up to the union's. A
    ring is one row; no boxes give no rows.
    """
    spark = boxes.sparkSession
    with scratch(spark, "outline") as keep:
        key = F.struct("x0", "y0", "dir")
        edges = keep(outline_edges(boxes, unit).withColumn("id", key), "edges")
        follows = edges.select(F.col("x0").alias("x1"), F.col("y0").alias("y1"), F.col("dir").alias("to"), F.col("id").alias("next_id"))
        turn = F.pmod(F.col("to") - F.col("dir") + 2, F.lit(4))  # left is 3, straight on cannot be, right is 1
        links = edges.join(follows, ["x1", "y1"]).groupBy("id").agg(F.max_by("next_id", turn).alias("next"))
        state, folder = keep(links.select("id", "next", F.least("id", "next").alias("least")), "links"), None
        for _ in range(max_rounds):
            ahead = state.select(F.col("id").alias("next"), F.col("next").alias("after"), F.col("least").alias("there"))
            moved = state.join(ahead, "next").select("id", F.col("after").alias("next"), F.least("least", "there").alias("new"), "least")
            last, folder = folder, new_folder(spark, "outline-round")
            done = materialize(moved, "least", folder)
            if last:
                delete(spark, last)
            state = done.select("id", "next", F.col("new").alias("least"))
            if done.where("new <> least").isEmpty():
                break
        else:
            raise RuntimeError(f"rings did not close in {max_rounds} rounds")
        leaders = keep(state.select("id", "least"), "leaders")
        delete(spark, folder)
        # steps to the edge before the least one, where the ring is cut open
        rank = links.join(leaders, "id").select("id", "least", F.when(F.col("next") != F.col("least"), F.col("next")).alias("next"))
        rank = keep(rank.withColumn("steps", F.when(F.col("next").isNull(), 0).otherwise(1).cast("long")), "cut")
        folder = None
        for _ in range(max_rounds):
            if rank.where("next is not null").isEmpty():
                break
            ahead = rank.select(F.col("id").alias("next"), F.col("next").alias("after"), F.col("steps").alias("more"))
            moved = rank.join(ahead, "next", "left").select("id", "least", F.col("after").alias("next"), (F.col("steps") + F.coalesce("more", F.lit(0))).alias("steps"))
            last, folder = folder, new_folder(spark, "outline-round")
            rank = materialize(moved, "steps", folder)
            if last:
                delete(spark, last)
        else:
            raise RuntimeError(f"rings were not ordered in {max_rounds} rounds")
        point = F.struct((F.col("id.x0") * unit).cast("double").alias("x"), (F.col("id.y0") * unit).cast("double").alias("y"))
        rings = rank.groupBy("least").agg(F.array_sort(F.collect_list(F.struct((-F.col("steps")).alias("s"), point.alias("p")))).alias("all"))
        rings = rings.withColumn("ring", F.concat(F.col("all.p"), F.slice("all.p", 1, 1)))
        from relievo.functions.geometry import signed_area

        out = rings.select(
            (F.col("least.x0") * unit).cast("double").alias("x"), (F.col("least.y0") * unit).cast("double").alias("y"), (F.size("ring") - 1).cast("long").alias("n_points"),
            signed_area(F.col("ring")).alias("area"), (signed_area(F.col("ring")) < 0).alias("is_hole"), "ring",
        )
        out = materialize(out, "outline")
        if folder:
            delete(spark, folder)
        return out


def crossings(rings: DataFrame, ystart: float, ystep: float, ring: str = "ring", keys: Sequence[str] = ("ring_id",)) -> DataFrame:
    """Where the edges of rings cross the centre lines of raster rows: ``(*keys, i, at)``.

    A row counts for an edge as in GEO5: with its centre at or above the lower end and
    below the upper one. An edge goes to the rows that it crosses and to no others.
    """
    ends = F.arrays_zip(F.slice(ring, 1, F.size(ring) - 1).alias("a"), F.slice(ring, 2, F.size(ring) - 1).alias("b"))
    edges = rings.where(F.size(ring) > 1).select(*keys, F.inline(ends)).where("a.y <> b.y")
    place = lambda c: (F.col(c) - ystart) / ystep - 0.5
    low, high = F.floor(F.least(place("a.y"), place("b.y"))), F.ceil(F.greatest(place("a.y"), place("b.y")))
    rows = edges.withColumn("i", F.explode(F.sequence(low, high)))
    y = cell_centre(F.col("i"), ystart, ystep)
    a, b = F.col("a"), F.col("b")
    rows = rows.where((a["y"] <= y) != (b["y"] <= y))
    return rows.select(*keys, "i", (a["x"] + (y - a["y"]) * (b["x"] - a["x"]) / (b["y"] - a["y"])).alias("at"))


def inside_rings(
    cells: DataFrame, rings: DataFrame, x: Column, ystart: float, ystep: float, ring: str = "ring", ring_id: Sequence[str] = ("ring_id",), by: Sequence[str] = ()
) -> DataFrame:
    """F19, GEO5, GEO7 by scan lines: ``cells`` with ``inside``, whether a polygon holds the cell's centre.

    ``x`` is the centre's place, its row ``i`` counts along ``ystart + (i + 0.5) * ystep``. ``ring_id``
    names a polygon: its rings, holes among them, count together by the even-odd rule.
    ``by`` are columns, such as the tile, that a polygon and its cells share. The crossings of a polygon with a
    row are paired to spans by their order; then ends of spans and cells are sorted
    together and a running sum says how many spans are open. So the work is in proportion to cells and
    crossings, whatever the number of vertices of a polygon, and a group is one raster
    row. Equal to :func:`relievo.functions.geometry.contains` of each polygon, on every cell.
    """
    keys = [*dict.fromkeys([*by, *ring_id])]
    order = Window.partitionBy(*keys, "i").orderBy("at")
    ends = crossings(rings, ystart, ystep, ring, keys).withColumn("open", F.when(F.row_number().over(order) % 2 == 1, 1).otherwise(-1))
    marks = ends.select(*by, "i", F.col("at").alias("__x"), "open")
    here = cells.withColumns({"__x": x.cast("double"), "__cell": F.struct("*")}).select(*by, F.col("i").cast("long").alias("i"), "__x", "__cell")
    both = here.withColumn("open", F.lit(0)).unionByName(marks.withColumn("__cell", F.lit(None).cast(here.schema["__cell"].dataType)))
    # ends of spans at a cell's own place come before it; at one place the order among ends does not matter
    row = Window.partitionBy(*by, "i").orderBy("__x").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    counted = both.withColumn("inside", F.sum("open").over(row) > 0).where("__cell is not null")
    return counted.select("__cell.*", "inside")
