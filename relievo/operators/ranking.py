"""Supersede, weights, versions and along-track rules (W1-W11); set operations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def supersede(cells: DataFrame, keys: Sequence[str] = ("i", "j"), value: str = "elev", ties: Sequence[str] = ("filename", "elev")) -> DataFrame:
    """Per cell the value of the greatest weight, which it keeps; ties go by the later file name, then value.

    An aggregate, so workers combine their own winners before the one shuffle.
    """
    return cells.groupBy(*keys).agg(F.max_by(F.struct(F.col(value).alias(value), "weight", "filename"), F.struct("weight", *ties)).alias("w")).select(*keys, f"w.{value}", "w.weight", "w.filename")


#: What a chart's size letter adds to its weight.
SIZE_WEIGHTS = {"C": 0.03, "F": 0.04, "H": 0.05, "J": 0.06}


def size_weight(name: Column) -> Column:
    """The base weight's fraction for a size letter in a name like ``US4C``."""
    letter = F.regexp_extract(name, r"^US\d([CFHJ])", 1)
    out = None
    for k, v in SIZE_WEIGHTS.items():
        out = F.when(letter == k, v) if out is None else out.when(letter == k, v)
    return out.otherwise(0.0)


def resolution_weight(name: Column) -> Column:
    """0.13 for third-second files, 0.1 for one-second files."""
    return F.when(name.rlike(r"^ncei13_"), 0.13).when(name.rlike(r"^ncei1_"), 0.1).otherwise(0.0)


def year_weight(name: Column, first: int = 1990, last: int = 2030) -> Column:
    """The release year over 10000; 1990 when a name has none in range."""
    year = F.regexp_extract(name, r"_(\d{4})v\d", 1).try_cast("int")
    return F.when(year.between(first, last), year).otherwise(first) / 10000.0


def source_id(weight: Column) -> Column:
    """The whole part of a weight."""
    return F.floor(weight)


def latest(rows: DataFrame, key: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key by the order."""
    rank = F.row_number().over(Window.partitionBy(*key).orderBy(*order))
    return rows.withColumn("__rank", rank).where("__rank = 1").drop("__rank")


def hash_top(rows: DataFrame, key: Sequence[str], ids: Sequence[str], n: int, seed: int = 11) -> DataFrame:
    """N rows of each key in a repeatable shuffled order (a sampling operator)."""
    rank = F.row_number().over(Window.partitionBy(*key).orderBy(F.xxhash64(F.lit(seed), *ids), *ids))
    return rows.withColumn("__rank", rank).where(F.col("__rank") <= n).drop("__rank")


def by_latitude(rows: DataFrame, y: str = "y", x: str = "x") -> DataFrame:
    """From the equator outward, then by longitude."""
    return rows.orderBy(F.abs(F.col(y)), F.col(y).desc(), x)


def surface_rule(
    photons: DataFrame, slope: float, intercept: float, group: Sequence[str] = ("granule_id1", "beam"), dist: str = "dist_x", height: str = "h_geoid",
    code: str = "class_code", half: float = 0.5, step: float = 0.05, canopy_limit: int = 1, ground_limit: int = 3,
) -> DataFrame:
    """Sea-surface photons along a track.

    A line with a band of half a metre models the surface. Canopy inside the band
    becomes surface (4), outside noise (0). In 50 m steps with at most one surface
    photon, ground over the band's lower edge becomes surface; where then at most
    three ground photons are left, all ground does.
    """
    track = Window.partitionBy(*group)
    km = (F.col(dist) - F.min(dist).over(track)) / 1000.0
    rows = photons.withColumn("km", km).withColumns({"step": F.floor(F.col("km") / step), "line": F.col("km") * slope + intercept})
    h, c = F.col(height), F.col(code)
    inside = F.abs(h - F.col("line")) <= half
    rows = rows.withColumn("c1", F.when(c.isin(2, 3), F.when(inside, 4).otherwise(0)).otherwise(c))
    at = Window.partitionBy(*group, "step")
    rows = rows.withColumn("surface", F.count_if(F.col("c1") == 4).over(at))
    few = F.col("surface") <= canopy_limit
    rows = rows.withColumn("c2", F.when(few & (F.col("c1") == 1) & (h > F.col("line") - half), 4).otherwise(F.col("c1")))
    rows = rows.withColumn("ground", F.count_if(F.col("c2") == 1).over(at))
    last = F.when(few & (F.col("ground") <= ground_limit) & (F.col("c2") == 1), 4).otherwise(F.col("c2"))
    return rows.withColumn(code, last).drop("c1", "c2", "surface", "ground", "line")


def reclassify(photons: DataFrame, rules: DataFrame, ids: Sequence[str], dist: str = "km", height: str = "h_geoid", code: str = "class_code") -> DataFrame:
    """The class of the last rule whose interval and band hold a photon.

    ``rules``: rule_no, d0, d1, slope, intercept, below, above, new_class; a table
    that analysts write by hand. Rules spread over whole units of distance and
    photons meet those of their unit.
    """
    spread = rules.withColumn("unit", F.explode(F.sequence(F.floor("d0"), F.floor("d1"))))
    line = F.col("slope") * F.col(dist) + F.col("intercept")
    band = F.col(dist).between(F.col("d0"), F.col("d1")) & F.col(height).between(line - F.col("below"), line + F.col("above"))
    hits = photons.withColumn("unit", F.floor(dist)).join(spread, "unit").where(band)
    winners = hits.groupBy(*ids).agg(F.max_by("new_class", "rule_no").alias("__new"))
    return photons.join(winners, list(ids), "left").withColumn(code, F.coalesce("__new", code)).drop("__new")


def rebased(photons: DataFrame, group: Sequence[str], dist: str = "dist_x") -> DataFrame:
    """The distance along a track from its start in kilometres."""
    return photons.withColumn("km", (F.col(dist) - F.min(dist).over(Window.partitionBy(*group))) / 1000.0)


def append_new(old: DataFrame, new: DataFrame, origin: str) -> DataFrame:
    """U4: old rows and the new rows whose origin is not there yet."""
    return old.unionByName(new.join(old.select(origin), origin, "left_anti").select(*old.columns))


def first_seen(rows: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """Of rows with one key the first by the order."""
    return latest(rows, [key], [F.col(c) for c in order])
