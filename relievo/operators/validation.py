"""Statistics of photons against grids, and of their errors."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from relievo.plans.percentiles import percentiles
from relievo.plans.storage import materialize, scratch

KEYS = ("tile_id", "i", "j")
GROUND, CANOPY = 1, 2


def capped(photons: DataFrame, limit: int, order: Sequence[str], keys: Sequence[str] = KEYS, seed: int = 7) -> DataFrame:
    """A3: at most ``limit`` photons of each cell, by a hash order that repeats (a sampling operator)."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(F.xxhash64(F.lit(seed), *order), *order))
    return photons.withColumn("__rank", rank).where(F.col("__rank") <= limit).drop("__rank")


def coverage(photons: DataFrame, parts: int = 15, keys: Sequence[str] = KEYS) -> DataFrame:
    """A2: the share of a cell's sub-cells that hold a photon; ``fy`` and ``fx`` are fractional cell positions."""
    sub = lambda c: F.floor((F.col(c) - F.floor(c)) * parts)
    return photons.groupBy(*keys).agg((F.count_distinct(sub("fy") * parts + sub("fx")) / float(parts * parts)).alias("coverage"))


def _percentile(value: Column | str, shares: Column | float, accuracy: int | None) -> Column:
    """The exact percentile, which gathers all distinct values of a group, or one of fixed size that is off by at most ``1 / accuracy`` in rank."""
    return F.percentile(value, shares) if accuracy is None else F.percentile_approx(value, shares, accuracy)


def cell_statistics(
    photons: DataFrame, cells: DataFrame, height: str = "h_geoid", code: str = "class_code", keys: Sequence[str] = KEYS, value: str = "value", accuracy: int | None = None,
    dense: bool = False,
) -> DataFrame:
    """A1: per-cell photon statistics.

    Canopy share over all classes from 1; of ground photons (3 at least) the range
    and the 10th and 90th percentiles; of those between these, ends included, the
    count, mean, median and sample deviation, and the cell's value minus mean and
    median. Both passes share one exchange on the cell, so one task holds a whole
    cell: :func:`capped` bounds it, or ``accuracy`` makes the percentiles
    approximate, of a fixed size.
    """
    keys = list(keys)
    rows = photons.where(F.col(code) >= 1).select(*keys, F.col(height).alias("h"), F.col(code).alias("c")).repartition(*keys)
    ground = F.when(F.col("c") == GROUND, F.col("h"))
    first = rows.groupBy(*keys).agg(
        F.count("*").alias("n_all"), F.avg((F.col("c") >= CANOPY).cast("double")).alias("canopy"), F.count(ground).alias("n_ground"),
        F.min(ground).alias("low"), F.max(ground).alias("high"), _percentile(ground, F.array(F.lit(0.1), F.lit(0.9)), accuracy).alias("p"),
    )
    first = first.where("n_ground >= 3").select(*keys, "n_all", "canopy", "n_ground", (F.col("high") - F.col("low")).alias("span"), F.get("p", 0).alias("p10"), F.get("p", 1).alias("p90"))
    inner = rows.where(F.col("c") == GROUND).join(first, keys).where("h between p10 and p90")
    second = inner.groupBy(*keys).agg(
        *(F.first(c).alias(c) for c in ("n_all", "canopy", "n_ground", "span", "p10", "p90")),
        F.count("*").alias("n_trim"), F.avg("h").alias("mean"), (F.median("h") if accuracy is None else F.percentile_approx("h", 0.5, accuracy)).alias("median"), F.stddev_samp("h").alias("std"),
    )
    return _with_differences(second.join(cells.select(*keys, value), keys), value)


def _with_differences(out: DataFrame, value: str) -> DataFrame:
    return out.withColumns({"decile_range": F.col("p90") - F.col("p10"), "diff_mean": F.col(value) - F.col("mean"), "diff_median": F.col(value) - F.col("median")})


def _dense_cell_statistics(photons: DataFrame, cells: DataFrame, height: str, code: str, keys: list[str], value: str) -> DataFrame:
    """:func:`cell_statistics` from sums that each task makes for itself, and selected percentiles; keys are not null."""
    rows = photons.where(F.col(code) >= 1).select(*keys, F.col(height).alias("h"), F.col(code).alias("c"))
    ground = F.when(F.col("c") == GROUND, F.col("h"))
    first = rows.groupBy(*keys).agg(
        F.count("*").alias("n_all"), F.avg((F.col("c") >= CANOPY).cast("double")).alias("canopy"), F.count(ground).alias("n_ground"), (F.max(ground) - F.min(ground)).alias("span"),
    ).where("n_ground >= 3")
    ground_rows = rows.where(F.col("c") == GROUND)
    deciles = percentiles(ground_rows, "h", (0.1, 0.9), keys).select(*keys, F.get("percentiles", 0).alias("p10"), F.get("percentiles", 1).alias("p90"))
    inner = ground_rows.join(deciles, keys).where("h between p10 and p90").select(*keys, "h")
    medians = percentiles(inner, "h", (0.5,), keys).select(*keys, F.get("percentiles", 0).alias("median"))
    sums = inner.groupBy(*keys).agg(F.count("*").alias("n_trim"), F.avg("h").alias("mean"), F.stddev_samp("h").alias("std"))
    out = first.join(deciles, keys).join(sums, keys).join(medians, keys).join(cells.select(*keys, value), keys)
    order = [*keys, "n_all", "canopy", "n_ground", "span", "p10", "p90", "n_trim", "mean", "median", "std", value]
    return _with_differences(out.select(order), value)


PERCENTS = (0, 1, 10, 20, 30, 40, 50, 60, 70, 80, 90, 99, 100)


def _beside(sums: DataFrame, shares: DataFrame, by: Sequence[str]) -> DataFrame:
    """One row of sums for each group with its percentiles, null where there are none."""
    key = F.struct(F.lit(0).alias("_"), *by).alias("__g")  # equal for equal groups, null ones too
    return sums.select("*", key).join(shares.select(key, "percentiles"), "__g", "left").drop("__g")


def summary(results: DataFrame, by: Sequence[str] = (), accuracy: int | None = None) -> DataFrame:
    """A4: the summary of cell errors: counts, bias, RMSE, percentiles, canopy and roughness.

    Exact percentiles are selected bin by bin, so no task gathers a group; with
    ``accuracy`` they have a fixed size and are off by at most ``1 / accuracy`` in rank.
    """
    d = F.col("diff_mean")
    order = [*by, "n_cells", "n_photons", "mean_photons", "dem_minus_photon", "rmse", "percentiles", "mean_canopy", "wooded", "wooded_canopy", "roughness"]
    sums = [
        F.count("*").alias("n_cells"), F.sum("n_trim").alias("n_photons"), F.avg("n_trim").alias("mean_photons"), F.avg(d).alias("dem_minus_photon"), F.sqrt(F.avg(d * d)).alias("rmse"),
        F.avg("canopy").alias("mean_canopy"), F.avg((F.col("canopy") > 0).cast("double")).alias("wooded"),
        F.avg(F.when(F.col("canopy") > 0, F.col("canopy"))).alias("wooded_canopy"), F.avg("std").alias("roughness"),
    ]
    shares = [p / 100 for p in PERCENTS]
    if accuracy is not None:
        return results.groupBy(*by).agg(*sums, _percentile(d, F.array(*map(F.lit, shares)), accuracy).alias("percentiles")).select(order)
    with scratch(results.sparkSession, "summary") as keep:
        rows = keep(results.select(*by, "n_trim", "diff_mean", "canopy", "std"), "errors")  # read twice
        return materialize(_beside(rows.groupBy(*by).agg(*sums), percentiles(rows, d, shares, by), by).select(order), "summary-rows")


def error_sketches(results: DataFrame, by: Sequence[str] = ("tile_id",), value: str = "diff_mean", k: int = 400) -> DataFrame:
    """A4 by parts: a quantile sketch of each group's errors, of a fixed size, to be stored and rolled up later.

    A group of at most ``k`` errors is held exactly; beyond, ranks are off by about ``1.7 / k``.
    """
    return results.where(F.col(value).isNotNull()).groupBy(*by).agg(F.count("*").alias("n"), F.kll_sketch_agg_double(value, k).alias("sketch"))


def sketched_percentiles(sketches: DataFrame, by: Sequence[str] = (), percents: Sequence[int] = PERCENTS) -> DataFrame:
    """A4 rolled up: percentiles of all groups' errors together, or of coarser groups, from stored sketches alone."""
    merged = sketches.groupBy(*by).agg(F.sum("n").alias("n"), F.kll_merge_agg_double("sketch").alias("__all"))
    ranks = F.array(*(F.kll_sketch_get_quantile_double("__all", F.lit(p / 100)) for p in percents))
    return merged.select(*by, "n", ranks.alias("percentiles"))


def long_percentiles(summed: DataFrame) -> DataFrame:
    """A4's percentiles as rows."""
    each = F.arrays_zip(F.array(*map(F.lit, PERCENTS)).alias("percent"), F.col("percentiles").alias("error"))
    return summed.select(F.inline(each))


def tile_errors(results: DataFrame, top: float | None = None, level: float | None = None, tile: str = "tile_id") -> DataFrame:
    """A5: bias, deviation and RMSE of each tile's best covered cells: the top share of the tile, or from a level on."""
    rows = results
    if top is not None:
        cut = results.groupBy(tile).agg(F.percentile("coverage", 1 - top).alias("cutoff"))
        rows = results.join(cut, tile).where("coverage >= cutoff")
    else:
        rows = results.withColumn("cutoff", F.lit(float(level or 0))).where("coverage >= cutoff")
    d = F.col("diff_mean")
    return rows.groupBy(tile).agg(
        F.count("*").alias("n_cells"), F.avg(d).alias("bias"), F.coalesce(F.stddev_samp(d), F.lit(0.0)).alias("std"), F.sqrt(F.avg(d * d)).alias("rmse"), F.first("cutoff").alias("cutoff")
    )


def by_coverage(results: DataFrame) -> DataFrame:
    """RMSE and count for each coverage in tenths of a per cent."""
    d = F.col("diff_mean")
    return results.groupBy((F.floor(F.col("coverage") * 1000 + 0.5) / 10).alias("coverage_pct")).agg(F.count("*").alias("n"), F.sqrt(F.avg(d * d)).alias("rmse"))


def by_category(photons: DataFrame, categories: Sequence[str], error: str = "error") -> DataFrame:
    """Error count, mean and population deviation overall and for each category, in one pass."""
    rows = photons.groupingSets([[], *([F.col(c)] for c in categories)], *categories)
    return rows.agg(F.count("*").alias("n"), F.avg(error).alias("mean"), F.stddev_pop(error).alias("std"))


def clipped(rows: DataFrame, value: str, low: float, high: float, accuracy: int | None = None) -> DataFrame:
    """Rows between two global percentiles; the limits are one row, exact ones by selection (see :func:`summary`)."""
    if accuracy is None:
        p = percentiles(rows, value, (low, high)).withColumnRenamed("percentiles", "p")
    else:
        p = rows.agg(_percentile(value, F.array(F.lit(low), F.lit(high)), accuracy).alias("p"))
    return rows.crossJoin(F.broadcast(p)).where(F.col(value).between(F.get("p", 0), F.get("p", 1))).drop("p")


def granule_errors(rows: DataFrame, low: float = 0.0005, high: float = 0.9995, value: str = "error", accuracy: int | None = None) -> DataFrame:
    """Clipped error statistics of each granule."""
    return clipped(rows, value, low, high, accuracy).groupBy("granule_id1", "granule_id2").agg(F.count("*").alias("n"), F.avg(value).alias("mean"), F.stddev_samp(value).alias("std"))


def outlier_granules(stats: DataFrame, keys: Sequence[str], groups: Sequence[str] = (), least: int = 20, width: float = 2.0) -> DataFrame:
    """Granules whose band mean +- 2 deviations is apart from at least three others and from all but one.

    Bands are intervals, so the number of disjoint bands follows from ranks: those
    that end before ours begins, and those that begin after ours ends. Two sorted
    windows replace all pairs.
    """
    rows = stats.where(F.col("n") >= least).withColumns({"lo": F.col("mean") - width * F.col("std"), "hi": F.col("mean") + width * F.col("std")})
    ends = lambda at, kind: rows.select(*groups, *keys, F.col(at).alias("at"), F.lit(kind).alias("kind"))
    # at one value: our own start comes before others' ends, and others' starts before our end
    events = ends("lo", 0).unionByName(ends("hi", 1))
    order = Window.partitionBy(*groups).orderBy("at", "kind")
    before = order.rangeBetween(Window.unboundedPreceding, Window.currentRow)
    counted = events.withColumns({
        "ended": F.sum(F.col("kind")).over(before), "begun": F.sum(1 - F.col("kind")).over(before), "all": F.count("*").over(Window.partitionBy(*groups)) / 2,
    })
    apart = counted.groupBy(*groups, *keys).agg(
        F.sum(F.when(F.col("kind") == 0, F.col("ended")).otherwise(F.col("all") - F.col("begun"))).cast("bigint").alias("n_apart"), F.max(F.col("all") - 1).cast("bigint").alias("n_compared")
    )
    return apart.where("n_apart >= 3 and n_apart >= n_compared - 1")


def reject_list(rows: DataFrame, granule: str = "granule", least_files: int = 2, least_photons: int = 1000) -> DataFrame:
    """A10: granules listed for enough files with enough photons in all."""
    return rows.groupBy(granule).agg(F.count("*").alias("n_files"), F.sum("photon_count").alias("n_photons")).where((F.col("n_files") >= least_files) & (F.col("n_photons") >= least_photons))


def tile_counts(photons: DataFrame, tile: str = "tile_id", code: str = "class_code") -> DataFrame:
    """Photons of each tile: all, canopy and ground."""
    c = F.col(code)
    return photons.groupBy(tile).agg(F.count("*").alias("numphotons"), F.count_if(c.between(2, 3)).alias("numphotons_canopy"), F.count_if(c == 1).alias("numphotons_ground"))


def flag_summary(rows: DataFrame, flags: Mapping[str, Column]) -> DataFrame:
    """How many rows each flag holds for, and the share in per cent."""
    summed = rows.agg(F.count("*").alias("n"), *(F.count_if(c).alias(k) for k, c in flags.items()))
    each = F.array(*(F.struct(F.lit(k).alias("flag"), F.col(k).alias("n_true"), F.col("n").alias("n_all")) for k in flags))
    return summed.select(F.inline(each)).withColumn("percent", F.try_divide(100.0 * F.col("n_true"), F.col("n_all")))


#: The least threshold, step and number of thresholds in metres and in feet, and feet in a metre.
METRES, FEET, FEET_IN_METRE = (-11000.0, 100.0, 200), (-36000.0, 200.0, 327), 3.2808399
#: Fixed value: land below it is an error of the mask at a shore.
LEAST_LAND = -420.0


def hypsometry(
    cells: DataFrame, low: float, step: float, steps: int, weight: Column | None = None, value: str = "value", land: Column | None = None, scale: float = 1.0
) -> DataFrame:
    """For each threshold the cells at or above it, of all and of land.

    Land is what the mask ``land`` says (everything without one) from LEAST_LAND
    on. Thresholds are ``low + k * step`` in a unit of which ``scale`` make one of
    the values' units. A histogram by step, combined map-side, and a reverse
    running sum over its rows.
    """
    w = F.lit(1).cast("bigint") if weight is None else weight
    v = F.col(value)
    is_land = (v >= LEAST_LAND) & (F.lit(True) if land is None else F.coalesce(land.cast("boolean"), F.lit(False)))
    at = F.floor((v * scale - low) / step)
    threshold = lambda k: (k * step + low) / scale
    # a value on a threshold counts from that threshold on, whatever the division made of it
    at = F.when(v < threshold(at), at - 1).when(v >= threshold(at + 1), at + 1).otherwise(at)
    at = F.greatest(F.lit(-1), F.least(F.lit(steps - 1), at)).cast("int")
    bars = cells.where(v.isNotNull()).groupBy(at.alias("k")).agg(F.sum(w).alias("all"), F.sum(F.when(is_land, w).otherwise(F.lit(0))).alias("land"))
    frame = cells.sparkSession.range(steps).select(F.col("id").cast("int").alias("k")).join(bars, "k", "left")  # the thresholds alone
    above = Window.orderBy(F.col("k").desc()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sums = bars.agg(F.sum("all").alias("total"), F.sum("land").alias("total_land"))
    out = frame.select("k", *(F.sum(F.coalesce(c, F.lit(0))).over(above).alias(f"{c}_above") for c in ("all", "land"))).crossJoin(F.broadcast(sums))
    return out.select(
        (F.col("k") * step + low).alias("threshold"), "all_above", "land_above", F.try_divide(100.0 * F.col("all_above"), "total").alias("pct_all"),
        F.coalesce(F.try_divide(100.0 * F.col("land_above"), "total_land"), F.lit(0.0)).alias("pct_land"),
    )


def hypsometry_table(cells: DataFrame, land: Column, weight: Column | None = None, value: str = "value") -> DataFrame:
    """The hypsometry at the fixed thresholds in metres and in feet, with a column ``unit``."""
    metres = hypsometry(cells, *METRES, weight, value, land).withColumn("unit", F.lit("m"))
    return metres.unionByName(hypsometry(cells, *FEET, weight, value, land, FEET_IN_METRE).withColumn("unit", F.lit("ft")))


def tile_weight(latitude: Column, size: float = 15.0) -> Column:
    """The weight of a tile by the cosine at its middle, from the latitude of its southern edge."""
    return F.cos(F.radians(latitude + size / 2))


def merge_hypsometries(parts: DataFrame, total: str = "n_total") -> DataFrame:
    """Counts of tiles summed by threshold, shares anew."""
    return parts.groupBy("threshold").agg(F.sum("n_above").alias("n_above"), F.sum(total).alias(total)).withColumn("pct_above", F.try_divide(100.0 * F.col("n_above"), total))


def lake_statistics(cells: DataFrame, depths: Sequence[str], keys: Sequence[str] = ("tile_id", "lake"), value: str = "value") -> DataFrame:
    """Size, extent, modal surface with its share (mean and 1 below five cells), and depth statistics of each lake."""
    keys = list(keys)
    modal = cells.groupBy(*keys, value).agg(F.count("*").alias("m")).groupBy(*keys).agg(
        F.max_by(F.struct(F.col(value).alias("v"), "m"), F.struct(F.col("m"), -F.col(value))).alias("top")
    )
    stats = cells.groupBy(*keys).agg(
        F.count("*").alias("n"), F.min("i").alias("i0"), F.max("i").alias("i1"), F.min("j").alias("j0"), F.max("j").alias("j1"), F.avg(value).alias("mean"),
        *(f(F.col(d)).alias(f"{d}_{n}") for d in depths for n, f in (("mean", F.avg), ("std", F.stddev_pop), ("min", F.min), ("max", F.max))),
    )
    small = F.col("n") < 5
    out = stats.join(modal, keys)
    return out.withColumns({
        "surface": F.when(small, F.col("mean")).otherwise(F.col("top.v")), "surface_share": F.when(small, 1.0).otherwise(F.col("top.m") / F.col("n")),
    }).drop("top", "mean")


def valid_share(cells: DataFrame, value: str = "value", mask: str = "land", by: Sequence[str] = ("tile_id",)) -> DataFrame:
    """Shares of cells with a value and of masked cells, in per cent."""
    return cells.groupBy(*by).agg(
        F.count("*").alias("n"), (100.0 * F.count(value) / F.count("*")).alias("pct_valid"), (100.0 * F.count_if(F.col(mask) == 0) / F.count("*")).alias("pct_masked")
    )


def difference(a: DataFrame, b: DataFrame, by: Sequence[str] = ("tile_id",), value: str = "value", keys: Sequence[str] = KEYS) -> DataFrame:
    """The distribution of the differences of two aligned rasters."""
    d = F.col(f"a.{value}") - F.col(f"b.{value}")
    both = a.alias("a").join(b.alias("b"), list(keys)).withColumn("d", d)
    return both.groupBy(*by).agg(F.count("d").alias("n"), F.min("d").alias("min"), F.max("d").alias("max"), F.avg("d").alias("mean"), F.stddev_pop("d").alias("std"))


def histogram(rows: DataFrame, value: str, low: float, high: float, bins: int, by: Sequence[str] = ()) -> DataFrame:
    """Counts in equal bins of ``[low, high]``; the last bin is closed.

    Without ``by`` there are running sums along the bins. With it, the groups'
    bars are stacked in the order of ``by``: ``running`` is the height of the pile
    in a bin up to and with the group. A group without rows in a bin has no row.
    """
    v = F.col(value)
    inside = rows.where(v.between(low, high))
    at = F.least(F.lit(bins - 1), F.floor((v - low) * bins / (high - low))).cast("bigint")
    counts = inside.groupBy(*by, at.alias("bin")).agg(F.count("*").alias("n"))
    pile = Window.partitionBy("bin").orderBy(*by) if by else Window.orderBy("bin")
    return counts.withColumn("running", F.sum("n").over(pile.rowsBetween(Window.unboundedPreceding, Window.currentRow)))


def error_marks(rows: DataFrame, value: str = "diff_mean", accuracy: int | None = None) -> DataFrame:
    """The numbers beside the histogram; exact percentiles by selection (see :func:`summary`)."""
    d = F.col(value)
    sums = rows.agg(
        F.count(d).alias("n"), F.avg(d).alias("mean"), F.stddev_pop(d).alias("std"), (F.avg(d) - F.stddev_pop(d)).alias("mean_minus"), (F.avg(d) + F.stddev_pop(d)).alias("mean_plus"),
        F.sqrt(F.avg(d * d)).alias("rmse"), *([] if accuracy is None else [F.percentile_approx(d, [0.01, 0.99], accuracy).alias("percentiles")]),
    )
    both = sums if accuracy is not None else _beside(sums, percentiles(rows, d, (0.01, 0.99)), ())
    return both.select("n", "mean", "std", "mean_minus", "mean_plus", F.get("percentiles", 0).alias("p01"), F.get("percentiles", 1).alias("p99"), "rmse")


def progress(rows: DataFrame, status: str = "status") -> DataFrame:
    """Rows of each status and their share in per cent."""
    counts = rows.groupBy(status).agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n").alias("all"))
    return counts.crossJoin(F.broadcast(total)).select(status, "n", (100.0 * F.col("n") / F.col("all")).alias("percent"))


def box_status(boxes: DataFrame, results: DataFrame, key: str) -> DataFrame:
    """EMPTY, DONE or PENDING for each box with its RMSE; results of a box marked empty raise."""
    d = F.col("diff_mean")
    stats = results.groupBy(key).agg(F.count("*").alias("n_cells"), F.sqrt(F.avg(d * d)).alias("rmse"))
    out = boxes.join(stats, key, "left")
    state = (
        F.when(F.col("is_empty") & F.col("n_cells").isNotNull(), F.raise_error(F.lit("an empty box has results")).cast("string"))
        .when(F.col("is_empty"), "EMPTY").when(F.col("n_cells").isNotNull(), "DONE").otherwise("PENDING")
    )
    return out.withColumn("status", state)


def bounds(rows: DataFrame, x: str, y: str, by: Sequence[str] = (), epsg: str | None = None) -> DataFrame:
    """Bounding boxes; null where nothing is. With a column ``epsg``, several reference systems in one group raise."""
    if epsg is not None:
        several = F.raise_error(F.lit("a collection has several reference systems")).cast("double")
        box = [F.when(F.count_distinct(epsg) <= 1, f(c)).otherwise(several).alias(n) for n, f, c in (("xmin", F.min, x), ("ymin", F.min, y), ("xmax", F.max, x), ("ymax", F.max, y))]
        return rows.groupBy(*by).agg(*box)
    return rows.groupBy(*by).agg(F.min(x).alias("xmin"), F.min(y).alias("ymin"), F.max(x).alias("xmax"), F.max(y).alias("ymax"))


def collection_summary(results: DataFrame, key: str = "tile_id", value: str = "diff_mean") -> DataFrame:
    """The error summary of each raster of a collection and of all together, in one pass."""
    d = F.col(value)
    return results.rollup(key).agg(F.count("*").alias("n_cells"), F.sum("n_trim").alias("n_photons"), F.avg(d).alias("dem_minus_photon"), F.sqrt(F.avg(d * d)).alias("rmse"))


def longitude_bins(rows: DataFrame, width: float = 2.5, x: str = "longitude") -> DataFrame:
    """How many rows each band of longitudes has."""
    return rows.groupBy(F.floor(F.col(x) / width).alias("bin")).agg(F.count("*").alias("n"))


def audit(catalogue: DataFrame, counted: DataFrame, key: str = "tile_id") -> DataFrame:
    """Catalogue entries whose counts are wrong, with the right ones, and whether total = canopy + ground held."""
    names = ["numphotons", "numphotons_canopy", "numphotons_ground"]
    both = catalogue.alias("c").join(counted.alias("n"), key, "left")
    wrong = F.lit(False)
    for n in names:
        wrong = wrong | ~F.col(f"c.{n}").eqNullSafe(F.coalesce(F.col(f"n.{n}"), F.lit(0)))
    return both.where(wrong).select(
        key, *(F.col(f"c.{n}").alias(f"recorded_{n}") for n in names), *(F.coalesce(F.col(f"n.{n}"), F.lit(0)).alias(n) for n in names),
        (F.col("c.numphotons") == F.col("c.numphotons_canopy") + F.col("c.numphotons_ground")).alias("added_up"),
    )


def regional(results: DataFrame, regions: DataFrame, key: str) -> DataFrame:
    """The error summary of each region and of all, by a roll-up."""
    d = F.col("diff_mean")
    return results.join(regions, key).rollup("region").agg(F.count("*").alias("n_cells"), F.avg(d).alias("bias"), F.sqrt(F.avg(d * d)).alias("rmse"))
