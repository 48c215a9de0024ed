"""Exact percentiles by distributed selection."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from relievo.plans.storage import materialize, scratch


def percentiles(rows: DataFrame, value: Column | str, shares: Sequence[float], by: Sequence[str] = ()) -> DataFrame:
    """``(*by, percentiles)``: what ``percentile(value, array(shares))`` gives, without a group in one task.

    Values are counted where they are read and dealt by range of (group, value) to bins, one
    a shuffle partition; sums over bins say which bins hold the wanted ranks, and only these are
    sorted. So a task sorts one bin of distinct values, however large a group is, and many small groups
    share a bin. Nulls do not count; a group without values has no row; groups may be null.
    """
    spark = rows.sparkSession
    value = F.col(value) if isinstance(value, str) else value
    parts = max(2, int(spark.conf.get("spark.sql.shuffle.partitions")))
    group = F.struct(F.lit(0).alias("_"), *by)
    with scratch(spark, "percentiles") as keep:
        counted = rows.select(group.alias("g"), value.cast("double").alias("v")).where("v is not null").groupBy("g", "v").agg(F.count("*").alias("n"))
        bins = keep(counted.repartitionByRange(parts, "g", "v").withColumn("bin", F.spark_partition_id()), "bins")
        sums = bins.groupBy("g", "bin").agg(F.sum("n").alias("m"))
        along = Window.partitionBy("g").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
        sums = sums.withColumns({"before": F.coalesce(F.sum("m").over(along), F.lit(0)), "total": F.sum("m").over(Window.partitionBy("g"))})
        place = [F.lit(float(p)) * (F.col("total") - 1) for p in shares]
        ranks = F.array(*(f(p).cast("long") for p in place for f in (F.floor, F.ceil)))
        holds = lambda low, high: F.exists(ranks, lambda r: (r >= low) & (r < high))
        wanted = sums.where(holds(F.col("before"), F.col("before") + F.col("m"))).select("g", "bin", "before", "total")
        inside = Window.partitionBy("g", "bin").orderBy("v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        hit = bins.join(wanted, ["g", "bin"]).withColumn("end", F.col("before") + F.sum("n").over(inside))
        hit = hit.withColumn("start", F.col("end") - F.col("n")).where(holds(F.col("start"), F.col("end")))
        at = lambda r: F.max(F.when((r >= F.col("start")) & (r < F.col("end")), F.col("v")))
        found = hit.groupBy("g").agg(F.first("total").alias("total"), *(at(f(p)).alias(f"{c}{k}") for k, p in enumerate(place) for c, f in (("a", F.floor), ("b", F.ceil))))
        between = lambda k, p: F.when(F.col(f"a{k}") == F.col(f"b{k}"), F.col(f"a{k}")).otherwise((F.ceil(p) - p) * F.col(f"a{k}") + (p - F.floor(p)) * F.col(f"b{k}"))
        out = found.select(*(F.col("g")[c].alias(c) for c in by), F.array(*(between(k, p) for k, p in enumerate(place))).alias("percentiles"))
        return materialize(out, "percentile-rows")
