"""Incremental jobs as Structured Streaming (ST1-ST6)."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from relievo.plans.storage import delete, exists, folders, scratch


def matched_stream(a: DataFrame, b: DataFrame, key: str, time: str = "ts", delay: str = "2 hours", gap: str = "1 hour", once: Sequence[str] = ()) -> DataFrame:
    """ST1: pairs of arrivals with one key at most ``gap`` apart; watermarks bound the state.

    ``once`` names the columns that tell arrivals of a key apart. An arrival that comes
    again, as a file that is delivered twice, then makes no pair anew: it is dropped
    while its first copy is within the watermark, and after that it is late itself, if it carries the
    time of its first copy. So a pair comes out once, and the state of both steps goes as the
    watermark moves.
    """

    def side(df: DataFrame, name: str) -> DataFrame:
        rest = (F.col(c).alias(f"{c}_{name}") for c in df.columns if c not in (key, time))
        rows = df.select(F.col(key).alias(f"key_{name}"), F.col(time).alias(f"ts_{name}"), *rest).withWatermark(f"ts_{name}", delay)
        return rows.dropDuplicatesWithinWatermark([f"key_{name}", *(f"{c}_{name}" for c in once)]) if once else rows

    on = F.expr(f"key_a = key_b and ts_b >= ts_a - interval {gap} and ts_b <= ts_a + interval {gap}")
    return side(a, "a").join(side(b, "b"), on)


def upsert(table: DataFrame, rows: DataFrame, key: Sequence[str], order: str) -> DataFrame:
    """ST2, ST3: the table with the newest row of each key; the same rows again change nothing."""
    both = table.unionByName(rows.select(*table.columns))
    rest = [c for c in table.columns if c not in key]
    return both.groupBy(*key).agg(F.max_by(F.struct(*rest), F.struct(order, *rest)).alias("r")).select(*key, "r.*").select(*table.columns)


def matched(table: DataFrame, rows: DataFrame, key: Sequence[str], same: Sequence[str]) -> DataFrame:
    """ST2: the rows, each checked to have one row of the table with equal ``same`` columns; others raise."""
    counted = table.groupBy(*key).agg(F.count("*").alias("__n"), F.min(F.struct(*same)).alias("__s"))
    fits = (F.coalesce("__n", F.lit(0)) == 1) & F.struct(*same).eqNullSafe(F.col("__s"))
    bad = F.raise_error(F.lit("a summary does not fit one row of the catalogue"))
    first = F.when(fits, F.col(key[0])).otherwise(bad.cast(rows.schema[key[0]].dataType))
    return rows.join(counted, list(key), "left").withColumn(key[0], first).select(*rows.columns)


def latest(spark: SparkSession, path: str, before: int | None = None) -> DataFrame | None:
    """The newest whole version of a table of :func:`upsert_stream`, below a number where given; none without one."""
    found = sorted(int(v[1:]) for v in folders(spark, path) if v[1:].isdigit() and (before is None or int(v[1:]) < before))
    whole = [v for v in found if exists(spark, f"{path}/v{v}/_SUCCESS")]
    return spark.read.parquet(f"{path}/v{whole[-1]}") if whole else None


def upsert_stream(
    stream: DataFrame, path: str, checkpoint: str, key: Sequence[str], order: str, start: DataFrame | None = None, same: Sequence[str] = ()
) -> StreamingQuery:
    """ST2: arriving rows merged into versions of a table below ``path``, from the table ``start`` on.

    A batch reads the version before its own and writes the version of its id, so
    a replayed batch writes the same table again; versions before the last two go.
    With ``same``, every row has to fit one row of the table (see :func:`matched`).
    """

    def merge(rows: DataFrame, batch: int) -> None:
        spark = rows.sparkSession
        old = latest(spark, path, batch)
        if old is None:
            old = start if start is not None else rows.limit(0)
        checked = matched(old, rows, key, same) if same else rows
        upsert(old, checked.select(*old.columns), key, order).write.mode("overwrite").parquet(f"{path}/v{batch}")
        for version in folders(spark, path):
            if version[1:].isdigit() and int(version[1:]) < batch - 1:
                delete(spark, f"{path}/{version}")

    return stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def spool(spark: SparkSession, path: str, schema: str, files: int = 1) -> DataFrame:
    """ST2: a stream of the one-row CSV files that arrive in a folder, so many a batch; a file goes once its batch is done."""
    reader = spark.readStream.schema(schema).option("header", True).option("maxFilesPerTrigger", files).option("cleanSource", "delete")
    return reader.csv(path)


def progress_table(boxes: DataFrame, granules: DataFrame, key: str) -> DataFrame:
    """ST3: the progress table rebuilt from the data: boxes with granules are done, with how many distinct ones they have."""
    counts = granules.groupBy(key).agg(F.count_distinct("granule").alias("numgranules"))
    return boxes.join(counts, key, "left").withColumns({"is_done": F.col("numgranules").isNotNull(), "numgranules": F.coalesce("numgranules", F.lit(0))})


def affected_tiles(photons: DataFrame, rejected: DataFrame, keys: Sequence[str] = ("granule_id1", "granule_id2"), tile: str = "tile_id") -> DataFrame:
    """ST4: tiles with photons of rejected granules; these are to be validated again."""
    return photons.join(rejected, list(keys), "left_semi").select(tile).distinct()


def revalidate(
    path: str, photons: DataFrame, rejected: DataFrame, validate: Callable[[DataFrame], DataFrame], keys: Sequence[str] = ("granule_id1", "granule_id2"), tile: str = "tile_id"
) -> None:
    """ST4: the results of tiles with photons of newly rejected granules made again without these; other tiles' files stay.

    ``path`` is partitioned by tile. Tiles that nothing is left of lose their folder.
    """
    spark = photons.sparkSession
    tiles = affected_tiles(photons, rejected, keys, tile)
    rows = photons.join(tiles, tile, "left_semi").join(rejected.select(*keys), list(keys), "left_anti")
    with scratch(spark, "revalidate") as keep:
        results, tiles = keep(validate(rows), "results"), keep(tiles, "tiles")
        results.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(tile).parquet(path)
        for row in tiles.join(results, tile, "left_anti").toLocalIterator():  # names of emptied tiles alone
            delete(spark, f"{path}/{tile}={row[tile]}")


def backfill(catalogue: DataFrame, counted: DataFrame, key: str = "tile_id") -> DataFrame:
    """ST5: counts of tiles that the catalogue does not call populated."""
    return counted.join(catalogue.where("is_populated").select(key), key, "left_anti")


def running_statistics(
    stream: DataFrame, keys: Sequence[str], value: str, time: str = "ts", window: str = "1 day", delay: str = "1 day", shares: Sequence[float] = (), k: int = 400
) -> DataFrame:
    """ST6: count, mean and deviation of each cell in windows of a photon stream, and percentiles where ``shares`` are given.

    In append mode a window comes out once the watermark has passed its end, and
    its state goes; rows that are later than that are left out. The state of a
    window's percentiles is a mergeable quantile sketch of a fixed size: up to ``k`` values it is
    exact, beyond that ranks are off by about ``1.7 / k``. Nulls and NaN are not in it.
    """
    rows = stream.withWatermark(time, delay).groupBy(F.window(time, window), *keys)
    sums = [F.count("*").alias("n"), F.avg(value).alias("mean"), F.stddev_samp(value).alias("std")]
    if not shares:
        return rows.agg(*sums)
    real = F.when(~F.isnan(F.col(value).cast("double")), F.col(value).cast("double"))
    out = rows.agg(*sums, F.kll_sketch_agg_double(real, k).alias("__sketch"))
    some = F.kll_sketch_get_n_double("__sketch") > 0
    ranks = F.array(*(F.kll_sketch_get_quantile_double("__sketch", F.lit(float(p))) for p in shares))
    return out.withColumn("percentiles", F.when(some, ranks)).drop("__sketch")


def file_stream(spark: SparkSession, path: str, schema: str, kind: str = "parquet") -> DataFrame:
    """A stream of the files that arrive in a folder."""
    return spark.readStream.schema(schema).format(kind).load(path)
