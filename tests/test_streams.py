"""Streams over files that arrive late, twice, and across restarts."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

import numpy as np
from pyspark.sql import functions as F

from relievo.plans.storage import new_folder
from relievo.streaming import jobs

DAY = datetime(2024, 3, 1)
EVENTS = "k int, ts timestamp, id int, value double"


def arrive(spark, folder, rows, name):
    """One file of rows in a folder that a stream watches."""
    spark.createDataFrame(rows, EVENTS).coalesce(1).write.mode("overwrite").parquet(f"{folder}/{name}")


def stream(spark, folder):
    return spark.readStream.schema(EVENTS).option("maxFilesPerTrigger", 1).parquet(f"{folder}/*")


def run(rows, out):
    rows.writeStream.format("parquet").option("path", f"{out}/rows").option("checkpointLocation", f"{out}/state").outputMode("append").trigger(availableNow=True).start().awaitTermination()


def test_a_pair_that_arrives_again_comes_out_once(spark):
    folder = new_folder(spark, "arrivals")
    at = lambda h: DAY + timedelta(hours=h)
    a = [(1, at(0), 10, 0.0), (1, at(0.2), 11, 0.0), (2, at(1), 12, 0.0)]
    b = [(1, at(0.5), 20, 0.0), (2, at(1.5), 21, 0.0), (3, at(2), 22, 0.0)]
    for name, rows in (("a1", a), ("a2", a)):
        arrive(spark, f"{folder}/a", rows, name)
    for name, rows in (("b1", b), ("b2", b)):
        arrive(spark, f"{folder}/b", rows, name)
    pairs = lambda: jobs.matched_stream(stream(spark, f"{folder}/a"), stream(spark, f"{folder}/b"), "k", once=["id"]).select("id_a", "id_b")
    out = new_folder(spark, "pairs")
    run(pairs(), out)
    # after a restart the files come once more, beside others far ahead in time, and then once more, too late
    arrive(spark, f"{folder}/a", [*a, (1, at(100), 13, 0.0)], "a3")
    arrive(spark, f"{folder}/b", [*b, (1, at(100.5), 23, 0.0)], "b3")
    run(pairs(), out)
    arrive(spark, f"{folder}/a", [*a, (1, at(200), 14, 0.0)], "a4")
    arrive(spark, f"{folder}/b", [*b, (1, at(200.5), 24, 0.0)], "b4")
    run(pairs(), out)
    got = sorted(tuple(r) for r in spark.read.parquet(f"{out}/rows").collect())
    assert got == [(10, 20), (11, 20), (12, 21), (13, 23), (14, 24)]
    # without the names of what tells arrivals apart, copies pair anew
    plain = new_folder(spark, "pairs")
    run(jobs.matched_stream(stream(spark, f"{folder}/a"), stream(spark, f"{folder}/b"), "k").select("id_a", "id_b"), plain)
    assert spark.read.parquet(f"{plain}/rows").count() > len(got)


def test_percentiles_of_windows_late_rows_and_a_restart(spark):
    r = random.Random(2)
    day = lambda d, h=0.0: DAY + timedelta(days=d, hours=h)
    folder, out = new_folder(spark, "values"), new_folder(spark, "windows")
    first = [(k % 2, day(0, r.uniform(0, 23)), k, r.gauss(0, 1)) for k in range(6000)]
    arrive(spark, folder, first, "1")
    arrive(spark, folder, [(0, day(1, 1), -1, None), (0, day(1, 2), -2, float("nan")), (1, day(1, 3), -3, 5.0)], "2")
    shares = (0.0, 0.01, 0.25, 0.5, 0.9, 1.0)
    rows = lambda: jobs.running_statistics(stream(spark, folder), ["k"], "value", delay="6 hours", shares=shares)
    run(rows(), out)
    late = [(0, day(0, 23.5), -4, 1e9)]  # within the delay when it comes
    arrive(spark, folder, late, "3")
    arrive(spark, folder, [(0, day(3), -5, 1.0)], "4")
    arrive(spark, folder, [(0, day(3, 1), -8, 1.0)], "4b")  # the batch in which the window comes out
    arrive(spark, folder, [(0, day(0, 12), -6, -1e9)], "5")  # its window has come out
    arrive(spark, folder, [(0, day(6), -7, 1.0)], "6")
    run(rows(), out)
    got = {(x["window"]["start"], x["k"]): x for x in spark.read.parquet(f"{out}/rows").collect()}
    assert len(got) == spark.read.parquet(f"{out}/rows").count()
    for k in (0, 1):
        own = np.sort([v for q, _, _, v in first if q == k] + ([1e9] if k == 0 else []))
        row = got[DAY, k]
        assert row["n"] == len(own)
        for p, q in zip(shares, row["percentiles"]):
            assert abs(np.searchsorted(own, q, "right") / len(own) - p) < 0.01
        assert row["percentiles"][-1] == own[-1] and row["percentiles"][0] == own[0]
    assert got[day(1), 0]["n"] == 2 and got[day(1), 0]["percentiles"] is None
    assert got[day(1), 1]["percentiles"] == [5.0] * 6
    plain = jobs.running_statistics(stream(spark, folder), ["k"], "value")
    assert plain.columns == ["window", "k", "n", "mean", "std"]


def test_a_stream_has_the_batch_values(spark):
    rows = spark.createDataFrame([(1, DAY, 1, 2.0), (1, DAY, 2, 4.0)], EVENTS)
    out = jobs.running_statistics(rows, ["k"], "value", shares=(0.5, 1.0)).select("n", "mean", "percentiles").first()
    assert tuple(out) == (2, 3.0, [2.0, 4.0])
    assert jobs.running_statistics(rows.where(F.lit(False)), ["k"], "value", shares=(0.5,)).count() == 0
