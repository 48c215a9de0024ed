"""Fixtures, and the registry of queries with the SQL that they must equal."""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Projections of the driver's tables, valid in Spark and in DuckDB alike.
FIXTURES = {
    # photons: 10 degree tiles side by side, one for each 400 parts
    "fx_photons": """
SELECT l_orderkey * 8 + l_linenumber AS photon_id, l_orderkey, CAST(l_linenumber AS BIGINT) AS line_no, l_partkey, l_suppkey,
  l_suppkey % 7 AS granule_id1, l_suppkey % 3 AS granule_id2, l_partkey % 6 AS beam,
  CAST(floor(l_partkey / 4e2) AS DOUBLE) * 1e1 + CAST((l_orderkey * 7919 + l_linenumber * 104729) % 4000 AS DOUBLE) / 4e2 AS longitude,
  CAST(40 AS DOUBLE) + CAST((l_partkey * 6271 + l_orderkey * 31 + l_linenumber * 17) % 4000 AS DOUBLE) / 4e2 AS latitude,
  floor(l_extendedprice) / 8e0 + CAST(l_linenumber AS DOUBLE) AS h_geoid,
  floor(l_extendedprice) / 8e0 + CAST(l_linenumber AS DOUBLE) + CAST(l_suppkey % 5 AS DOUBLE) AS h_ellipsoid,
  floor(l_extendedprice) / 8e0 + CAST(l_linenumber AS DOUBLE) - 1.25e-1 AS h_meantide,
  (l_orderkey + l_linenumber * 3) % 6 - 1 AS class_code, (l_partkey + l_linenumber) % 5 AS conf_land,
  (l_suppkey + l_linenumber) % 5 AS conf_land_ice, CAST(CASE WHEN l_orderkey % 11 = 0 THEN 1 ELSE 0 END AS BIGINT) AS quality_ph,
  CAST((l_orderkey * 13 + l_linenumber) % 300000 AS DOUBLE) / 1e1 AS dist_x, l_shipdate AS ts
FROM {lineitem}""",
    "fx_cells": """
SELECT CAST(floor(p_partkey / 4e2) AS BIGINT) AS tile_id, p_partkey % 20 AS i, CAST(floor((p_partkey % 400) / 2e1) AS BIGINT) AS j,
  floor(p_retailprice) / 8e0 AS value, CASE WHEN p_size % 5 = 0 THEN 0 ELSE 1 END AS land, CAST(p_size AS BIGINT) AS size,
  CAST(p_size % 50 AS BIGINT) AS type_id, CAST(p_size % 10 AS BIGINT) AS contributor
FROM {part}""",
    "fx_tiles": """
SELECT CAST(n_nationkey AS BIGINT) AS tile_id, n_name AS tile_name, CAST(15 * (n_nationkey % 5) AS BIGINT) AS xmin,
  CAST(15 * floor(n_nationkey / 5e0) AS BIGINT) AS ymin, CAST(15 * (n_nationkey % 5) + 15 AS BIGINT) AS xmax,
  CAST(15 * floor(n_nationkey / 5e0) + 15 AS BIGINT) AS ymax
FROM {nation}""",
    "fx_sources": """
SELECT s_suppkey AS source_key, s_name AS filename, (s_suppkey * 37) % 70 AS xmin, (s_suppkey * 53) % 70 AS ymin,
  (s_suppkey * 37) % 70 + 1 + s_suppkey % 9 AS xmax, (s_suppkey * 53) % 70 + 1 + s_suppkey % 7 AS ymax,
  CAST(s_nationkey % 13 + 1 AS BIGINT) AS source_id
FROM {supplier}""",
    "fx_registry": """
SELECT CAST(n_nationkey % 13 + 1 AS BIGINT) AS id_number, min(n_name) AS dset_name, CAST(min(n_nationkey) * 7 % 13 AS BIGINT) AS ranking_score,
  CAST(max(n_regionkey) AS BIGINT) AS region, CASE WHEN min(n_nationkey) % 4 = 3 THEN false ELSE true END AS is_active
FROM {nation} GROUP BY n_nationkey % 13 + 1""",
    "fx_source_registry": """
SELECT s_suppkey AS id_number, s_name AS dset_name, s_suppkey * 7 % 1000 AS ranking_score, CAST(s_nationkey % 5 AS BIGINT) AS region,
  CASE WHEN s_suppkey % 4 = 3 THEN false ELSE true END AS is_active
FROM {supplier}""",
    "fx_source_cells": """
SELECT l_orderkey % 200 AS i, l_partkey % 200 AS j, l_suppkey % 13 + 1 AS weight, CAST(l_linenumber AS STRING) AS filename,
  floor(l_extendedprice) / 8e0 AS elev
FROM {lineitem}""",
    "fx_segments": """
SELECT o_orderkey AS segment_id, o_custkey % 50 AS granule, o_custkey % 6 AS beam, CAST(o_custkey % 4 AS DOUBLE) / 8e0 AS geoid, CAST(o_custkey % 3 AS DOUBLE) / 8e0 AS free2mean,
  CAST(o_orderkey AS DOUBLE) * 2e1 AS seg_dist, count(l_orderkey) AS cnt
FROM {orders} LEFT JOIN {lineitem} ON l_orderkey = o_orderkey GROUP BY o_orderkey, o_custkey""",
    "fx_heights": """
SELECT o_custkey % 50 AS granule, o_custkey % 6 AS beam, row_number() OVER (PARTITION BY o_custkey % 50, o_custkey % 6 ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_quantity) - 1 AS pos,
  floor(l_extendedprice) / 8e0 AS h, CAST(l_linenumber AS DOUBLE) / 2e0 AS along
FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey""",
    "fx_signal": """
SELECT granule, beam, segment_id, idx, flag FROM (
  SELECT o_custkey % 50 AS granule, o_custkey % 6 AS beam, l_orderkey + CASE WHEN l_partkey % 50 = 7 THEN 900000000 ELSE 0 END AS segment_id,
    row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) AS idx, l_partkey % 3 AS third, l_partkey % 4 AS flag
  FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey) AS s
WHERE third > 0""",
    "fx_rejects": """
SELECT o_custkey % 40 AS granule, o_orderkey % 30 AS csv_filename, CAST(floor(o_totalprice / 1e3) AS BIGINT) AS photon_count FROM {orders}""",
    "fx_granule_names": """
SELECT o_orderkey AS key, concat('ATL0', CASE WHEN o_orderkey % 2 = 0 THEN '3' ELSE '8' END, '_20', lpad(CAST(10 + o_custkey % 12 AS STRING), 2, '0'),
  '0', CAST(1 + o_custkey % 9 AS STRING), '1', CAST(o_custkey % 10 AS STRING), '150000_', lpad(CAST(o_custkey % 1387 AS STRING), 4, '0'),
  lpad(CAST(o_orderkey % 14 + 1 AS STRING), 4, '0'), '_00', CAST(3 + o_custkey % 3 AS STRING), '_01.h5') AS name
FROM {orders}""",
    "fx_files": """
SELECT p_partkey AS key, concat('ncei', CASE WHEN p_partkey % 3 = 0 THEN '1' ELSE '13' END, '_n', lpad(CAST(20 + p_partkey % 30 AS STRING), 2, '0'), 'x',
  CAST(p_partkey % 4 * 25 AS STRING), '_w', lpad(CAST(60 + p_partkey % 60 AS STRING), 3, '0'), 'x', CAST(p_size % 4 * 25 AS STRING), '_',
  CAST(2010 + p_size % 14 AS STRING), 'v', CAST(1 + p_size % 2 AS STRING), '_', CASE WHEN p_size % 3 = 0 THEN 'navd88' WHEN p_size % 3 = 1 THEN 'MHW' ELSE 'unk' END, '.tif') AS filename,
  concat('US', CAST(1 + p_size % 5 AS STRING), CASE WHEN p_size % 4 = 0 THEN 'C' WHEN p_size % 4 = 1 THEN 'F' WHEN p_size % 4 = 2 THEN 'H' ELSE 'J' END,
    lpad(CAST(p_partkey % 97 AS STRING), 4, '0'), '_', CAST(20200101 + p_size AS STRING), '.tiff') AS coast_name,
  concat(CASE WHEN p_partkey % 2 = 0 THEN 'N' ELSE 'S' END, lpad(CAST(p_partkey % 90 AS STRING), 2, '0'), CASE WHEN p_partkey % 3 = 0 THEN 'E' ELSE 'W' END,
    lpad(CAST(p_partkey % 180 AS STRING), 3, '0')) AS tag, CAST(p_size AS BIGINT) AS size
FROM {part}""",
}

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


class Tables:
    """The driver's tables and the fixtures over them, by name."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name in TABLES:
            return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        if f"fx_{name}" in FIXTURES:
            text = FIXTURES[f"fx_{name}"]
            named = set(re.findall(r"\{(\w+)\}", text))
            return self.spark.sql(text, **{n: getattr(self, n) for n in named})
        raise AttributeError(name)

    @cached_property
    def session(self) -> SparkSession:
        return self.spark


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _plain(df: DataFrame) -> DataFrame:
    """Whole numbers as BIGINT, floating ones as DOUBLE."""
    casts = {T.ByteType: "bigint", T.ShortType: "bigint", T.IntegerType: "bigint", T.FloatType: "double"}
    return df.select(*(F.col(f.name).cast(casts[type(f.dataType)]).alias(f.name) if type(f.dataType) in casts else F.col(f.name) for f in df.schema))


def _with_fixtures(sql: str) -> str:
    used = [n for n in FIXTURES if re.search(rf"\b{n}\b", sql)]
    ctes = [f"{n} AS ({FIXTURES[n].format(**{t: t for t in TABLES})})" for n in used]
    body = sql.strip()
    if not ctes:
        return body
    recursive = body.upper().startswith("WITH RECURSIVE")
    rest = re.sub(r"^WITH (RECURSIVE )?", ", ", body, count=1, flags=re.I) if body[:5].upper() == "WITH " else "\n" + body
    return f"WITH {'RECURSIVE ' if recursive else ''}{', '.join(ctes)}{rest}"


def query(name: str, sql: str | None = None) -> Callable:
    """Register ``fn(tables) -> DataFrame`` with the SQL that gives the same rows."""

    def register(fn: Callable[[Tables], DataFrame]) -> Callable:
        QUERIES[name] = lambda spark, sf_dir: _plain(fn(Tables(spark, sf_dir)))
        if sql is not None:
            ORACLES[name] = _with_fixtures(sql)
        return fn

    return register


def r6(c: Column | str) -> Column:
    """Six decimals, halves up, alike in both engines."""
    c = F.col(c) if isinstance(c, str) else c
    return F.floor(c * 1e6 + 0.5) / 1e6


def q6(expr: str) -> str:
    """:func:`r6` as SQL."""
    return f"floor(({expr}) * 1e6 + 5e-1) / 1e6"
