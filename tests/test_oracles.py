"""Every registered query against its SQL on the smallest tables."""

from __future__ import annotations

import duckdb
import pandas as pd
import pytest

from relievo.queries import catalogue, files, grids, photons  # noqa: F401
from relievo.queries.registry import ORACLES, QUERIES, TABLES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.sql("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def rows(frame: pd.DataFrame) -> list[tuple]:
    frame = frame[sorted(frame.columns)].astype(object)
    return sorted((tuple(None if pd.isna(v) else v for v in r) for r in frame.itertuples(index=False, name=None)), key=repr)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, name):
    ours = QUERIES[name](spark, SF).toPandas()
    if name not in ORACLES:
        return
    theirs = duck.sql(ORACLES[name]).df()
    assert sorted(ours.columns) == sorted(theirs.columns)
    assert rows(ours) == rows(theirs)
