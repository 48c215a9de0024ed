"""The registered queries against their SQL, and the pipeline, on the smallest tables."""

from __future__ import annotations

import duckdb
import pandas as pd
import pytest

import corpus_pipeline
from relievo.llm.queries import QUERIES, oracle_sql
from relievo.llm.secrets import BASE, scan

SF = "/root/testdata/sf0.001"


def rows(frame):
    frame = frame[sorted(frame.columns)].astype(object)
    return sorted((tuple(None if pd.isna(v) else v for v in r) for r in frame.itertuples(index=False, name=None)), key=repr)


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "conversations", "benchmark", "labels"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    ours, theirs = QUERIES[name](spark, SF).toPandas(), con.sql(oracle_sql()[name]).df()
    assert sorted(ours.columns) == sorted(theirs.columns) and rows(ours) == rows(theirs)


def test_stages_of_the_pipeline(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    sizes = [docs.count()]
    at = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, at, SF)
        assert out.columns == docs.columns and out.schema == docs.schema, name
        at = spark.createDataFrame(out.toPandas(), docs.schema)
        sizes.append(at.count())
    assert sizes == sorted(sizes, reverse=True) and 0 < sizes[-1] < sizes[0]
    left = scan(at).agg({f"n_{k}": "sum" for k in BASE}).first()
    assert all(v == 0 for v in left)
    packed = corpus_pipeline.STAGES[-1][1](spark, at, SF)
    assert {r["doc_id"] for r in packed.select("doc_id").distinct().collect()} == {r["doc_id"] for r in at.select("doc_id").collect()}
    # where documents are cut depends on how rows lie; what the pieces put together does not
    assert put_together(corpus_pipeline.run(spark, SF)) == put_together(packed)


def put_together(pieces):
    """Each document's tokens as the gapless cover of its pieces says them; sequences are checked on the way."""
    docs, sequences = {}, {}
    for r in pieces.collect():
        docs.setdefault((r["doc_id"], r["doc_tokens"]), []).append((r["start"], r["length"]))
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at == 4096 or at & (at - 1) == 0
    for (_, n), parts in docs.items():
        at = 0
        for start, length in sorted(parts):
            assert start == at
            at += length
        assert at == n
    return sorted(docs)
