"""A training corpus in five stages over the documents table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from relievo.llm import decontaminate, neardup, packing, quality, secrets
from relievo.plans.storage import delete, drop_shuffles, materialize, new_folder
from relievo.plans.text import row_digest


def _by_row(docs: DataFrame) -> DataFrame:
    """What operators read of the documents, each row under the key of its id and text."""
    return docs.select(row_digest().alias("doc_id"), *(c for c in docs.columns if c != "doc_id"))


def _rows(docs: DataFrame, keys: DataFrame) -> DataFrame:
    """The documents whose keys are among the distinct ``__row``, with their key."""
    return docs.withColumn("__row", row_digest()).join(keys, "__row", "left_semi")


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the documents that the classifier accepts."""
    trusted = quality.trusted_documents(spark.read.parquet(f"{sf_dir}/labels.parquet"))
    trusted = docs.select("doc_id", row_digest().alias("__row")).join(trusted, "doc_id", "left_semi").select(F.col("__row").alias("doc_id")).distinct()
    kept = quality.classify(_by_row(docs), trusted).where("keep").select(F.col("doc_id").alias("__row")).distinct()
    return _rows(docs, kept).select(*docs.columns)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document with the least id of each group of near duplicates, once; null ids come last."""
    groups = neardup.link_components(_by_row(docs)).select(F.col("doc_id").alias("__row"), "component_id").distinct()
    drop_shuffles(spark)  # of the join, before the texts move once more
    named = groups.join(docs.select(row_digest().alias("__row"), "doc_id").distinct(), "__row")
    least = F.min(F.struct(F.isnull("doc_id").alias("absent"), "doc_id", "__row")).alias("least")
    first = named.groupBy("component_id").agg(least).select("least.__row")
    return _rows(docs, first).dropDuplicates(["__row"]).select(*docs.columns)  # rows already meet by key


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that hold a benchmark item."""
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace secrets by a mark."""
    return secrets.redact(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pack what is left into sequences."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality classifier", quality_stage),
    ("n-gram Jaccard join", near_duplicate_stage),
    ("benchmark decontamination", decontamination_stage),
    ("secret scans", secrets_stage),
    ("packing", packing_stage),
]

#: The classifier's and the packer's arithmetic is not for SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table; each stage's result is written and read again, and deleted once the next one's is there."""
    docs, last = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for _, stage in STAGES[:-1]:
        folder = new_folder(spark, "stage")
        docs = materialize(stage(spark, docs, sf_dir), "rows", folder)
        if last:
            delete(spark, last)
        last = folder
    return STAGES[-1][1](spark, docs, sf_dir)
