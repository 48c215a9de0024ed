"""Small helpers over text columns that several operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def text_or_empty(name: str = "text") -> Column:
    """The column as a string, null as the empty string."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def row_digest() -> Column:
    """A key of a row's doc_id, null included, and its text: 128 bits as hexadecimal digits, so it can stand in for the id."""
    return F.md5(F.encode(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), F.lit(":"), text_or_empty()), "utf-8"))


def id_kind(docs: DataFrame) -> str:
    """The type that a table's doc_id has in results: strings stay strings, all else is a whole number."""
    return "string" if docs.schema["doc_id"].dataType == T.StringType() else "bigint"


def id_of(docs: DataFrame) -> Column:
    """The doc_id in that type."""
    return F.col("doc_id").cast(id_kind(docs)).alias("doc_id")
