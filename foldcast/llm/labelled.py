"""Bounded samples of labelled rows, and the rows held out from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foldcast.llm.common import picked


def held_out(id_col: str = "doc_id") -> Column:
    """Rows whose labels no model may see: crc32 of the id as text, modulo 4, is 2 (a null id is not held out)."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def training_sample(docs: DataFrame, labels: DataFrame, label: str, rows: int, longest: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """At most `rows` labelled texts (text, label), in the order of a hash of the id; texts over `longest` bytes stay out.

    The sampled ids are at most `rows`, so they are broadcast; rows with null ids or labels and held-out rows are not taken.
    """
    named = picked(labels, id_col, label).select(F.col(id_col).alias("_id"), F.col(label).cast("int").alias("label")).where(F.col("_id").isNotNull() & F.col("label").isNotNull() & ~held_out("_id"))
    one = named.groupBy("_id").agg(F.max("label").alias("label"))
    chosen = one.orderBy(F.xxhash64("_id"), "_id").limit(rows)
    texts = picked(docs, id_col, text_col).select(F.col(id_col).alias("_id"), F.col(text_col).alias("text"))
    found = texts.join(F.broadcast(chosen), "_id")
    return found.where(F.coalesce(F.octet_length("text"), F.lit(0)) <= longest).select("text", "label")
