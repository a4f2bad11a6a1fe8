"""Labelled samples for the classifiers: bounded, chosen by hash, never from held-out rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: At most so many labelled rows fit a classifier; scoring always covers every row.
SAMPLE_ROWS = 20_000


def held_out(modulus: int, remainder: int) -> Column:
    """Whether crc32(doc_id as text) leaves that remainder; a null doc_id is never held out."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % modulus == remainder, F.lit(False))


def sample(docs: DataFrame, labels: DataFrame, label: str, modulus: int, remainder: int, rows: int = SAMPLE_ROWS) -> DataFrame:
    """doc_id, text, y of at most `rows` labelled, not held-out documents, those first by a hash of doc_id.

    A doc_id with several labels counts with the largest. The ids, at most
    `rows`, are broadcast.
    """
    marked = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("y")).dropna()
    chosen = marked.filter(~held_out(modulus, remainder)).groupBy("doc_id").agg(F.max("y").alias("y")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    texts = docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"))
    return texts.join(F.broadcast(chosen), "doc_id").select("doc_id", "text", "y")
