"""A corpus from raw documents to packed sequences: five stages, each written as Parquet and read again.

Stages 1 to 4 return the columns of documents; the last returns the pieces of
packed sequences. Each stage reads all that the one before kept.

Defined results: null and empty texts fail the quality rules and go; of equal and nearly equal
texts one row stays, whatever their doc_ids (null ones come first); rows of one doc_id are rows of their own;
texts of any length are read whole; an empty table gives no row; other columns, whatever
their names, are carried as they are up to the last stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.llm import ngram_join, packing, quality_rules, suffix_dedup
from textloom.llm import toxicity as toxic
from textloom.llm.common import cut, small_batches, table


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity score rejects go."""
    small_batches(spark)
    model = toxic.fit(docs, table(spark, sf_dir, "labels"))
    return model.score(docs, docs.columns, "toxicity of the row").filter(F.col("toxicity of the row") < toxic.THRESHOLD).select(*docs.columns)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return quality_rules.kept(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: the one of the smallest doc_id."""
    small_batches(spark)
    return ngram_join.representatives(docs)


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that also start earlier in the corpus are cut out; documents stay, if need be empty."""
    small_batches(spark)
    return suffix_dedup.kept_texts(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of ids with the corpus's mixture of sources."""
    small_batches(spark)
    return packing.pack(docs)


STAGES = [("toxicity", toxicity), ("quality_rules", quality), ("ngram_jaccard_join", near_copies), ("suffix_array_dedup", repeats), ("packing", packed)]

#: Learned scores, suffix arrays and token ids are beyond SQL; tests hold the pipeline against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; the last one's rows."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = cut(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
