"""Document structure: typed blocks, headings, hierarchy, chapters and relevance."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as X
from .cleaning import lines

# Our own patterns that tell what a block of a textbook is.
ADMIN = r"(?i)\b(copyright|all rights reserved|licensed under|isbn|published by|acknowledg)"
EXERCISE = r"(?i)^\s*(exercise|problem|question)s?\b"
FIGURE = r"(?i)^\s*(figure|fig\.|table)\s+\d+"
SUMMARY = r"(?i)^\s*(summary|key points|in this chapter)\b"
NUMBERED = r"^\s*\d+(\.\d+)*\.?\s+\S"
TABLE_GAPS = r"\S {3,}\S"
LABELS = ["admin", "heading", "code", "table", "exercise", "figure", "summary", "prose"]


def heading_level(line: Column) -> Column:
    """Dots of a section number plus one, at most 4; 1 for a short line that ends no sentence; null for no heading."""
    number = F.regexp_extract(line, r"^\s*(\d+(?:\.\d+)*)", 1)
    words = F.size(X.words(line))
    dots = F.length(number) - F.length(F.replace(number, F.lit("."), F.lit("")))
    return F.when((words <= 15) & F.rlike(line, F.lit(NUMBERED)), F.least(F.lit(4), dots + 1)).when((words <= 6) & (words >= 1) & ~F.rlike(line, F.lit(r"[.!?:;,]\s*$")) & F.rlike(line, F.lit(r"^\s*\p{Lu}")), 1)


def block_kind(line: Column) -> Column:
    """The first kind that applies, in the order of LABELS."""
    gaps = F.regexp_count(line, F.lit(TABLE_GAPS))
    pipes = F.length(line) - F.length(F.replace(line, F.lit("|"), F.lit("")))
    return (
        F.when(F.rlike(line, F.lit(ADMIN)), "admin")
        .when(heading_level(line).isNotNull(), "heading")
        .when(X.code_kind(line) == "sql", "code")
        .when((pipes >= 2) | (gaps >= 2), "table")
        .when(F.rlike(line, F.lit(EXERCISE)), "exercise")
        .when(F.rlike(line, F.lit(FIGURE)), "figure")
        .when(F.rlike(line, F.lit(SUMMARY)), "summary")
        .otherwise("prose")
    )


def blocks(docs: DataFrame) -> DataFrame:
    """doc_id, pos, line, kind, level: one block per line that is not blank."""
    rows = lines(docs).filter(X.strip(F.col("line")) != "")
    return rows.select("doc_id", "pos", "line", block_kind(F.col("line")).alias("kind"), heading_level(F.col("line")).alias("level")).withColumn("level", F.when(F.col("kind") == "heading", F.col("level")))


def hierarchy(rows: DataFrame) -> DataFrame:
    """doc_id, pos, parent: a heading hangs below the nearest earlier heading of a smaller level, all else below the last heading.

    Levels are at most 4, so the last place of each level so far is four windows, no self join.
    """
    w = Window.partitionBy("doc_id").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    last = {k: F.last(F.when(F.col("level") == k, F.col("pos")), ignorenulls=True).over(w) for k in range(1, 5)}
    rows = rows.withColumns({f"last{k}": c for k, c in last.items()})
    under = F.lit(None).cast("int")
    for level in range(2, 5):
        under = F.when(F.col("level") == level, F.greatest(*(F.col(f"last{k}") for k in range(1, level)), F.lit(None).cast("int"))).otherwise(under)
    any_heading = F.greatest(*(F.col(f"last{k}") for k in range(1, 5)))
    return rows.select("doc_id", "pos", F.when(F.col("level").isNull(), any_heading).otherwise(under).alias("parent"))


def chapters(rows: DataFrame) -> DataFrame:
    """doc_id, first_pos, last_pos, title: level-one headings, each up to the next (the last up to its own place)."""
    tops = rows.filter("level = 1")
    w = Window.partitionBy("doc_id").orderBy("pos")
    return tops.select("doc_id", F.col("pos").alias("first_pos"), F.coalesce(F.lead("pos").over(w) - 1, F.col("pos")).alias("last_pos"), F.col("line").alias("title"))


def distinct_headings(rows: DataFrame) -> DataFrame:
    """Headings whose text differs from the heading before, or that stand more than one place behind it."""
    w = Window.partitionBy("doc_id").orderBy("pos")
    heads = rows.filter("kind = 'heading'").withColumns({"before": F.lag("line").over(w), "gap": F.col("pos") - F.lag("pos").over(w)})
    return heads.filter(F.col("before").isNull() | (F.col("before") != F.col("line")) | (F.col("gap") > 1)).select("doc_id", "pos", "line")


def near_matches(rows: DataFrame, keyword: str, reach: int = 2) -> DataFrame:
    """doc_id, pos of blocks that hold a keyword or have one within `reach` blocks."""
    w = Window.partitionBy("doc_id").orderBy("pos").rowsBetween(-reach, reach)
    return rows.withColumn("near", F.max(F.contains(F.lower("line"), F.lit(keyword))).over(w)).filter("near").select("doc_id", "pos")


def relevance(line: Column, kind: Column, keyword: str) -> Column:
    """Ten at most: keyword occurrences per word, double in headings, half more in code."""
    low = F.lower(line)
    hits = (F.length(low) - F.length(F.replace(low, F.lit(keyword), F.lit("")))) / len(keyword)
    factor = F.when(kind == "heading", 2.0).when(kind == "code", 1.5).otherwise(1.0)
    return F.least(F.lit(1.0), 10 * hits / F.greatest(F.size(X.words(line)), F.lit(1)) * factor)


def top_blocks(rows: DataFrame, keyword: str, k: int = 5) -> DataFrame:
    """doc_id, rank, pos, score: the k most relevant blocks of each document, ties in order."""
    scored = rows.withColumn("score", relevance(F.col("line"), F.col("kind"), keyword)).filter("score > 0")
    w = Window.partitionBy("doc_id").orderBy(F.desc("score"), "pos")
    return scored.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k).select("doc_id", "rank", "pos", "score")
