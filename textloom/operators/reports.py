"""Reports, plans and small derivations: what a processing run plans, measures and hands on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import quality as Q
from ..functions import text as X

# Words that no keyword of a concept is, and what broken extraction leaves in a block.
KEYWORD_STOP_WORDS = ["the", "a", "an", "and", "or", "in", "on", "at", "to", "for"]
SUSPICIOUS = [r"[_\-]{3,}", r"[\^\*@#%&]{2,}", r"[^\p{L}\p{N}_\s.,;:!?\-'\"()\[\]{}]"]
# What is no SQL teaching text, as (pattern, replacement).
NOT_SQL = [
    (r"(?s)```(?:java|javascript|js|perl|python)\s*\n.*?```", ""), (r"import\s+java\.[a-z.]+;?", ""), (r"public\s+(?:static\s+)?(?:void|class|String)\s+[\p{L}\p{N}_]+", ""), (r"(?s)HTTP\s+protocol.*?(?:\n\n|\z)", "\n\n"),
    (r"(?s)HTML\s+form.*?(?:\n\n|\z)", "\n\n"), (r"Figure\s+\d+[-.]\d+.*?(?:\n|$)", "\n"), (r"Exercise\s+\d+\.\d+.*?(?:\n|$)", "\n"),
]
#: A part of a synthetic trace's events, by profile: errors and hints of a hundred.
PROFILES = {"fast": (10, 15), "average": (25, 45), "struggling": (45, 80)}


def keywords(concept: Column) -> Column:
    """Words of a concept's id but stop words, and the whole as a phrase if it has several."""
    words = F.split(F.lower(concept), r"[-_\s]")
    kept = F.filter(words, lambda w: (w != "") & ~w.isin(KEYWORD_STOP_WORDS))
    return F.when(F.size(words) >= 2, F.array_append(kept, F.array_join(words, " "))).otherwise(kept)


def block_confidence(text: Column, font_size: Column) -> Column:
    """1 less what small type and suspicious characters cost."""
    small = F.when(font_size < 6, 0.3).when(font_size < 8, 0.15).otherwise(0.0)
    odd = sum((Q.matches(text, p) for p in SUSPICIOUS), F.lit(0))
    return F.greatest(F.lit(0.0), F.lit(1.0) - small - F.when(F.length(text) > 0, F.least(F.lit(0.5), 5 * odd / F.length(text))).otherwise(0.0))


def section(markdown: Column, name: str) -> Column:
    """The stripped text below `## name` up to the next `##`; empty without one."""
    return X.strip(F.regexp_extract(markdown, rf"(?ims)^##\s+{name}\s*\n(.*?)(?=^##|\z)", 1))


def drop_other_content(text: Column) -> Column:
    """A text without code of other languages, web references, figures and exercises."""
    for pattern, to in NOT_SQL:
        text = F.regexp_replace(text, pattern, to)
    return X.strip(text)


def group_coverage(rows: DataFrame, by: str, least: float = Q.MIN_COVERAGE) -> DataFrame:
    """by, pages, total_chars, coverage, meets_threshold of the texts of a group joined by line ends: no pattern holds one, so sums over the parts."""
    parts = rows.select(by, F.length("text").alias("n"), Q.readable_chars(F.col("text")).alias("good"), Q.gibberish_count(F.col("text"), Q.MORE_GIBBERISH).alias("bad"))
    sums = parts.groupBy(by).agg(F.count("n").alias("pages"), (F.sum("n") + F.count("n") - 1).alias("total_chars"), (F.sum("good") + F.count("n") - 1).alias("good"), F.sum("bad").alias("bad"))
    covered = F.greatest(F.lit(0.0), Q.share(F.col("good"), F.col("total_chars")) - 2 * Q.share(F.col("bad"), F.col("total_chars")))
    return sums.select(by, "pages", "total_chars", covered.alias("coverage"), (covered >= least).alias("meets_threshold"))


def memory_plan(pages: Column, words: int = 500, size: int = 180, overlap: int = 30, dim: int = 24) -> dict[str, Column]:
    """Chunks and megabytes that so many pages take, and the settings for so large a document."""
    step = max(1, size - overlap)
    chunks = pages * max(1, (words - size) // step + 1)
    mb = 1024.0 * 1024.0
    large, huge = pages > 500, pages > 1000
    total = pages * words * 6 / mb + chunks * dim * 8 / mb + chunks * 200 / mb + pages * 0.01
    return {"chunks": chunks, "megabytes": total, "batch": F.when(huge, 2000).otherwise(1000), "embedding_batch": F.when(huge, 500).otherwise(1000), "streaming_write": large, "compact": huge}


def synthetic_events(spark: SparkSession, traces: int, events: int, seed: int = 42) -> DataFrame:
    """trace_id, seq, profile, event_type, problem_id, t: made-up traces, the same for a seed, each row from its number alone."""
    names = list(PROFILES)
    rows = spark.range(traces).select(F.col("id").alias("trace_id"), F.explode(F.sequence(F.lit(1).cast("long"), F.lit(events).cast("long"))).alias("seq"))
    draw = ((F.col("trace_id") * 7919 + F.col("seq") * 104729 + seed) * 31 + (F.col("seq") * F.col("trace_id")) % 97) % 100
    profile = F.element_at(F.array(*map(F.lit, names)), (F.col("trace_id") % len(names) + 1).cast("int"))
    rows = rows.withColumns({"profile": profile, "draw": draw})
    kind = F.lit("problem_solved")
    for name, (errors, hints) in PROFILES.items():
        kind = F.when((F.col("profile") == name) & (F.col("draw") < errors), "error_recorded").when((F.col("profile") == name) & (F.col("draw") < hints), "hint_requested").otherwise(kind)
    return rows.select("trace_id", "seq", "profile", kind.alias("event_type"), ((F.col("seq") - 1) / 5).cast("long").alias("problem_id"), (F.col("seq") * 30 + F.col("draw")).alias("t"))


def block_mapping(chunks: DataFrame, blocks: DataFrame, preview: int = 100) -> DataFrame:
    """doc_id, n, pos: blocks whose first `preview` characters stand in a chunk of their document, whatever their case."""
    b = blocks.select(F.col("doc_id").alias("d"), "pos", F.lower(F.substring("line", 1, preview)).alias("preview")).filter("preview <> ''")
    c = chunks.select("doc_id", "n", F.lower("text").alias("low"))
    return c.join(b, F.col("doc_id") == F.col("d")).filter(F.contains("low", F.col("preview"))).select("doc_id", "n", "pos")


def evaluation(chunks: DataFrame, quality: DataFrame, coverage: float, least: float = 0.75) -> DataFrame:
    """metric, value, passed of an index: chunks, documents, mean quality, concept coverage, overall."""
    counts = chunks.agg(F.count("*").cast("double").alias("chunks"), F.count_distinct("doc_id").cast("double").alias("documents"))
    rows = counts.crossJoin(quality.agg(F.avg("quality").alias("quality"))).withColumn("coverage", F.lit(coverage)).withColumn("overall", (F.col("quality") + F.col("coverage")) / 2)
    return rows.select(F.explode(F.array(*(F.struct(F.lit(m).alias("metric"), F.round(m, 6).alias("value"), (F.col(m) >= (least if m in ("quality", "coverage", "overall") else 1)).alias("passed")) for m in ("chunks", "documents", "quality", "coverage", "overall")))).alias("m")).select("m.*")
