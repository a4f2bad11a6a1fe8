"""Canonical exact digests of documents (native).

The canonical text is composed and compatibility-folded (NFKC), case-folded,
composed again and has its white space folded; normalisation and case folding
are those of the Unicode library that Spark ships, called inside the JVM. Its
fingerprint is two chained 64-bit xxhashes and its length; rows of one
fingerprint form a bucket, and within a bucket bytes decide: two texts are alike
(1.0) only if their canonical bytes are equal, otherwise not (0.0). An exact
digest knows no degrees.

Groups: buckets of one row are known from their counts; a bit table of the
others, of bounded size, leaves out the texts of (nearly) all single rows, and
what is left is grouped by fingerprint and canonical bytes, equal texts meeting
in the map tasks already, so a group of copies costs one text a task.

Defined results: a null text is empty; null doc_ids come first; rows of one
doc_id follow each other by a hash of the text; the only row is its own next
row; equal texts, empty ones too, are one class, named by its smallest non-null
doc_id (null if it has none); an empty table gives no row; extra columns are ignored, whatever
their names; texts of any length are read whole. The next document
is found by one range shuffle into buckets of near equal size, with a copy of
each bucket's first row as a fence after the one before, so no task sees the
whole table and texts move once.
"""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import cut, table

#: Buckets of the range shuffle: at least, at most (a bound of what the driver holds: two numbers each), and rows of one.
MIN_BUCKETS, MAX_BUCKETS, BUCKET_ROWS = 64, 1 << 18, 100_000
#: Words of 64 bits in the table of buckets with several rows: at least, at most. A table too small costs work, not results.
BIT_WORDS = (1 << 10, 1 << 20)
#: Rows of one class are dealt to so many tasks when they learn its name.
SALTS = 16


def _in_jvm(owner: str, method: str, text: Column, flag: bool) -> Column:
    return F.reflect(F.lit(owner), F.lit(method), text, F.lit(flag))


def canonical(text: Column) -> Column:
    """The canonical form of a text column without nulls."""
    composed = _in_jvm("com.ibm.icu.text.Normalizer", "compose", text, True)
    folded = _in_jvm("com.ibm.icu.text.Normalizer", "compose", _in_jvm("com.ibm.icu.lang.UCharacter", "foldCase", composed, True), True)
    return F.trim(F.regexp_replace(folded, r"[\s\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+", " "))


def digest(canon: Column) -> Column:
    """128 bits of xxhash, chained with different seeds, and the length in code points."""
    return F.concat_ws("-", F.lpad(F.hex(F.xxhash64(canon)), 16, "0"), F.lpad(F.hex(F.xxhash64(F.lit("second"), canon)), 16, "0"), F.length(canon).cast("string"))


def _rows(docs: DataFrame) -> DataFrame:
    """doc_id, id (never null), tie, text of every row."""
    rows = docs.select("doc_id", F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))).alias("id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    return rows.withColumn("tie", F.xxhash64("text"))


def _printed(rows: DataFrame) -> DataFrame:
    """rows with canon, fingerprint."""
    return rows.withColumn("canon", canonical(F.col("text"))).withColumn("fingerprint", digest(F.col("canon")))


def _bucket(bounds: list[int]) -> Column:
    """How many of the sorted bounds are at most id: first among every root-th of them, then between two of those."""
    step = max(1, math.isqrt(len(bounds)))
    parts = [bounds[k : k + step] for k in range(0, len(bounds), step)]
    heads = F.from_json(F.lit(json.dumps([p[0] for p in parts])), "array<bigint>")
    tails = F.from_json(F.lit(json.dumps(parts)), "array<array<bigint>>")
    at = F.size(F.filter(heads, lambda b: b <= F.col("id")))
    inside = F.size(F.filter(F.get(tails, at - 1), lambda b: b <= F.col("id")))
    return F.when(at > 0, (at - 1) * step + inside).otherwise(0).cast("int")


def _with_next(rows: DataFrame, finish) -> DataFrame:
    """finish(rows) with next_text and next_fingerprint, in order of (id, tie), the first after the last. rows: id, tie, text."""
    ids = rows.select("id")
    n = ids.count()
    buckets = max(MIN_BUCKETS, min(MAX_BUCKETS, n // BUCKET_ROWS))
    # at most MAX_BUCKETS numbers come to the driver
    found = ids.agg(F.percentile_approx("id", [k / buckets for k in range(1, buckets)], 20 * buckets).alias("b")).first()["b"] if n else None
    bounds = sorted(set(found or [0]))
    rows = rows.withColumn("bucket", _bucket(bounds))
    firsts = {r["bucket"]: (r["f"]["id"], r["f"]["tie"]) for r in rows.groupBy("bucket").agg(F.min(F.struct("id", "tie")).alias("f")).collect()}
    order = sorted(firsts)
    before = {b: order[k - 1] for k, b in enumerate(order)}
    # at most MAX_BUCKETS rows
    known = rows.sparkSession.createDataFrame([(i, t, before[b]) for b, (i, t) in firsts.items()], "id long, tie long, home int")
    fences = rows.join(F.broadcast(known), ["id", "tie"]).dropDuplicates(["id", "tie"]).withColumn("bucket", F.col("home")).drop("home").withColumn("fence", F.lit(1))
    both = finish(rows.withColumn("fence", F.lit(0)).unionByName(fences))
    w = Window.partitionBy("bucket").orderBy("fence", "id", "tie")
    both = both.withColumns({"next_text": F.lead("text").over(w), "next_fingerprint": F.lead("fingerprint").over(w)})
    return both.filter("fence = 0")


def groups(docs: DataFrame) -> DataFrame:
    """fingerprint, bytes (SHA-256 of the canonical text), class_id, copies of the canonical texts that several rows have."""
    rows = _rows(docs)
    prints = _printed(rows).select("fingerprint")
    several = cut(prints.groupBy("fingerprint").agg(F.count("*").alias("c")).filter("c > 1").select("fingerprint"), "buckets")
    words = min(BIT_WORDS[1], max(BIT_WORDS[0], 1 << (several.count() // 4).bit_length()))
    at = F.pmod(F.xxhash64("fingerprint"), F.lit(64 * words))
    # at most BIT_WORDS[1] rows
    bits = several.select(at.alias("h")).groupBy(F.shiftright("h", 6).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(h % 64 as int))")).alias("bits"))
    kept = _printed(rows).select("doc_id", "fingerprint", "canon").withColumn("h", at).withColumn("word", F.shiftright("h", 6))
    kept = kept.join(F.broadcast(bits), "word").filter(F.expr("shiftright(bits, cast(h % 64 as int)) % 2 <> 0"))
    # rows of one bucket are one class only if their bytes are equal
    classes = kept.groupBy("fingerprint", "canon").agg(F.min("doc_id").alias("class_id"), F.count("*").alias("copies")).filter("copies > 1")
    return classes.select("fingerprint", F.sha2(F.col("canon").cast("binary"), 256).alias("bytes"), "class_id", "copies")


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next, class_id, copies (rows of the class)."""
    rows = _with_next(_rows(docs), lambda both: _printed(both).withColumn("bytes", F.sha2(F.col("canon").cast("binary"), 256)).drop("canon")).withColumn("n_chars", F.length("text").cast("long"))
    half = F.floor(F.col("n_chars") / 2).cast("int")
    rows = rows.withColumn("edited", F.concat(F.substr("text", F.lit(1), F.col("n_chars").cast("int") - half), F.substr("next_text", F.lit(1), half)))
    rows = rows.withColumn("edited_canon", canonical(F.col("edited"))).withColumn("edited_fingerprint", digest(F.col("edited_canon")))
    # equal buckets only: then bytes are compared
    same_edited = F.when(F.col("fingerprint") == F.col("edited_fingerprint"), canonical(F.col("text")) == F.col("edited_canon")).otherwise(F.lit(False))
    same_next = F.when(F.col("fingerprint") == F.col("next_fingerprint"), canonical(F.col("text")) == canonical(F.col("next_text"))).otherwise(F.lit(False))
    out = rows.select("doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"), "fingerprint", "edited_fingerprint", same_edited.cast("double").alias("near_edited"), same_next.cast("double").alias("near_next"),
                      "bytes", F.pmod(F.xxhash64("id", "tie"), F.lit(SALTS)).cast("int").alias("salt"))
    classes = cut(groups(docs), "classes").withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    named = out.join(classes.hint("merge"), ["fingerprint", "bytes", "salt"], "left")
    return named.select("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next", F.when(F.col("copies").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"), F.coalesce("copies", F.lit(1)).cast("long").alias("copies"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(table(spark, sf_dir, "documents"))
