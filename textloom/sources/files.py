"""Readers and writers: page texts, traces, unit libraries, index files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as X

PAGE_MARK = r"\n?<!-- page (\d+) -->\n"
TRACE_SCHEMA = """schema_version string, trace_id string, learner_id string, session_id string, is_synthetic boolean,
events array<struct<event_id: string, timestamp: string, learner_id: string, session_id: string, problem_id: string, concept_id: string, event_type: string, error_subtype: string,
attempt_index: int, hint_count: int, escalation_level: string, time_since_start: double, time_since_last_action: double, time_stuck: double, note_text: string>>"""


def discover(spark: SparkSession, path: str, suffix: str = ".pdf") -> DataFrame:
    """path, bytes, sha256 of all files below a folder with a suffix."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", f"*{suffix}").load(path)
    return files.select("path", F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"))


def pages_of_markdown(files: DataFrame) -> DataFrame:
    """doc_id, page, text of whole markdown files (doc_id, text): page marks part the pages, a text without marks is page 1."""
    numbers = F.concat(F.array(F.lit(1)), F.transform(F.regexp_extract_all("text", F.lit(PAGE_MARK), F.lit(1)), lambda x: x.cast("int")))
    parts = F.split("text", PAGE_MARK, -1)
    rows = files.select("doc_id", F.explode(F.arrays_zip(numbers.alias("page"), parts.alias("text"))).alias("p"))
    return rows.select("doc_id", "p.page", "p.text").filter(X.strip(F.col("text")) != "")


def read_pages(spark: SparkSession, path: str, first: int | None = None, last: int | None = None) -> DataFrame:
    """Pages of all text and markdown files below a folder; bounds are 1-based and inclusive."""
    if first is not None and last is not None and (first < 1 or last < first):
        raise ValueError(f"no pages from {first} to {last}")
    files = spark.read.text(path, wholetext=True, recursiveFileLookup=True).select(F.input_file_name().alias("doc_id"), F.col("value").alias("text"))
    rows = pages_of_markdown(files)
    if first is not None:
        rows = rows.filter(F.col("page") >= first)
    return rows if last is None else rows.filter(F.col("page") <= last)


def read_traces(spark: SparkSession, path: str, by_line: bool = False) -> DataFrame:
    """One row per event of all trace files below a folder, seq from 1; a file (or, by_line, a line) that is no JSON is left out."""
    found = spark.read.schema(TRACE_SCHEMA).option("multiLine", str(not by_line).lower()).option("mode", "DROPMALFORMED").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.json").json(path)
    rows = found.select("trace_id", F.posexplode("events").alias("pos", "e"))
    return rows.select("trace_id", (F.col("pos") + 1).alias("seq"), "e.*")


def read_units(spark: SparkSession, path: str, concept: str | None = None) -> DataFrame:
    """The units of an exported library; a concept prunes to its folder."""
    rows = spark.read.parquet(f"{path}/units")
    return rows if concept is None else rows.filter(F.col("concept") == concept)


def write_library(path: str, units: DataFrame, links: DataFrame) -> None:
    """Units by concept, links, and a manifest of counts."""
    units.write.mode("overwrite").partitionBy("concept").parquet(f"{path}/units")
    links.write.mode("overwrite").json(f"{path}/links")
    units.agg(F.count("*").alias("units"), F.count_distinct("concept").alias("concepts")).write.mode("overwrite").json(f"{path}/manifest")


def write_index(path: str, chunks: DataFrame) -> str:
    """Chunks by document and a manifest; the index id is a digest of all chunk ids and texts, whatever their order."""
    chunks.write.mode("overwrite").parquet(f"{path}/chunks")
    each = chunks.select(F.sha2(F.concat_ws("\x1f", F.col("doc_id").cast("string"), F.col("n").cast("string"), "text").cast("binary"), 256).alias("h"))
    sums = each.agg(F.count("*").alias("chunks"), F.sum(F.conv(F.substring("h", 1, 15), 16, 10).cast("decimal(38,0)")).alias("s"))
    manifest = sums.select("chunks", F.substring(F.sha2(F.concat_ws(":", F.col("chunks").cast("string"), F.col("s").cast("string")).cast("binary"), 256), 1, 16).alias("index_id"))
    manifest.write.mode("overwrite").json(f"{path}/manifest")
    return chunks.sparkSession.read.json(f"{path}/manifest").first()["index_id"]


def write_csv(path: str, rows: DataFrame) -> None:
    """Rows with a header in every file."""
    rows.write.mode("overwrite").csv(path, header=True)
