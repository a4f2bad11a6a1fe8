"""Streams, run to the end of what there is, and the sources' forms of the tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..sources import files
from ..streaming import traces as S
from .registry import ORACLES, QUERIES, query

QUERIES["stream_hourly_counts"] = lambda spark, d: S.run_once(S.hourly_counts(S.read_events(spark, d)), "complete").select(F.col("window.start").cast("timestamp_ntz").alias("hour"), "event_type", "events", F.round("value", 4).alias("value"))
ORACLES["stream_hourly_counts"] = "SELECT date_trunc('hour', ts) AS hour, event_type, count(*) AS events, round(sum(value), 4) AS value FROM events GROUP BY ALL"
QUERIES["stream_error_runs"] = lambda spark, d: S.run_once(S.error_runs(S.read_events(spark, d)), "update").groupBy("user_id").agg(*(F.max_by(c, "batch").alias(c) for c in ("events", "errors", "longest_run", "current_run", "solved")))
ORACLES["stream_error_runs"] = """
WITH g AS (SELECT *, sum(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS grp FROM events),
r AS (SELECT user_id, grp, count(*) AS n, sum((event_type = 'error')::INT)::BIGINT AS run, sum((event_type = 'purchase')::INT)::BIGINT AS solved FROM g GROUP BY ALL)
SELECT user_id, sum(n)::BIGINT AS events, sum(run)::BIGINT AS errors, max(run) AS longest_run, arg_max(run, grp) AS current_run, sum(solved)::BIGINT AS solved FROM r GROUP BY user_id"""
query("src9_markdown_pages", """
SELECT source AS doc_id, d.doc_id + 1 AS page, d.text FROM documents d WHERE trim(d.text) <> ''
""")(lambda t: files.pages_of_markdown(
    t("documents").select("source", "doc_id", "text").groupBy("source").agg(F.sort_array(F.collect_list(F.struct("doc_id", "text"))).alias("l")).select(F.col("source").alias("doc_id"), F.array_join(F.transform("l", lambda x: F.concat(F.lit("\n<!-- page "), (x["doc_id"] + 1).cast("string"), F.lit(" -->\n"), x["text"])), "").alias("text"))))
