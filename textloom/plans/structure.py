"""Structure queries over documents' lines and pages' headings."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as X
from ..operators import structure as S
from .cleaning import NL, W, _code
from .registry import query, sql_text

_words = "len(list_filter(regexp_split_to_array(line, '[\\s\\x0b]+'), lambda x: x <> ''))"
_level = f"""CASE WHEN {_words} <= 15 AND regexp_matches(line, {sql_text(S.NUMBERED)}) THEN least(4, length(regexp_extract(line, '^\\s*(\\d+(?:\\.\\d+)*)', 1)) - length(replace(regexp_extract(line, '^\\s*(\\d+(?:\\.\\d+)*)', 1), '.', '')) + 1)
 WHEN {_words} <= 6 AND {_words} >= 1 AND NOT regexp_matches(line, '[.!?:;,]\\s*$') AND regexp_matches(line, '^\\s*\\p{{Lu}}') THEN 1 END"""
_kind = f"""CASE WHEN regexp_matches(line, {sql_text(S.ADMIN)}) THEN 'admin' WHEN lv IS NOT NULL THEN 'heading' WHEN code = 'sql' THEN 'code' WHEN length(line) - length(replace(line, '|', '')) >= 2 OR len(regexp_extract_all(line, {sql_text(S.TABLE_GAPS)})) >= 2 THEN 'table'
 WHEN regexp_matches(line, {sql_text(S.EXERCISE)}) THEN 'exercise' WHEN regexp_matches(line, {sql_text(S.FIGURE)}) THEN 'figure' WHEN regexp_matches(line, {sql_text(S.SUMMARY)}) THEN 'summary' ELSE 'prose' END"""
B = f"""l AS (SELECT doc_id, unnest(string_split(text, {NL})) AS line, generate_subscripts(string_split(text, {NL}), 1)::INT - 1 AS pos FROM documents),
m AS (SELECT *, {_level} AS lv, {_code} AS code FROM l WHERE trim(line, {W}) <> ''), k AS (SELECT *, {_kind} AS kind FROM m), b AS (SELECT doc_id, pos, line, kind, CASE WHEN kind = 'heading' THEN lv END::INT AS level FROM k)"""
bl = lambda t: S.blocks(t("documents"))

query("str1_block_kinds", f"WITH {B} SELECT doc_id, pos, kind, level FROM b")(lambda t: bl(t).select("doc_id", "pos", "kind", "level"))
query("str1_kind_counts", f"WITH {B} SELECT kind, count(*) AS blocks, count(DISTINCT doc_id) AS docs FROM b GROUP BY kind")(lambda t: bl(t).groupBy("kind").agg(F.count("*").alias("blocks"), F.count_distinct("doc_id").alias("docs")))
query("str7_hierarchy", f"""WITH {B} SELECT x.doc_id, x.pos, max(h.pos) AS parent FROM b x LEFT JOIN b h ON h.doc_id = x.doc_id AND h.pos < x.pos AND h.level IS NOT NULL AND (x.level IS NULL OR h.level < x.level) GROUP BY x.doc_id, x.pos""")(lambda t: S.hierarchy(bl(t)))
query("str8_content_filter", f"WITH {B} SELECT doc_id, pos, CASE WHEN kind = 'admin' THEN 'admin' WHEN length(trim(line, {W})) < 5 THEN 'too_short' WHEN kind IN ('figure', 'exercise') THEN kind ELSE 'kept' END AS reason FROM b")(
    lambda t: bl(t).select("doc_id", "pos", F.when(F.col("kind") == "admin", "admin").when(F.length(X.strip(F.col("line"))) < 5, "too_short").when(F.col("kind").isin("figure", "exercise"), F.col("kind")).otherwise("kept").alias("reason")))
query("str9_evidence_spans", f"""WITH {B} SELECT doc_id, pos FROM (SELECT doc_id, pos, max(CASE WHEN contains(lower(line), 'license') THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING) AS near FROM b) WHERE near = 1""")(lambda t: S.near_matches(bl(t), "license"))
query("str12_top_blocks", f"""WITH {B}, s AS (SELECT doc_id, pos, least(1.0::DOUBLE, 10 * ((length(lower(line)) - length(replace(lower(line), 'the', ''))) / 3.0::DOUBLE) / greatest({_words}, 1) * CASE kind WHEN 'heading' THEN 2.0::DOUBLE WHEN 'code' THEN 1.5::DOUBLE ELSE 1.0::DOUBLE END) AS score FROM b)
SELECT * FROM (SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, pos) AS rank, pos, round(score, 9) AS score FROM s WHERE score > 0) WHERE rank <= 5""")(lambda t: S.top_blocks(bl(t), "the").withColumn("score", F.round("score", 9)))
query("str14_chapters", f"WITH {B}, h AS (SELECT * FROM b WHERE level = 1) SELECT doc_id, pos AS first_pos, coalesce(lead(pos) OVER (PARTITION BY doc_id ORDER BY pos) - 1, pos) AS last_pos, line AS title FROM h")(lambda t: S.chapters(bl(t)))
query("str15_blocks_by_chapter", f"""WITH {B}, h AS (SELECT * FROM b WHERE level = 1), c AS (SELECT doc_id, pos AS a, coalesce(lead(pos) OVER (PARTITION BY doc_id ORDER BY pos) - 1, pos) AS z FROM h)
SELECT c.doc_id, c.a AS first_pos, count(*) AS blocks FROM c JOIN b ON b.doc_id = c.doc_id AND b.pos BETWEEN c.a AND c.z GROUP BY c.doc_id, c.a""")(
    lambda t: S.chapters(bl(t)).alias("c").join(bl(t).select(F.col("doc_id").alias("d"), "pos"), (F.col("doc_id") == F.col("d")) & F.col("pos").between(F.col("first_pos"), F.col("last_pos"))).groupBy("doc_id", "first_pos").agg(F.count("*").alias("blocks")))
query("str18_distinct_headings", f"WITH {B}, h AS (SELECT *, lag(line) OVER w AS before, pos - lag(pos) OVER w AS gap FROM b WHERE kind = 'heading' WINDOW w AS (PARTITION BY doc_id ORDER BY pos)) SELECT doc_id, pos, line FROM h WHERE before IS NULL OR before <> line OR gap > 1")(lambda t: S.distinct_headings(bl(t)))
_ws = "list_distinct(list_filter(regexp_split_to_array(lower({0}), '[\\s\\x0b]+'), lambda x: x <> ''))"
query("str32_jaccard", f"""WITH d AS (SELECT doc_id, {_ws.format('text')} AS a, {_ws.format(f"string_split(text, {NL})[1]")} AS b FROM documents)
SELECT doc_id, CASE WHEN len(a) = 0 OR len(b) = 0 THEN 0.0::DOUBLE ELSE len(list_intersect(a, b))::DOUBLE / len(list_distinct(list_concat(a, b))) END AS similarity FROM d""")(lambda t: t("documents").select("doc_id", X.jaccard(F.col("text"), F.element_at(F.split("text", "\n"), 1)).alias("similarity")))
