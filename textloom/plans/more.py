"""Further queries: routing parts, reports, sessions, registries."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import quality as Q
from ..functions import text as X
from ..operators import cleaning as CL
from ..operators import concepts as C
from ..operators import gates as G
from ..operators import sqltext as S
from ..operators import traces as T
from ..operators.cleaning import pages
from .cleaning import NL, _bleed, _cov, _pages, gib_sql, per_document, rx
from .concepts import CONCEPTS_SQL, EDGES_SQL, spark_query
from .gates import H, U, hi, un
from .registry import query, sql_text
from .sqltext import V as SNIPPETS
from .traces import DECIDED, ESC, STATE, n, tr


def _words_sql(t: str) -> str:
    for p, to in X.SCAN_WORDS:
        t = rx(t, "(?i)" + p, to)
    return t


per_document("cln15_scanned_words", X.mend_scanned_words, _words_sql("text"))
query("cln16_column_repeats")(lambda t: t("documents").select("doc_id", X.drop_column_repeats(F.col("text")).alias("result")))
per_document("cln15_tidy_format", X.tidy_format, rx(rx(rx("text", r"\n{3,}", "\n\n"), r"[ \t]{2,}", " "), r"\n[\s\x0b]*[-—][\s\x0b]*\n", "\n"))
per_document("cln21_tidy_chunk", X.tidy_chunk, f"trim({rx(rx('text', '[ \\t]+', ' '), '\\n{3,}', chr(10) * 2)}, (' ' || chr(9) || chr(10) || chr(13) || chr(12) || chr(11)))")
query("qlt9_validation", f"SELECT doc_id, ({_cov}) >= 0.7 AND length(text) >= 50 AS passed, concat_ws(',', CASE WHEN ({_cov}) < 0.7 THEN 'coverage_too_low' END, CASE WHEN length(text) < 50 THEN 'too_few_chars' END) AS fail_reasons FROM documents")(
    lambda t: t("documents").select("doc_id", Q.coverage(F.col("text")).alias("c"), F.length("text").alias("n")).select("doc_id", ((F.col("c") >= 0.7) & (F.col("n") >= 50)).alias("passed"), F.concat_ws(",", F.when(F.col("c") < 0.7, "coverage_too_low"), F.when(F.col("n") < 50, "too_few_chars")).alias("fail_reasons")))
query("qlt13_strategy", f"WITH b AS ({_bleed}), s AS (SELECT doc_id, {_cov} AS c, length(text) AS n, len(string_split(text, '|')) - 1 AS tables_, bleed FROM documents JOIN b USING (doc_id)) SELECT doc_id, CASE WHEN n = 0 OR c < 0.30 THEN 'ocr' WHEN tables_ > 10 AND bleed > 0.3 THEN 'layout' ELSE 'direct' END AS strategy FROM s")(
    lambda t: t("documents").select("doc_id", Q.coverage(F.col("text")).alias("c"), F.length("text").alias("n"), (F.size(F.split("text", r"\|", -1)) - 1).alias("k"), Q.column_bleed(F.col("text")).alias("b")).select("doc_id", F.when((F.col("n") == 0) | (F.col("c") < 0.30), "ocr").when((F.col("k") > 10) & (F.col("b") > 0.3), "layout").otherwise("direct").alias("strategy")))
query("qlt14_preflight", f"WITH p AS ({_pages}), c AS (SELECT doc, {_cov} AS c, {gib_sql('text', Q.MORE_GIBBERISH)} AS g FROM p) SELECT doc, count(*) AS pages, round(avg(c), 9) AS coverage, sum((c < 0.7)::INT)::BIGINT AS low_pages, sum(g)::BIGINT AS gibberish FROM c GROUP BY doc")(
    lambda t: CL.pages(t("documents")).select("doc", Q.coverage(F.col("text")).alias("c"), Q.gibberish_count(F.col("text"), Q.MORE_GIBBERISH).alias("g")).groupBy("doc").agg(F.count("*").alias("pages"), F.round(F.avg("c"), 9).alias("coverage"), F.sum((F.col("c") < 0.7).cast("int")).alias("low_pages"), F.sum("g").alias("gibberish")))
query("qlt18_page_decisions", f"WITH p AS ({_pages}), c AS (SELECT doc, page, {_cov} AS c FROM p) SELECT doc, string_agg(page::VARCHAR, ',' ORDER BY page) AS pages FROM c WHERE c < 0.7 GROUP BY doc")(
    lambda t: CL.pages(t("documents")).filter(Q.coverage(F.col("text")) < 0.7).groupBy("doc").agg(F.array_join(F.sort_array(F.collect_list("page")), ",").alias("pages")))
query("aud5_title_keywords", f"WITH k AS (SELECT doc_id, list_distinct(list_filter(regexp_extract_all(lower(string_split(text, {NL})[1] || ' ' || source), '[a-z]{{4,}}'), lambda x: x NOT IN ({', '.join(map(sql_text, Q.TITLE_STOP_WORDS))}))) AS kw FROM documents) SELECT doc_id, array_to_string(list_sort(kw), ' ') AS keywords FROM k")(
    lambda t: t("documents").select("doc_id", F.array_join(F.array_sort(Q.title_keywords(F.element_at(F.split("text", "\n"), 1), F.col("source"))), " ").alias("keywords")))

# --- traces ------------------------------------------------------------------------
query("rpl3_summary", f"WITH {STATE} {DECIDED} SELECT policy_id, d.action AS action, count(*) AS events, count(DISTINCT trace_id) AS traces, round(count(*) / sum(count(*)) OVER (PARTITION BY policy_id)::DOUBLE, 4) AS share FROM decided GROUP BY policy_id, d.action")(
    lambda t: (lambda g: g.withColumn("share", F.round(F.col("events") / F.sum("events").over(Window.partitionBy("policy_id")), 4)))(T.decide(T.learner_state(tr(t))).groupBy("policy_id", "action").agg(F.count("*").alias("events"), F.count_distinct("trace_id").alias("traces"))))
query("rpl4_per_learner", f"WITH {STATE} {DECIDED} SELECT split_part(trace_id, '-w', 1) AS learner, policy_id, {n("d.action <> 'wait'")} AS escalations, {n(ESC)} AS own_requests, max(consecutive_errors) AS longest_run FROM decided GROUP BY ALL")(
    lambda t: T.decide(T.learner_state(tr(t))).groupBy(F.split_part("trace_id", F.lit("-w"), F.lit(1)).alias("learner"), "policy_id").agg(F.sum((F.col("action") != "wait").cast("int")).alias("escalations"), F.sum(T.is_escalation().cast("int")).alias("own_requests"), F.max("consecutive_errors").alias("longest_run")))

# --- learning -----------------------------------------------------------------------
query("srs4_due_concepts", f"WITH {H}, l AS (SELECT learner, concept, count(*) AS answers, arg_max(correct, seq) AS last_correct FROM h GROUP BY ALL), d AS (SELECT *, row_number() OVER (PARTITION BY learner ORDER BY answers, concept) AS k FROM l WHERE NOT last_correct) SELECT learner, concept, k FROM d WHERE k <= 4")(
    lambda t: hi(t).groupBy("learner", "concept").agg(F.count("*").alias("answers"), F.max_by("correct", "seq").alias("c")).filter("not c").withColumn("k", F.row_number().over(Window.partitionBy("learner").orderBy("answers", "concept"))).filter("k <= 4").select("learner", "concept", "k"))
query("srs6_statistics", f"WITH {H} SELECT concept, count(*) AS answers, count(DISTINCT learner) AS learners, round(avg(correct::INT), 6) AS rate, max(seconds) AS slowest FROM h GROUP BY concept")(
    lambda t: hi(t).groupBy("concept").agg(F.count("*").alias("answers"), F.count_distinct("learner").alias("learners"), F.round(F.avg(F.col("correct").cast("double")), 6).alias("rate"), F.max("seconds").alias("slowest")))
query("ltb4_saved_units", "SELECT o_custkey AS learner, l_partkey AS unit, min(o_orderdate) AS saved FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY ALL")(
    lambda t: t("orders").join(t("lineitem"), F.col("o_orderkey") == F.col("l_orderkey")).groupBy(F.col("o_custkey").alias("learner"), F.col("l_partkey").alias("unit")).agg(F.min("o_orderdate").alias("saved")))

# --- curated coverage: sources of documents that no supplier stands for
query("dia4_orphan_sources", "SELECT DISTINCT source FROM documents WHERE source NOT IN (SELECT 'src' || s_suppkey FROM supplier)")(
    lambda t: t("documents").select("source").distinct().join(t("supplier").select(F.concat(F.lit("src"), F.col("s_suppkey").cast("string")).alias("source")), "source", "left_anti"))

# --- concepts and SQL ------------------------------------------------------------------
spark_query("con12_topic_suggestions", f"""WITH {CONCEPTS_SQL}, d AS (SELECT conv_id, turn, list_distinct(list_filter(regexp_split_to_array(lower(text), '[^a-z]+'), lambda x: x <> '')) AS w FROM conversations), s AS (SELECT conv_id, turn, id, len(list_intersect(w, keywords)) AS hits FROM d, concepts)
SELECT * FROM (SELECT conv_id, turn, id, hits, row_number() OVER (PARTITION BY conv_id, turn ORDER BY hits DESC, id) AS rank FROM s WHERE hits > 0) WHERE rank <= 5""")(
    lambda s, t: t("conversations").select("conv_id", "turn", F.array_distinct(F.filter(F.split(F.lower("text"), "[^a-z]+"), lambda x: x != "")).alias("w")).crossJoin(F.broadcast(C.registry(s).select("id", "keywords"))).select("conv_id", "turn", "id", F.size(F.array_intersect("w", "keywords")).alias("hits")).filter("hits > 0")
    .withColumn("rank", F.row_number().over(Window.partitionBy("conv_id", "turn").orderBy(F.desc("hits"), "id"))).filter("rank <= 5"))
spark_query("grf5_graph_statistics", f"WITH {EDGES_SQL}, n AS (SELECT src AS id FROM edges UNION SELECT dst FROM edges) SELECT id, (SELECT count(*) FROM edges WHERE src = id) AS downstream, (SELECT count(*) FROM edges WHERE dst = id) AS prerequisites FROM n")(
    lambda s, t: (lambda e: e.select(F.col("src").alias("id"), F.lit(1).alias("d"), F.lit(0).alias("p")).union(e.select("dst", F.lit(0), F.lit(1))).groupBy("id").agg(F.sum("d").alias("downstream"), F.sum("p").alias("prerequisites")))(C.edges(s)))
spark_query("grf9_backbone", f"WITH {CONCEPTS_SQL}, bank(concept, m) AS (VALUES {', '.join(f"('{c}', '{m}')" for m, c, _, _ in S.MISCONCEPTIONS)}), {SNIPPETS} SELECT c.id, coalesce(string_agg(DISTINCT b.m, ',' ORDER BY b.m), '') AS misconceptions, count(DISTINCT v.id) AS snippets FROM concepts c LEFT JOIN bank b ON b.concept = c.id LEFT JOIN v ON v.concept = c.id GROUP BY c.id")(
    lambda s, t: C.registry(s).select("id").join(s.createDataFrame([(c, m) for m, c, _, _ in S.MISCONCEPTIONS], "id string, m string"), "id", "left").join(S.snippets(s).select(F.col("concept").alias("id"), F.col("id").alias("v")), "id", "left").groupBy("id").agg(F.array_join(F.sort_array(F.collect_set("m")), ",").alias("misconceptions"), F.count_distinct("v").alias("snippets")))
spark_query("sql2_batch_summary", f"WITH {SNIPPETS}, k AS (SELECT concept, trim(coalesce(sql, '')) AS s FROM v) SELECT concept, count(*) AS snippets, sum((s <> '' AND ends_with(s, ';'))::INT)::BIGINT AS closed FROM k GROUP BY concept")(
    lambda s, t: S.snippets(s).select("concept", F.trim(F.coalesce("sql", F.lit(""))).alias("s")).groupBy("concept").agg(F.count("*").alias("snippets"), F.sum(((F.col("s") != "") & F.endswith("s", F.lit(";"))).cast("int")).alias("closed")))
spark_query("mis3_remediation_path", f"WITH {EDGES_SQL}, bank(concept, m) AS (VALUES {', '.join(f"('{c}', '{m}')" for m, c, _, _ in S.MISCONCEPTIONS)}) SELECT m AS misconception, concept, coalesce(string_agg(src, ',' ORDER BY src), '') AS first FROM bank LEFT JOIN edges ON dst = concept AND hard GROUP BY ALL")(
    lambda s, t: s.createDataFrame([(m, c) for m, c, _, _ in S.MISCONCEPTIONS], "misconception string, concept string").join(C.edges(s).filter("hard").select("src", F.col("dst").alias("concept")), "concept", "left").groupBy("misconception", "concept").agg(F.array_join(F.sort_array(F.collect_list("src")), ",").alias("first")))
query("mrg2_concept_map", "SELECT source AS concept, doc_id AS chunk_id, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS position FROM documents")(
    lambda t: pages(t("documents"), "doc_id").select(F.col("doc").alias("concept"), F.col("doc_id").alias("chunk_id"), F.col("page").alias("position")))
query("snk5_markdown", f"SELECT source, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS position, '## ' || doc_id || {NL} || string_split(text, {NL})[1] AS section FROM documents")(
    lambda t: pages(t("documents").select("source", "doc_id", F.concat(F.lit("## "), F.col("doc_id").cast("string"), F.lit("\n"), F.element_at(F.split("text", "\n"), 1)).alias("section")), "section").select(F.col("doc").alias("source"), F.col("page").alias("position"), "section"))
query("snk8_html_tables", "SELECT n_nationkey AS id, '<tr><td>' || n_name || '</td><td>' || r_name || '</td></tr>' AS html FROM nation JOIN region ON n_regionkey = r_regionkey")(
    lambda t: t("nation").join(F.broadcast(t("region")), F.col("n_regionkey") == F.col("r_regionkey")).select(F.col("n_nationkey").alias("id"), F.concat(F.lit("<tr><td>"), "n_name", F.lit("</td><td>"), "r_name", F.lit("</td></tr>")).alias("html")))
