"""Concept, graph and provenance queries."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import concepts as C
from ..operators.cleaning import pages
from .registry import QUERIES, query, table

CONCEPTS_SQL = "concepts(id, name, keywords, category, difficulty) AS (VALUES " + ", ".join(f"('{i}', '{n}', {k!r}, '{c}', '{d}')" for i, n, k, c, d in C.CONCEPTS) + ")"
EDGES_SQL = "edges(ord, src, dst, hard) AS (VALUES " + ", ".join(f"({i}, '{a}', '{b}', {str(h).lower()})" for i, (a, b, h) in enumerate(C.EDGES)) + ")"
ALIASES_SQL = "aliases(alias, target) AS (VALUES " + ", ".join(f"('{a}', '{b}')" for a, b in C.ALIASES) + ")"


def spark_query(name: str, oracle: str | None = None):
    """Like query(), for functions of (spark, tables)."""

    def add(fn):
        query(name, oracle)(lambda t: None)
        QUERIES[name] = lambda spark, sf_dir: fn(spark, lambda n: table(spark, sf_dir, n))
        return fn

    return add


# headings of the test corpus: words of part names, as SQL topics are not in the tables
_heads = "h AS (SELECT conv_id * 1000 + turn AS key, lower(string_split(text, chr(10))[1]) AS heading FROM conversations)"
_words = "list_distinct(list_filter(regexp_split_to_array(heading, '[^a-z]+'), lambda x: x <> ''))"
spark_query("con1_match_headings", f"""WITH {CONCEPTS_SQL}, {_heads}, p AS (SELECT key, id, heading, name, keywords, category, {_words} AS ws, string_split(name, ' ') AS nw FROM h, concepts),
s AS (SELECT key, id, CASE WHEN contains(heading, name) OR (contains(name, heading) AND heading <> '') THEN 0.95::DOUBLE ELSE 0.0::DOUBLE END AS n,
 CASE WHEN len(list_filter(keywords, lambda k: contains(heading, k))) > 0 THEN least(0.9::DOUBLE, 0.5::DOUBLE + 0.1::DOUBLE * len(list_filter(keywords, lambda k: contains(heading, k)))) ELSE 0.0::DOUBLE END AS k,
 CASE WHEN contains(heading, category) THEN 0.4::DOUBLE ELSE 0.0::DOUBLE END AS c, len(list_intersect(ws, nw))::DOUBLE / greatest(len(ws), len(nw)) AS sh FROM p),
g AS (SELECT *, CASE WHEN sh > 0.3 THEN least(0.7::DOUBLE, sh) ELSE 0.0::DOUBLE END AS f FROM s), b AS (SELECT *, greatest(n, k, c, f) AS confidence FROM g)
SELECT key, id, round(confidence, 9) AS confidence, CASE WHEN confidence = n THEN 'name' WHEN confidence = k THEN 'keyword' WHEN confidence = c THEN 'category' ELSE 'fuzzy' END AS how FROM b WHERE confidence > 0.3""")(
    lambda s, t: C.match_headings(t("conversations").select((F.col("conv_id") * 1000 + F.col("turn")).alias("key"), F.lower(F.element_at(F.split("text", "\n"), 1)).alias("heading")), C.registry(s)).withColumn("confidence", F.round("confidence", 9)))
spark_query("con5_registry_statistics", f"WITH {CONCEPTS_SQL} SELECT category, difficulty, count(*) AS concepts FROM concepts GROUP BY ALL")(lambda s, t: C.registry(s).groupBy("category", "difficulty").agg(F.count("*").alias("concepts")))
query("con6_chunks_for_pages", "WITH p AS (SELECT source AS doc, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS page, doc_id FROM documents), w AS (SELECT DISTINCT 'src' || (item_id % 20) AS doc, 1 + item_id % 7 AS page FROM benchmark) SELECT doc, page, doc_id FROM p SEMI JOIN w USING (doc, page)")(
    lambda t: pages(t("documents"), "doc_id").join(t("benchmark").select(F.concat(F.lit("src"), (F.col("item_id") % 20).cast("string")).alias("doc"), (1 + F.col("item_id") % 7).cast("int").alias("page")).distinct(), ["doc", "page"], "left_semi"))
query("con7_manifest", """WITH d AS (SELECT DISTINCT p_brand AS concept, p_size AS page FROM part), c AS (SELECT o_custkey % 50 + 1 AS page, o_orderkey AS chunk FROM orders)
SELECT concept, page, row_number() OVER (PARTITION BY concept ORDER BY page) AS position, count(*) AS chunks, min(chunk) AS first_chunk, max(chunk) AS last_chunk FROM d JOIN c USING (page) GROUP BY concept, page""")(
    lambda t: C.manifest(t("part").select(F.col("p_brand").alias("concept"), F.array(F.col("p_size").cast("long")).alias("pages")), t("orders").select((F.col("o_custkey") % 50 + 1).cast("long").alias("page"), F.col("o_orderkey").alias("chunk"))))
_raw = [i for i, *_ in C.CONCEPTS] + ["Group By", "inner_join", " window ", "joins", "grouping", "old-topic", "unknown"]
spark_query("con8_resolve_ids", f"""WITH {CONCEPTS_SQL}, {ALIASES_SQL}, r(raw) AS (VALUES {', '.join(f"('{x}')" for x in _raw)}), n AS (SELECT raw, regexp_replace(lower(trim(raw)), '[_\\s]+', '-', 'g') AS norm FROM r)
SELECT raw, coalesce(e.id, a.target, m.id) AS id, CASE WHEN e.id IS NOT NULL THEN 'exact' WHEN a.target IS NOT NULL THEN 'alias' WHEN m.id IS NOT NULL THEN 'normalised' ELSE 'none' END AS how
FROM n LEFT JOIN concepts e ON e.id = raw LEFT JOIN (SELECT alias, target FROM aliases WHERE target IN (SELECT id FROM concepts)) a ON a.alias = raw LEFT JOIN concepts m ON m.id = norm""")(
    lambda s, t: C.resolve(s.createDataFrame([(x,) for x in _raw], "raw string"), C.registry(s), s.createDataFrame(C.ALIASES, "alias string, to string")))
_closure = f"""RECURSIVE {EDGES_SQL}, walk AS (SELECT src, dst, 1 AS depth FROM edges UNION SELECT w.src, e.dst, w.depth + 1 FROM walk w JOIN edges e ON e.src = w.dst WHERE w.depth < 20)"""
spark_query("grf1_prerequisites", f"WITH {EDGES_SQL} SELECT dst AS concept, string_agg(src, ',' ORDER BY src) AS prerequisites, sum(hard::INT)::BIGINT AS hard FROM edges GROUP BY dst")(lambda s, t: C.edges(s).groupBy(F.col("dst").alias("concept")).agg(F.array_join(F.sort_array(F.collect_list("src")), ",").alias("prerequisites"), F.sum(F.col("hard").cast("int")).alias("hard")))
spark_query("grf2_shortest_paths", f"WITH {_closure} SELECT src, dst, min(depth) AS depth FROM walk GROUP BY src, dst")(lambda s, t: C.closure(C.edges(s)))
_hard = f"RECURSIVE {EDGES_SQL}, walk AS (SELECT src, dst, 1 AS depth FROM edges WHERE hard UNION SELECT w.src, e.dst, w.depth + 1 FROM walk w JOIN edges e ON e.src = w.dst WHERE e.hard AND w.depth < 20)"
spark_query("grf3_learning_order", f"WITH {_hard} SELECT src AS id, min(depth) AS depth FROM walk WHERE dst = 'recursion' GROUP BY src UNION ALL SELECT 'recursion', 0")(lambda s, t: C.learning_order(C.edges(s), "recursion"))
spark_query("grf6_links_between_units", f"WITH {EDGES_SQL}, u AS (SELECT DISTINCT ['select-basic', 'where-filter', 'order-by', 'aggregate', 'group-by', 'inner-join'][doc_id % 6 + 1] AS concept FROM documents) SELECT src, dst FROM edges WHERE src IN (SELECT concept FROM u) AND dst IN (SELECT concept FROM u)")(
    lambda s, t: C.shared_links(t("documents").select(F.element_at(F.array(*map(F.lit, ["select-basic", "where-filter", "order-by", "aggregate", "group-by", "inner-join"])), (F.col("doc_id") % 6 + 1).cast("int")).alias("concept")), C.edges(s)).select("src", "dst"))
spark_query("grf7_dangling_links", f"WITH {EDGES_SQL}, {ALIASES_SQL}, {CONCEPTS_SQL} SELECT alias, target FROM aliases ANTI JOIN concepts ON target = id")(lambda s, t: s.createDataFrame(C.ALIASES, "alias string, target string").join(C.registry(s), F.col("target") == F.col("id"), "left_anti"))
query("prv1_blocks_by_concept", "SELECT p_type AS concept, l_suppkey AS chunk FROM part JOIN lineitem ON p_partkey = l_partkey GROUP BY ALL")(
    lambda t: C.bridge(t("part").join(t("lineitem"), F.col("p_partkey") == F.col("l_partkey")).groupBy(F.col("p_type").alias("concept")).agg(F.collect_set("l_suppkey").alias("chunks"))))
query("prv3_merge_records", "SELECT p_brand AS concept, array_to_string(list_sort(list(DISTINCT p_size)), ',') AS pages, round(avg(p_retailprice), 6) AS confidence FROM part GROUP BY p_brand")(
    lambda t: C.merge_records(t("part").select(F.col("p_brand").alias("concept"), F.array("p_size").alias("pages"), F.col("p_retailprice").cast("double").alias("confidence"))).withColumn("pages", F.array_join("pages", ",")))
query("prv4_context_chunks", "SELECT source, doc_id, lag(doc_id) OVER w AS before, lead(doc_id) OVER w AS after FROM documents WINDOW w AS (PARTITION BY source ORDER BY doc_id::VARCHAR)")(
    lambda t: (lambda w: t("documents").select("source", "doc_id", F.lag("doc_id").over(w).alias("before"), F.lead("doc_id").over(w).alias("after")))(Window.partitionBy("source").orderBy(F.col("doc_id").cast("string"))))
query("mrg1_last_wins", "SELECT o_custkey, o_orderkey, o_totalprice FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS k FROM orders) WHERE k = 1")(
    lambda t: C.last_wins(t("orders"), "o_custkey", F.struct("o_orderdate", "o_orderkey")).select("o_custkey", "o_orderkey", "o_totalprice"))
query("mrg3_unit_ids", "SELECT doc_id, 'unit-' || substr(sha256(doc_id || ':' || source), 1, 16) AS unit_id, row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS source_order FROM documents")(
    lambda t: t("documents").select("doc_id", F.concat(F.lit("unit-"), F.substring(F.sha2(F.concat_ws(":", F.col("doc_id").cast("string"), "source").cast("binary"), 256), 1, 16)).alias("unit_id"), (F.row_number().over(Window.partitionBy("source").orderBy("doc_id")) - 1).alias("source_order")))
