"""Gate, rule, library and learning queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import concepts as C
from ..operators import gates as G
from ..operators import learning as L
from .cleaning import NL, W, _code
from .concepts import spark_query
from .registry import query

_list = lambda xs: "[" + ", ".join(f"'{x}'" for x in xs) + "]"
_code_x = _code.replace("line", "x")
U = f"""l AS (SELECT doc_id, max(quality) AS quality, max(toxic) AS toxic FROM labels GROUP BY doc_id),
u0 AS (SELECT d.doc_id AS unit_id, source AS concept, {_list(G.STAGES)}[d.doc_id % 5 + 1] AS stage, list_transform(string_split(text, {NL}), lambda x: trim(x, {W})) AS lines, (d.doc_id % 100) / 100.0::DOUBLE AS confidence, coalesce(toxic, 0) = 1 AS fallback, coalesce(quality, 1) AS quality, greatest(1, ceil(n_chars / 1000.0)) AS minutes FROM documents d LEFT JOIN l USING (doc_id)),
u AS (SELECT *, lines[1] AS definition, list_filter(lines[2:], lambda x: x <> '') AS points, list_filter(lines, lambda x: {_code_x} <> '') AS examples FROM u0)"""


def _band(n: str, low: int, high: int, a: int, b: int, inside: float) -> str:
    return f"CASE WHEN {n} < {low} THEN {n} / {low}.0::DOUBLE WHEN {n} > {high} THEN 0.5::DOUBLE WHEN {n} BETWEEN {a} AND {b} THEN 1.0::DOUBLE ELSE {inside}::DOUBLE END"


_size = "length(definition)"
_good = "len(list_filter(points, lambda p: length(p) >= 10)) / len(points)::DOUBLE"
CHECKS = {
    "definition_present": (f"{_size} > 0", f"({_size} > 0)::INT::DOUBLE"),
    "definition_length": (f"{_size} BETWEEN 100 AND 1000", f"CASE WHEN {_size} < 100 THEN {_size} / 100.0::DOUBLE WHEN {_size} > 1000 THEN 0.5::DOUBLE WHEN {_size} BETWEEN 150 AND 1000 THEN 1.0::DOUBLE WHEN {_size} < 150 THEN round(0.7::DOUBLE + 0.3::DOUBLE * ({_size} / 150.0::DOUBLE), 2) ELSE 0.8::DOUBLE END"),
    "points_count": ("len(points) BETWEEN 2 AND 10", _band("len(points)", 2, 10, 3, 7, 0.8)),
    "points_quality": (f"len(points) > 0 AND {_good} >= 0.7", f"CASE WHEN len(points) = 0 THEN 0.0::DOUBLE ELSE round({_good}, 2) END"),
    "examples_count": ("len(examples) BETWEEN 1 AND 5", _band("len(examples)", 1, 5, 1, 3, 0.9)),
    "minutes": ("minutes BETWEEN 5 AND 120", "(minutes BETWEEN 5 AND 120)::INT::DOUBLE"),
}
un = lambda t: G.units(t("documents"), t("labels"))
_mean = "round((" + " + ".join(f"({s})" for _, s in CHECKS.values()) + f") / {len(CHECKS)}, 6)"
_fails = "concat_ws(',', " + ", ".join(f"CASE WHEN NOT ({p}) THEN '{n}' END" for n, (p, _) in CHECKS.items()) + ")"
GATE = f"g AS (SELECT unit_id, {_mean} AS score, {_size} > 0 AND len(points) BETWEEN 2 AND 10 AND {_mean} >= 0.7 AS passed, {_fails} AS failures FROM u)"
query("gat1_concept_gate", f"WITH {U}, {GATE} SELECT * FROM g")(lambda t: G.concept_gate(un(t)))
query("gat2_top_failures", f"WITH {U}, {GATE}, f AS (SELECT unnest(string_split(failures, ',')) AS name FROM g), c AS (SELECT name AS check_name, count(*) AS units FROM f WHERE name <> '' GROUP BY name) SELECT check_name, units FROM c ORDER BY units DESC, check_name LIMIT 5")(
    lambda t: G.concept_gate(un(t)).select(F.explode(F.split("failures", ",")).alias("check_name")).filter("check_name <> ''").groupBy("check_name").agg(F.count("*").alias("units")).orderBy(F.desc("units"), "check_name").limit(5))
query("gat5_boilerplate", f"""WITH {U}, e AS (SELECT unit_id, unnest(list_concat([definition], points)) AS t FROM u), x AS (SELECT unit_id, lower(trim(t, {W})) AS text FROM e)
SELECT text, count(*) AS places, count(DISTINCT unit_id) AS units FROM x WHERE length(text) > 20 GROUP BY text HAVING count(*) >= 3""")(lambda t: G.boilerplate(un(t)))
query("gat6_library_ratios", f"""WITH {U}, c AS (SELECT concept, max((stage = 'L2_hint_plus_example')::INT) AS l2, max((stage = 'L3_explanation')::INT) AS l3 FROM u GROUP BY concept), f AS (SELECT avg(fallback::INT) AS fallback_ratio FROM u)
SELECT round(avg(l2), 6) AS l2_coverage, round(avg(l3), 6) AS l3_coverage, round(any_value(fallback_ratio), 6) AS fallback_ratio FROM c, f""")(
    lambda t: (lambda u: u.groupBy("concept").agg(F.max((F.col("stage") == "L2_hint_plus_example").cast("int")).alias("a"), F.max((F.col("stage") == "L3_explanation").cast("int")).alias("b"), F.sum(F.col("fallback").cast("int")).alias("f"), F.count("*").alias("n")).agg(F.round(F.avg("a"), 6).alias("l2_coverage"), F.round(F.avg("b"), 6).alias("l3_coverage"), F.round(F.sum("f") / F.sum("n"), 6).alias("fallback_ratio")))(un(t)))
query("dia1_stage_coverage", f"WITH {U}, s AS (SELECT concept, count(*) AS units, " + ", ".join(f"max((stage = '{x}')::INT) AS {x.lower()}" for x in G.STAGES) + " FROM u GROUP BY concept) SELECT *, " + " + ".join(x.lower() for x in G.STAGES) + f" = {len(G.STAGES)} AS complete FROM s")(lambda t: G.stage_coverage(un(t)))
query("dia2_stage_pivot", f"WITH {U} SELECT concept, " + ", ".join(f"count(*) FILTER (stage = '{x}') AS {x.lower()}" for x in G.STAGES) + " FROM u GROUP BY concept")(
    lambda t: (lambda p: p.select("concept", *(F.coalesce(F.col(x), F.lit(0)).alias(x.lower()) for x in G.STAGES)))(un(t).groupBy("concept").pivot("stage", G.STAGES).count()))
query("dia2_rollup", f"WITH {U} SELECT coalesce(concept, 'all') AS concept, coalesce(stage, 'all') AS stage, count(*) AS units FROM u GROUP BY ROLLUP (concept, stage)")(
    lambda t: un(t).rollup("concept", "stage").agg(F.count("*").alias("units")).select(F.coalesce("concept", F.lit("all")).alias("concept"), F.coalesce("stage", F.lit("all")).alias("stage"), "units"))
query("mrg5_integrity", "SELECT 'orphans' AS kind, count(*) AS rows FROM orders ANTI JOIN customer ON o_custkey = c_custkey UNION ALL SELECT 'unused', count(*) FROM customer ANTI JOIN orders ON o_custkey = c_custkey UNION ALL SELECT 'repeated', count(*) FROM (SELECT c_custkey FROM customer GROUP BY 1 HAVING count(*) > 1)")(
    lambda t: G.integrity(t("customer").select(F.col("c_custkey").alias("key")), t("orders").select(F.col("o_custkey").alias("key")), "key"))

H = """h0 AS (SELECT o_custkey AS learner, l_suppkey % 10 AS concept, l_returnflag <> 'R' AS correct, (l_quantity * 2)::DOUBLE AS seconds, o_orderdate, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_shipdate FROM orders JOIN lineitem ON o_orderkey = l_orderkey),
h AS (SELECT learner, concept, row_number() OVER (PARTITION BY learner, concept ORDER BY o_orderdate, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_shipdate) AS seq, correct, seconds FROM h0)"""
hi = lambda t: L.history(t("orders"), t("lineitem"))
_recent = f"{H}, k AS (SELECT *, row_number() OVER (PARTITION BY learner, concept ORDER BY seq DESC) AS k FROM h), r AS (SELECT learner, concept, avg(correct::INT) FILTER (k <= 3) AS rate, avg(seconds) FILTER (k <= 3) AS seconds, count(*) AS answers FROM k GROUP BY ALL)"
query("srs1_recent_success", f"WITH {_recent} SELECT learner, concept, round(rate, 9) AS rate, round(seconds, 9) AS seconds, answers FROM r")(lambda t: L.recent(hi(t)).select("learner", "concept", F.round("rate", 9).alias("rate"), F.round("seconds", 9).alias("seconds"), "answers"))
query("srs2_quality", f"WITH {_recent}, b AS (SELECT *, CASE WHEN rate >= 0.9 THEN 5 WHEN rate >= 0.7 THEN 4 WHEN rate >= 0.5 THEN 3 WHEN rate >= 0.3 THEN 2 WHEN rate > 0 THEN 1 ELSE 0 END AS base FROM r) SELECT learner, concept, CASE WHEN seconds < 30 THEN least(5, base + 1) WHEN seconds > 80 THEN greatest(0, base - 1) ELSE base END AS quality FROM b")(
    lambda t: L.recent(hi(t)).select("learner", "concept", L.quality(F.col("rate"), F.col("seconds")).alias("quality")))
query("srs3_schedule", f"""WITH RECURSIVE {H}, q AS (SELECT learner, concept, seq, CASE WHEN NOT correct THEN 1 WHEN seconds > 80 THEN 3 ELSE 5 END::DOUBLE AS q FROM h),
w AS (SELECT learner, concept, 0::BIGINT AS seq, 1.0::DOUBLE AS days, 2.5::DOUBLE AS ease, 0 AS reviews FROM q WHERE seq = 1
 UNION ALL SELECT q.learner, q.concept, q.seq, CASE WHEN q < 3 OR reviews = 0 THEN 1.0::DOUBLE WHEN reviews = 1 THEN 6.0::DOUBLE ELSE days * ease END, greatest(1.3::DOUBLE, ease + (0.1::DOUBLE - (5 - q) * (0.08::DOUBLE + (5 - q) * 0.02::DOUBLE))), CASE WHEN q < 3 THEN 0 ELSE reviews + 1 END
 FROM w JOIN q ON q.learner = w.learner AND q.concept = w.concept AND q.seq = w.seq + 1)
SELECT learner, concept, round(arg_max(days, seq), 6) AS days, round(arg_max(ease, seq), 6) AS ease, arg_max(reviews, seq) AS reviews FROM w GROUP BY learner, concept""")(lambda t: L.schedule(hi(t)))
query("srs5_round_robin", f"""WITH {H}, k AS (SELECT learner, concept, seq, row_number() OVER (PARTITION BY learner, concept ORDER BY seq) AS turn FROM h), p AS (SELECT *, row_number() OVER (PARTITION BY learner ORDER BY turn, concept) AS place FROM k) SELECT learner, place, concept, seq FROM p WHERE place <= 5""")(
    lambda t: L.round_robin(hi(t), "learner", "concept", ["seq"], 5).select("learner", "place", "concept", "seq"))
MASTER = f"{H}, m AS (SELECT learner, concept, count(*) AS attempts, sum(correct::INT)::BIGINT AS solved, round(avg(1 - seconds / 200), 6) AS confidence FROM h GROUP BY ALL), mastery AS (SELECT *, least(1.0::DOUBLE, round(solved * 0.1::DOUBLE, 6)) AS mastery FROM m)"
query("ltb1_mastery", f"WITH {MASTER} SELECT * FROM mastery")(lambda t: L.mastery(hi(t)))
query("ltb3_coverage", f"WITH {MASTER} SELECT learner, count(*) AS concepts, sum((mastery >= 0.7)::INT)::BIGINT AS mastered FROM mastery GROUP BY learner")(lambda t: L.mastery(hi(t)).groupBy("learner").agg(F.count("*").alias("concepts"), F.sum((F.col("mastery") >= 0.7).cast("int")).alias("mastered")))
_links = [(0, 1), (1, 2), (0, 3), (3, 4), (2, 5)]
spark_query("ltb2_blocked_concepts", f"WITH {MASTER}, e(src, dst) AS (VALUES {', '.join(map(str, _links))}), n AS (SELECT learner, src, dst FROM (SELECT DISTINCT learner FROM mastery), e) SELECT DISTINCT n.learner, dst AS concept FROM n LEFT JOIN mastery m ON m.learner = n.learner AND m.concept = n.src WHERE coalesce(mastery, 0.0) < 0.5")(
    lambda s, t: L.blocked(L.mastery(hi(t)), s.createDataFrame(_links, "src long, dst long")))
