"""Queries over SQL snippets, and more concept, hint and unit queries."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import concepts as C
from ..operators import gates as G
from ..operators import sqltext as S
from .cleaning import NL, W
from .concepts import EDGES_SQL, spark_query
from .gates import GATE, U, un
from .registry import query, sql_text
from .structure import B as BLOCKS
from .structure import bl

V = "v(id, sql, concept) AS (VALUES " + ", ".join(f"({i}, {'NULL' if s is None else sql_text(s)}, '{c}')" for i, s, c in S.SNIPPETS) + ")"
_t = f"t AS (SELECT id, trim(coalesce(sql, ''), {W}) AS s, concept FROM v)"
_kind = "CASE " + " ".join(f"WHEN starts_with(upper(s), '{a}') THEN '{b}'" for a, b in S.KINDS.items()) + " END"
_faults = ", ".join(f"CASE WHEN regexp_matches(s, {sql_text(p)}) THEN '{n}' END" for n, p in S.FAULTS.items())
spark_query("sql1_validate_snippets", f"""WITH {V}, {_t}, k AS (SELECT id, s, upper(s) AS u, {_kind} AS kind FROM t),
r AS (SELECT id, kind, CASE WHEN s = '' THEN 'empty' WHEN kind IS NULL THEN 'unknown_statement' ELSE concat_ws(',', CASE WHEN NOT ends_with(s, ';') THEN 'no_semicolon' END, CASE WHEN len(string_split(s, '(')) <> len(string_split(s, ')')) THEN 'parentheses' END, {_faults},
 CASE WHEN kind = 'SELECT' AND NOT contains(u, 'FROM') THEN 'no_from' END, CASE WHEN kind = 'INSERT' AND NOT contains(u, 'INTO') THEN 'no_into' END, CASE WHEN kind = 'INSERT' AND NOT contains(u, 'VALUES') AND NOT contains(u, 'SELECT') THEN 'no_values' END, CASE WHEN kind = 'UPDATE' AND NOT contains(u, 'SET') THEN 'no_set' END) END AS issues,
 CASE WHEN s = '' OR kind IS NULL THEN '' ELSE concat_ws(',', CASE WHEN regexp_matches(s, '(?i);\\s*DROP\\s+') THEN 'dangerous' END, CASE WHEN kind = 'SELECT' AND regexp_matches(u, 'SELECT\\s+\\*') THEN 'select_star' END, CASE WHEN kind IN ('UPDATE', 'DELETE') AND NOT contains(u, 'WHERE') THEN 'all_rows' END) END AS warnings FROM k)
SELECT id, kind, issues = '' AS is_valid, issues, warnings FROM r""")(lambda s, t: S.validate(S.snippets(s)))
_bank = "bank(misconception, concept, ord, p) AS (VALUES " + ", ".join(f"('{m}', '{c}', {o}, {sql_text(p)})" for m, c, o, p in S.MISCONCEPTIONS) + ")"
spark_query("mis1_misconception_scan", f"WITH {V}, {_bank} SELECT v.id, bank.misconception, bank.concept, bank.ord FROM v JOIN bank ON regexp_matches(coalesce(sql, ''), p)")(lambda s, t: S.scan_misconceptions(S.snippets(s)))
spark_query("mis2_coverage", f"WITH {V}, {_bank}, h AS (SELECT bank.concept, bank.misconception, v.id FROM bank LEFT JOIN v ON regexp_matches(coalesce(sql, ''), p)) SELECT concept, count(DISTINCT misconception) AS patterns, count(DISTINCT CASE WHEN id IS NOT NULL THEN misconception END) AS seen, count(id) AS hits FROM h GROUP BY concept")(
    lambda s, t: s.createDataFrame([(m, c) for m, c, _, _ in S.MISCONCEPTIONS], "m string, concept string").join(S.scan_misconceptions(S.snippets(s)).select(F.col("misconception").alias("m"), "id"), "m", "left").groupBy("concept").agg(F.count_distinct("m").alias("patterns"), F.count_distinct(F.when(F.col("id").isNotNull(), F.col("m"))).alias("seen"), F.count("id").alias("hits")))
_keys = "keys(a, b, c, d) AS (VALUES " + ", ".join(map(str, S.FOREIGN_KEYS)) + ")"
spark_query("sql5_join_conditions", f"""WITH {V}, {_keys}, f AS (SELECT DISTINCT id, regexp_replace(lower(unnest(regexp_extract_all(coalesce(sql, ''), '(?i)\\bON\\s+(\\w+\\.\\w+\\s*=\\s*\\w+\\.\\w+)', 1))), '\\s', '', 'g') AS condition FROM v),
k AS (SELECT a || '.' || b || '=' || c || '.' || d AS k FROM keys UNION ALL SELECT c || '.' || d || '=' || a || '.' || b FROM keys) SELECT id, condition, k IS NOT NULL AS is_key FROM f LEFT JOIN k ON condition = k""")(lambda s, t: S.join_checks(S.snippets(s), s.createDataFrame(S.FOREIGN_KEYS, "a string, b string, c string, d string")))
spark_query("sql7_tables_used", f"WITH {V} SELECT DISTINCT id, unnest(regexp_extract_all(lower(coalesce(sql, '')), '\\b(?:from|join)\\s+(\\w+)', 1)) AS \"table\" FROM v")(lambda s, t: S.tables_used(S.snippets(s)))
_rw = "coalesce(sql, '')"
for _a, _b in S.RENAMES:
    _rw = f"regexp_replace({_rw}, '(?i)\\b{_a}\\b', '{_b}', 'g')"
spark_query("sql8_rewrite", f"WITH {V}, r AS (SELECT id, trim(regexp_replace({_rw}, '\\s+', ' ', 'g')) AS r FROM v) SELECT id, CASE WHEN r = '' THEN '' WHEN ends_with(r, ';') THEN r ELSE r || ';' END AS sql FROM r")(lambda s, t: S.snippets(s).select("id", S.rewrite(F.coalesce("sql", F.lit(""))).alias("sql")))
# RE2's word border knows ASCII only, so the oracle takes whole words
_function_words = ", ".join(sql_text(w) for w in S.FUNCTION_WORDS.split("(?:")[1].split(")")[0].split("|"))
query("aud10_prose_share", f"""WITH l AS (SELECT doc_id, list_filter(list_transform(string_split(text, {NL}), lambda x: trim(x, {W})), lambda x: x <> '') AS l FROM documents)
SELECT doc_id, CASE WHEN len(l) > 0 THEN len(list_filter(l, lambda x: len(list_filter(regexp_extract_all(lower(x), '[\\p{{L}}\\p{{N}}_]+'), lambda y: y IN ({_function_words}))) >= 3))::DOUBLE / len(l) ELSE 0.0::DOUBLE END AS share FROM l""")(lambda t: t("documents").select("doc_id", S.prose_share(F.col("text")).alias("share")))

# --- concepts ---------------------------------------------------------------------
_kw = ["license", "version", "token", "reserved"]
_weights = {"heading": 2.0, "code": 1.3, "prose": 1.0, "figure": 0.8, "table": 0.6, "exercise": 0.5, "summary": 0.5, "admin": 0.3}
_hits = " + ".join(f"contains(lower(line), '{k}')::INT" for k in _kw)
_weight = "CASE kind " + " ".join(f"WHEN '{k}' THEN {v}::DOUBLE" for k, v in _weights.items()) + " END"


def _mapped(t):
    hits = sum((F.contains(F.lower("line"), F.lit(k)).cast("int") for k in _kw), F.lit(0))
    weight = F.create_map(*(F.lit(x) for kv in _weights.items() for x in kv))[F.col("kind")]
    scored = bl(t).select("doc_id", "pos", (hits / len(_kw) * weight).alias("score")).filter("score > 0.05")
    return scored.withColumn("rank", F.row_number().over(Window.partitionBy("doc_id").orderBy(F.desc("score"), "pos"))).filter("rank <= 15").select("doc_id", "rank", "pos", F.round("score", 9).alias("score"))


query("con9_weighted_mapping", f"WITH {BLOCKS}, s AS (SELECT doc_id, pos, ({_hits}) / {len(_kw)}.0::DOUBLE * {_weight} AS score FROM b) SELECT * FROM (SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, pos) AS rank, pos, round(score, 9) AS score FROM s WHERE score > 0.05) WHERE rank <= 15")(_mapped)
spark_query("con4_related_concepts", f"WITH {EDGES_SQL}, m(id) AS (VALUES ('group-by'), ('subquery')), r AS (SELECT e.src AS id, 0.35::DOUBLE AS confidence FROM edges e JOIN m ON e.dst = m.id UNION ALL SELECT e.dst, 0.4::DOUBLE FROM edges e JOIN m ON e.src = m.id) SELECT id, max(confidence) AS confidence FROM r ANTI JOIN m USING (id) GROUP BY id")(
    lambda s, t: (lambda e, m: e.join(m, e.dst == m.id).select(F.col("src").alias("id"), F.lit(0.35).alias("confidence")).union(e.join(m, e.src == m.id).select("dst", F.lit(0.4))).join(m, "id", "left_anti").groupBy("id").agg(F.max("confidence").alias("confidence")))(C.edges(s), s.createDataFrame([("group-by",), ("subquery",)], "id string")))
_terms = ["select", "from", "where", "join", "table", "the", "order", "by", "in", "and"]
_sql = "least(1.0::DOUBLE, (" + " + ".join(f"contains(lower(text), '{k}')::INT" for k in _terms) + ") / 10.0::DOUBLE)"
query("con11_relevance", f"WITH s AS (SELECT doc_id, {_sql} AS k, contains(lower(text), 'license')::INT + regexp_matches(text, '(?i)all rights reserved')::INT + contains(text, '###')::INT AS other FROM documents) SELECT doc_id, round(CAST(greatest(0.0::DOUBLE, least(1.0::DOUBLE, k * 0.3::DOUBLE + k * 0.5::DOUBLE - least(0.5::DOUBLE, other * 0.1::DOUBLE))) AS DECIMAL(18, 9)), 2)::DOUBLE AS score FROM s")(
    lambda t: t("documents").select("doc_id", F.least(F.lit(1.0), sum((F.contains(F.lower("text"), F.lit(k)).cast("int") for k in _terms), F.lit(0)) / 10).alias("k"), (F.contains(F.lower("text"), F.lit("license")).cast("int") + F.rlike("text", F.lit("(?i)all rights reserved")).cast("int") + F.contains("text", F.lit("###")).cast("int")).alias("other"))
    .select("doc_id", F.round(F.round(F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.col("k") * F.lit(0.3) + F.col("k") * F.lit(0.5) - F.least(F.lit(0.5), F.col("other") * F.lit(0.1)))), 9), 2).alias("score")))
query("con14_page_ranges", f"""WITH {BLOCKS}, h AS (SELECT doc_id, pos, level FROM b WHERE level IS NOT NULL)
SELECT h.doc_id, h.pos, coalesce(least(min(n.pos) - 1, h.pos + 10), h.pos + 3) AS last_pos FROM h LEFT JOIN h n ON n.doc_id = h.doc_id AND n.pos > h.pos AND n.level <= h.level GROUP BY h.doc_id, h.pos""")(
    lambda t: (lambda h: h.select("doc_id", "pos", "level").join(h.select(F.col("doc_id").alias("d"), F.col("pos").alias("np"), F.col("level").alias("nl")), (F.col("doc_id") == F.col("d")) & (F.col("np") > F.col("pos")) & (F.col("nl") <= F.col("level")), "left").groupBy("doc_id", "pos").agg(F.min("np").alias("n")).select("doc_id", "pos", F.coalesce(F.least(F.col("n") - 1, F.col("pos") + 10), F.when(F.col("n").isNull(), F.col("pos") + 3)).alias("last_pos")))(bl(t).filter("level is not null")))
spark_query("grf8_readiness", f"WITH {EDGES_SQL}, k(id) AS (VALUES ('select-basic'), ('where-filter'), ('aggregate')) SELECT dst AS concept, bool_and(src IN (SELECT id FROM k)) AS is_ready FROM edges WHERE hard GROUP BY dst")(
    lambda s, t: C.edges(s).filter("hard").groupBy(F.col("dst").alias("concept")).agg(F.collect_set("src").alias("need")).select("concept", (F.size(F.array_except("need", F.array(*map(F.lit, ["select-basic", "where-filter", "aggregate"])))) == 0).alias("is_ready")))
query("prv2_records_of_chunks", "SELECT l_orderkey AS chunk_set, array_to_string(list_sort(list(DISTINCT p_size)), ',') AS pages FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY l_orderkey")(
    lambda t: t("lineitem").join(t("part"), F.col("l_partkey") == F.col("p_partkey")).groupBy(F.col("l_orderkey").alias("chunk_set")).agg(F.array_join(F.array_sort(F.collect_set("p_size")), ",").alias("pages")))

# --- units ---------------------------------------------------------------------------


def _bands(c, steps, least):
    out = F.lit(least)
    for n, s in reversed(steps):
        out = F.when(c >= n, s).otherwise(out)
    return out


_band_sql = lambda c, steps, least: "CASE " + " ".join(f"WHEN {c} >= {n} THEN {s}::DOUBLE" for n, s in steps) + f" ELSE {least}::DOUBLE END"
_d, _w, _e = [(100, 1.0), (50, 0.7), (20, 0.4)], [(80, 1.0), (40, 0.7), (20, 0.4)], [(200, 1.0), (100, 0.7), (50, 0.4)]
query("dia5_explanation_quality", f"WITH {U} SELECT unit_id, round(({_band_sql('length(definition)', _d, 0.1)} + {_band_sql('length(coalesce(points[1], ' + chr(39) * 2 + '))', _w, 0.1)} + {_band_sql('length(array_to_string(points, ' + chr(39) + ' ' + chr(39) + '))', _e, 0.2)} + CASE WHEN len(examples) > 0 THEN 1.0::DOUBLE ELSE 0.5::DOUBLE END) / 4, 6) AS score FROM u")(
    lambda t: un(t).select("unit_id", F.round((_bands(F.length("definition"), _d, 0.1) + _bands(F.length(F.coalesce(F.get("points", F.lit(0)), F.lit(""))), _w, 0.1) + _bands(F.length(F.array_join("points", " ")), _e, 0.2) + F.when(F.size("examples") > 0, 1.0).otherwise(0.5)) / 4, 6).alias("score")))
query("gck_check_pass_rates", f"WITH {U}, {GATE}, n AS (SELECT count(*) AS n FROM g), f AS (SELECT unnest(string_split(failures, ',')) AS check_name FROM g) SELECT check_name, count(*) AS failed, round(1 - count(*) / any_value(n)::DOUBLE, 6) AS pass_rate FROM f, n WHERE check_name <> '' GROUP BY check_name")(
    lambda t: (lambda g: g.select(F.explode(F.split("failures", ",")).alias("check_name")).filter("check_name <> ''").groupBy("check_name").agg(F.count("*").alias("failed")).crossJoin(F.broadcast(g.agg(F.count("*").alias("n")))).select("check_name", "failed", F.round(1 - F.col("failed") / F.col("n"), 6).alias("pass_rate")))(G.concept_gate(un(t))))
query("hnt1_hint_payloads", """WITH u AS (SELECT DISTINCT user_id, last_value(event_type) OVER w AS last_type, count(*) FILTER (event_type = 'error') OVER w AS errors FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING))
SELECT user_id, CASE last_type WHEN 'click' THEN 'L1' WHEN 'view' THEN 'L2' WHEN 'error' THEN 'L3' ELSE 'L1' END AS level, errors > 0 AS eligible FROM u""")(
    lambda t: t("events").groupBy("user_id").agg(F.max_by("event_type", F.struct("ts", "event_id")).alias("k"), F.sum((F.col("event_type") == "error").cast("int")).alias("e")).select("user_id", F.when(F.col("k") == "click", "L1").when(F.col("k") == "view", "L2").when(F.col("k") == "error", "L3").otherwise("L1").alias("level"), (F.col("e") > 0).alias("eligible")))
