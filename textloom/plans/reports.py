"""Report, planning and round-trip queries."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..functions import quality as Q
from ..operators import concepts as C
from ..operators import reports as R
from ..operators import structure as S
from ..operators import traces as T
from ..operators.retrieval import chunk_quality
from ..sources import files
from ..sources.shared import shared_dir
from .cleaning import NL, W, _read, gib_sql
from .concepts import CONCEPTS_SQL, EDGES_SQL, spark_query
from .registry import ORACLES, query, sql_text
from .retrieval import CHUNKS, _cq, ch
from .structure import B, bl
from .traces import tr

docs = lambda t: t("documents")
_stop = ", ".join(f"'{w}'" for w in R.KEYWORD_STOP_WORDS)


def _folder(df, name: str) -> str:
    return f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"


# --- chunks, index, evaluation -------------------------------------------------------
query("chk3_page_words", f"WITH {CHUNKS} SELECT 'd' || doc_id || ':p1:c' || n AS chunk_id, text FROM chunks")(
    lambda t: ch(t).select(F.concat(F.lit("d"), F.col("doc_id").cast("string"), F.lit(":p1:c"), F.col("n").cast("string")).alias("chunk_id"), "text"))
query("chk4_block_mapping", f"WITH {CHUNKS}, {B}, k2 AS (SELECT doc_id, pos, lower(substr(line, 1, 100)) AS preview FROM b) SELECT c.doc_id, c.n, pos FROM chunks c JOIN k2 ON k2.doc_id = c.doc_id AND preview <> '' AND contains(lower(c.text), preview)")(lambda t: R.block_mapping(ch(t), bl(t)))
query("chk5_learning_chunks", f"WITH {CHUNKS} SELECT doc_id, n, length(text) AS size FROM chunks")(lambda t: ch(t).select("doc_id", "n", F.length("text").alias("size")))
query("chk8_memory_plan", """WITH p AS (SELECT source, count(*) AS pages FROM documents GROUP BY source) SELECT source, pages, pages * 3 AS chunks,
 round(pages * 500 * 6 / 1048576.0::DOUBLE + pages * 3 * 24 * 8 / 1048576.0::DOUBLE + pages * 3 * 200 / 1048576.0::DOUBLE + pages * 0.01::DOUBLE, 6) AS megabytes, CASE WHEN pages > 1000 THEN 2000 ELSE 1000 END AS batch, CASE WHEN pages > 1000 THEN 500 ELSE 1000 END AS embedding_batch, pages > 500 AS streaming_write, pages > 1000 AS compact FROM p""")(
    lambda t: (lambda p, plan: p.select("source", "pages", *((F.round(c, 6) if n == "megabytes" else c).alias(n) for n, c in plan.items())))(docs(t).groupBy("source").agg(F.count("*").alias("pages")), R.memory_plan(F.col("pages"))))
query("evl4_evaluation", f"""WITH {CHUNKS}, m AS (SELECT count(*)::DOUBLE AS chunks, count(DISTINCT doc_id)::DOUBLE AS documents, avg({_cq}) AS quality, 0.8::DOUBLE AS coverage FROM chunks), o AS (SELECT *, (quality + coverage) / 2 AS overall FROM m)
SELECT 'chunks' AS metric, round(chunks, 6) AS value, chunks >= 1 AS passed FROM o UNION ALL SELECT 'documents', round(documents, 6), documents >= 1 FROM o UNION ALL SELECT 'quality', round(quality, 6), quality >= 0.75 FROM o UNION ALL SELECT 'coverage', coverage, coverage >= 0.75 FROM o UNION ALL SELECT 'overall', round(overall, 6), overall >= 0.75 FROM o""")(
    lambda t: R.evaluation(ch(t), chunk_quality(ch(t).withColumn("v", F.array(F.lit(1.0)))), 0.8))

# --- structure, concepts, graph --------------------------------------------------------
_odd = " + ".join(f"len(regexp_extract_all(line, {sql_text(p)}))" for p in R.SUSPICIOUS)
query("str6_block_confidence", f"WITH {B} SELECT doc_id, pos, round(greatest(0.0::DOUBLE, 1.0::DOUBLE - CASE WHEN pos % 11 < 6 THEN 0.3::DOUBLE WHEN pos % 11 < 8 THEN 0.15::DOUBLE ELSE 0.0::DOUBLE END - least(0.5::DOUBLE, 5 * ({_odd}) / length(line)::DOUBLE)), 9) AS confidence FROM b")(
    lambda t: bl(t).select("doc_id", "pos", F.round(R.block_confidence(F.col("line"), F.col("pos") % 11), 9).alias("confidence")))
_kw = "string_split(replace(replace(lower(id), '_', '-'), ' ', '-'), '-')"
spark_query("str10_keywords", f"WITH {CONCEPTS_SQL}, k AS (SELECT id, {_kw} AS ws FROM concepts) SELECT id, array_to_string(list_concat(list_filter(ws, lambda w: w <> '' AND w NOT IN ({_stop})), CASE WHEN len(ws) >= 2 THEN [array_to_string(ws, ' ')] ELSE [] END), ',') AS keywords FROM k")(
    lambda s, t: C.registry(s).select("id", F.array_join(R.keywords(F.col("id")), ",").alias("keywords")))
query("str13_evidence_map", f"WITH {B}, w(word) AS (VALUES ('license'), ('copyright'), ('the')) SELECT word AS concept, doc_id, pos, substr(line, 1, 200) AS preview FROM b JOIN w ON contains(lower(line), word)")(
    lambda t: bl(t).select(F.explode(F.array(*map(F.lit, ["license", "copyright", "the"]))).alias("concept"), "doc_id", "pos", "line").filter(F.contains(F.lower("line"), F.col("concept"))).select("concept", "doc_id", "pos", F.substring("line", 1, 200).alias("preview")))
query("str17_headings", f"WITH {B} SELECT doc_id, pos, level, line AS title, CASE WHEN regexp_matches(line, {sql_text(S.NUMBERED)}) THEN 'numbered' ELSE 'plain' END AS how FROM b WHERE kind = 'heading'")(
    lambda t: bl(t).filter("kind = 'heading'").select("doc_id", "pos", "level", F.col("line").alias("title"), F.when(F.rlike("line", F.lit(S.NUMBERED)), "numbered").otherwise("plain").alias("how")))
spark_query("con3_batch_match", f"SELECT * FROM ({ORACLES['con1_match_headings']}) WHERE confidence >= 0.5")(
    lambda s, t: C.match_headings(t("conversations").select((F.col("conv_id") * 1000 + F.col("turn")).alias("key"), F.lower(F.element_at(F.split("text", "\n"), 1)).alias("heading")), C.registry(s)).filter("confidence >= 0.5").withColumn("confidence", F.round("confidence", 9)))
spark_query("grf4_textbook_order", f"WITH RECURSIVE {EDGES_SQL}, walk AS (SELECT src, dst, 1 AS depth FROM edges UNION SELECT w.src, e.dst, w.depth + 1 FROM walk w JOIN edges e ON e.src = w.dst WHERE w.depth < 20), n AS (SELECT src AS id FROM edges UNION SELECT dst FROM edges), d AS (SELECT n.id, count(DISTINCT w.src) AS needs FROM n LEFT JOIN walk w ON w.dst = n.id GROUP BY n.id) SELECT id, needs, row_number() OVER (ORDER BY needs, id)::INT AS place FROM d")(
    lambda s, t: C.textbook_order(C.edges(s)))

# --- texts ---------------------------------------------------------------------------------
query("aud1_sections", f"SELECT doc_id, trim(string_split(text, {NL})[1], {W}) AS explanation, trim(coalesce(string_split(text, {NL})[2], ''), {W}) AS examples, '' AS missing FROM documents WHERE NOT contains(text, '##')")(
    lambda t: (lambda m: m.select("doc_id", R.section(F.col("m"), "Explanation").alias("explanation"), R.section(F.col("m"), "Examples").alias("examples"), R.section(F.col("m"), "Practice").alias("missing")))(
        docs(t).filter(~F.contains("text", F.lit("##"))).select("doc_id", F.concat(F.lit("## Explanation\n"), F.get(F.split("text", "\n"), F.lit(0)), F.lit("\n## Examples\n"), F.coalesce(F.get(F.split("text", "\n"), F.lit(1)), F.lit("")), F.lit("\n")).alias("m"))))
_good, _bad = _read.replace("length(text)", "length(text)"), gib_sql("text", Q.MORE_GIBBERISH)
query("qlt3_text_coverage_by_source", f"""WITH p AS (SELECT source, length(text) AS n, {_good} AS good, {_bad} AS bad FROM documents), s AS (SELECT source, count(n) AS pages, sum(n) + count(n) - 1 AS total, sum(good) + count(n) - 1 AS good, sum(bad) AS bad FROM p GROUP BY source),
c AS (SELECT source, pages, total::BIGINT AS total_chars, greatest(0.0::DOUBLE, good / total::DOUBLE - 2 * (bad / total::DOUBLE)) AS coverage FROM s) SELECT *, coverage >= 0.7 AS meets_threshold FROM c""")(lambda t: R.group_coverage(docs(t), "source"))
query("cln17_drop_other_content", f"SELECT doc_id, trim(string_split(text, {NL})[1], {W}) AS line FROM documents")(
    lambda t: docs(t).select("doc_id", F.element_at(F.split(R.drop_other_content(F.concat(F.lit("import java.io.file;"), F.element_at(F.split("text", "\n"), 1), F.lit("\nFigure 3-2 A join\nExercise 4.1 Try it\n"))), "\n"), 1).alias("line")))

# --- traces ------------------------------------------------------------------------------------
_METRICS = {"met1_hint_dependency": ("hdi", T.hint_dependency), "met2_cognitive_strain": ("csi", T.cognitive_strain), "met3_productive_struggle": ("aps", T.productive_struggle), "met4_persistence": ("score", T.persistence), "met5_coverage": ("score", T.coverage), "met6_time_to_success": ("score", T.time_to_success)}
_names = ["hdi", "csi", "aps", "persistence", "coverage", "time_to_success"]


def _all_metrics(t):
    rows = tr(t)
    out = None
    for name, (column, fn) in zip(_names, _METRICS.values()):
        one = fn(rows).select("trace_id", F.col(column).alias(name))
        out = one if out is None else out.join(one, "trace_id", "full_outer")
    return out


query("met8_all_metrics", "SELECT trace_id, " + ", ".join(_names) + " FROM " + " FULL JOIN ".join(f"(SELECT trace_id, {c} AS {n} FROM ({ORACLES[q]})) {'' if k == 0 else 'USING (trace_id)'}".replace(") USING", f") x{k} USING") if k else f"(SELECT trace_id, {c} AS {n} FROM ({ORACLES[q]})) x0" for k, (n, (q, (c, _))) in enumerate(zip(_names, _METRICS.items()))))(_all_metrics)
spark_query("pol5_registry", "SELECT * FROM (VALUES ('fast_escalator', 1), ('slow_escalator', 2), ('adaptive_escalator', 3)) v(policy_id, place)")(lambda s, t: s.createDataFrame([(p, k) for k, p in enumerate(T.POLICIES, 1)], "policy_id string, place int"))
query("rpl6_run_replay", f"SELECT policy_id, trace_id, count(*) AS decisions FROM ({ORACLES['rpl1_replay']}) WHERE policy_id = 'adaptive_escalator' GROUP BY ALL")(
    lambda t: T.replay(tr(t), {"adaptive_escalator": T.POLICIES["adaptive_escalator"]}).groupBy("policy_id", "trace_id").agg(F.count("*").alias("decisions")))
_cases = " ".join(f"WHEN profile = '{p}' AND draw < {a} THEN 'error_recorded' WHEN profile = '{p}' AND draw < {b} THEN 'hint_requested'" for p, (a, b) in R.PROFILES.items())
spark_query("trc4_synthetic_traces", f"""WITH r AS (SELECT trace_id, unnest(range(1, 41)) AS seq FROM range(60) x(trace_id)), d AS (SELECT *, ['fast', 'average', 'struggling'][trace_id % 3 + 1] AS profile, ((trace_id * 7919 + seq * 104729 + 42) * 31 + (seq * trace_id) % 97) % 100 AS draw FROM r)
SELECT trace_id, seq, profile, CASE {_cases} ELSE 'problem_solved' END AS event_type, (seq - 1) // 5 AS problem_id, seq * 30 + draw AS t FROM d""")(lambda s, t: R.synthetic_events(s, 60, 40))

# --- written and read again -----------------------------------------------------------------------


def _units_again(t):
    rows = docs(t).select(F.col("doc_id").alias("unit_id"), F.col("source").alias("concept"), F.element_at(F.split("text", "\n"), 1).alias("definition"))
    path = _folder(rows, "library")
    files.write_library(path, rows, rows.select("unit_id", "concept"))
    return files.read_units(rows.sparkSession, path, "src1").select("unit_id", "definition")


def _index_again(t):
    rows = ch(t).select("doc_id", "n", "text")
    path = _folder(rows, "index")
    files.write_index(path, rows)
    return rows.sparkSession.read.parquet(f"{path}/chunks").groupBy("doc_id").agg(F.count("*").alias("chunks"), F.sum(F.length("text")).alias("chars"))


def _blocks_again(t):
    rows = bl(t)
    path = _folder(rows, "blocks")
    rows.write.json(path)
    return rows.sparkSession.read.schema(rows.schema).json(path).select("doc_id", "pos", "kind", "level")


def _results_again(t):
    rows = t("conversations").select("conv_id", "turn", "role")
    path = _folder(rows, "results")
    rows.filter("role = 'user'").write.mode("append").json(path)
    rows.filter("role <> 'user'").write.mode("append").json(path)
    return rows.sparkSession.read.schema(rows.schema).json(path)


def _traces_again(t):
    rows = tr(t)
    path = _folder(rows, "traces")
    event = F.struct("seq", F.col("event_type"), F.col("problem_id"), F.col("concept_id"), F.col("error_subtype"), F.col("escalation_level"))
    whole = rows.groupBy("trace_id").agg(F.sort_array(F.collect_list(event)).alias("events"))
    whole.write.option("ignoreNullFields", "false").json(path)
    return files.read_traces(rows.sparkSession, path, by_line=True).select("trace_id", "seq", "event_type", "problem_id", "concept_id", "error_subtype", "escalation_level")


def _csv_again(t):
    rows = docs(t).groupBy("lang").agg(F.count("*").alias("docs"), F.sum("n_chars").alias("chars"))
    path = _folder(rows, "csv")
    files.write_csv(path, rows)
    return rows.sparkSession.read.schema(rows.schema).csv(path, header=True)


query("src12_traces", "SELECT trace_id, seq::INT AS seq, event_type, problem_id, concept_id, error_subtype, escalation_level FROM (" + ORACLES["trc0_traces"] + ")")(_traces_again)
query("src13_units_of_concept", f"SELECT doc_id AS unit_id, string_split(text, {NL})[1] AS definition FROM documents WHERE source = 'src1'")(_units_again)
query("src14_blocks_json", f"WITH {B} SELECT doc_id, pos, kind, level FROM b")(_blocks_again)
query("src15_results_log", "SELECT conv_id, turn, role FROM conversations")(_results_again)
query("snk1_index", f"WITH {CHUNKS} SELECT doc_id, count(*) AS chunks, sum(length(text))::BIGINT AS chars FROM chunks GROUP BY doc_id")(_index_again)
query("snk4_csv", "SELECT lang, count(*) AS docs, sum(n_chars)::BIGINT AS chars FROM documents GROUP BY lang")(_csv_again)
