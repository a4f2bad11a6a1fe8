"""Export rules and quality gates over instructional units made from the document table.

The tables hold no units, so UNIT makes one of each document: its first line is a
definition or a title, all else is picked from literal lists by its number, so that
every rule meets units on both sides. Queries return a row for every unit.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import unit_checks as K
from ..operators import unit_rules as R
from ..operators.dialect import Duck, Spark
from .registry import query

ONTOLOGY = "select-basic where-clause joins-intro outer-join group-by order-by insert-statement null-handling transactions correlated-subquery create-table alias".split()
#: Concepts with the concepts that they build on.
PREREQUISITES = {"where-clause": ["select-basic"], "joins-intro": ["select-basic", "where-clause"], "outer-join": ["joins-intro"], "group-by": ["select-basic"], "order-by": ["select-basic"], "correlated-subquery": ["where-clause"]}
SUBTYPES = ["wrong-join", "missing-where", "null-compare"]
SQL = [
    "SELECT name, price FROM products WHERE price > 10 ORDER BY name;", "SELECT;", "SEL", "SELECT * FROM table", "INSERT INTO orders (id, total) VALUES (1, 20);", "SELECT c.name FROM customers c LEFT JOIN orders o ON c.id = o.customer_id;",
    "CREATE TABLE parts (id INT PRIMARY KEY, name TEXT);", "this query retrieves all rows from the table", "SELECT dept, COUNT(*) AS n FROM staff GROUP BY dept HAVING COUNT(*) > 2;", "", "SELECT name FROM users WHERE email IS NULL AND name LIKE 'A%';",
    "SELECT col1 FROM t1 JOIN t2 ON t1.col1 = t2.col2;", "UPDATE staff SET pay = 1 WHERE EXISTS (SELECT 1 FROM depts);",
]
TITLES = ["", "Selecting Rows", "How to use the", "Chapter 5 joins", "Appendix A", "settings = {a}", "3.2 Joins", "A title of far more words than any title of a unit may have", "Internal notes", "references"]
DEFINITIONS = [
    "", "Chapter 5: Joins", "Section 3", "GOLDEN REFERENCE DOCUMENT", "Joining tables - Overview", "Select Basic Query", "A join is an important SQL concept.", "References", "Too short", "See textbook for the definition of this statement and its clauses.",
    "The reference to a system table is kept in the catalog, whatever the user asks.", "A where clause keeps the rows for which its condition holds, and drops all others.", "Creating Tables",
]
REASONS = ["", "How to join two tables", "CHAPTER NINE", "Joining Two Tables", "It helps.", "Filters decide which rows a report shows, so a wrong one gives wrong numbers.", "This is important because you will use this feature often in your work.", "Section 4 on joins and on their many kinds", "Understanding rows - Summary", "It is important to know how rows are kept apart, or not."]
HINTS = ["Remember how to use joins", "Think of which rows you want before you write the list of columns.", "Key concepts: rows, columns only", "", "Chapter 3 shows it", "lorem ipsum dolor sit amet", "Look at the FROM clause first; it names the tables."]
SUMMARIES = ["", "Rows meet where their keys agree. Always name the keys.", "A group has one row. It may be empty! Or not? Who knows.", "Nulls are not equal to anything, not even to each other.", "short"]


def unit_columns(d: Spark) -> dict[str, str]:
    """Column of a unit -> expression over doc_id, text, quality, toxic."""

    def pick(values: list[str], step: int, shift: int = 0) -> str:
        return d.at(d.array(*values), f"cast((doc_id * {step} + {shift}) % {len(values)} as int) + 1")

    def word(values: list[str], step: int, shift: int = 0) -> str:
        return pick([d.lit(v) for v in values], step, shift)

    def some(values: list[str], step: int) -> str:
        return d.first(d.array(*map(d.lit, values)), f"(doc_id * {step}) % {len(values) + 1}")

    line = d.at(f"split(text, {d.lit(chr(10))})" if type(d) is Spark else "string_split(text, chr(10))", "1")
    example = lambda k: d.struct(sql=word(SQL, 5 + 2 * k, k), explanation=word(["", "It keeps some rows.", "It joins two tables."], 2, k), is_synthetic=f"((doc_id * 2 + {k}) % 7 < 5)", from_source=f"((doc_id + {k}) % 7 = 0)", is_curated=f"((doc_id + {k}) % 11 = 0)", difficulty=word(["beginner", "intermediate", "advanced"], 1, k), schema_used=word(["users", "Users, orders", "", "sailors", "products"], 3, k))
    ids = [["p1", "p2"], ["unresolved-1"], ["problem-2", "p9"], ["x-Placeholder-1"], ["unresolved-3", "problem-4"]]
    link = lambda k: d.struct(needs_resolution=f"((doc_id + {k}) % 5 = 1)", problem_ids=pick([d.array(*map(d.lit, x)) for x in ids], 3, k), placeholders=f"cast((doc_id + {k}) % 9 = 0 as int)")
    return {
        "unit_id": f"concat('unit-', {d.text('doc_id')})", "position": "doc_id", "concept_id": word([*ONTOLOGY, "made-up-topic", "preface-notes"], 3), "target_stage": word([*R.STAGES[:4], R.REINFORCEMENT, R.L3], 1),
        "unit_type": word(["explanation", "example", "hint", "reference", "practice"], 7, 1),
        "title": f"CASE WHEN doc_id % 3 = 0 THEN substr({line}, 1, 40) ELSE {word(TITLES, 7)} END", "definition": f"CASE WHEN doc_id % 2 = 0 THEN {line} ELSE {word(DEFINITIONS, 5)} END",
        "why_it_matters": word(REASONS, 7, 1), "hint_text": word(HINTS, 5), "syntax_cue": word(["", "SELECT ... FROM ... WHERE", "short"], 1), "example_explanation": word(["", "It shows the rows of one table.", "Each row meets its match."], 4),
        "common_pitfall": word(["", "Forgetting the keys of the join."], 3), "reflective_content": word(["", *SUMMARIES], 11), "key_concept_summary": word(SUMMARIES, 7), "key_takeaway": word(["", "Name the rows first."], 5), "recall_prompt": word(["", "Which rows does a left join keep?"], 3),
        "quick_check_question": word(["", "What does HAVING do?", "Why?"], 5), "quick_check_answer": word(["", "It filters the groups."], 7),
        "source_mode": word(["", "textbook", "curated_only_offbook"], 5), "l2_source": word(["", "default", "textbook", "textbook"], 3), "content_source": word(["", "synthetic", "curated", "textbook"], 5), "definition_source": word(["", "ontology", "extracted", "default", "extracted"], 3),
        "example_sql": f"CASE WHEN doc_id % 4 = 0 THEN NULL ELSE {word(SQL, 3, 2)} END", "examples": d.first(d.array(example(0), example(1)), "(doc_id * 2 + 1) % 5"),
        "difficulty": word(["beginner", "intermediate", "advanced", "hard"], 5), "mistakes": d.first(d.array(*(d.struct(fix_sql=word(SQL, 9, 4 + k)) for k in range(6))), "doc_id % 7"), "practice_links": d.first(d.array(link(0), link(1)), "(doc_id * 2) % 3"), "practice_ids": some(["p7", "placeholder-3"], 5),
        "objectives": some(["Name the clauses"], 3), "prerequisites": some(["select-basic", "made-up"], 4), "error_subtypes": some(["wrong-join", "E1.2", "unheard-of"], 7), "reflection_prompts": some(["What was hard?"], 5), "transfer_questions": some(["And with two tables?"], 3),
        "evidence": some(["A passage on rows.", "[TODO]", "see textbook"], 3), "source_pages": "cast(doc_id % 3 as int)", "confidence": "cast(doc_id % 101 as double) / 100", "quality_score": "CASE WHEN quality IS NULL THEN cast(0 as double) ELSE cast(0.5 as double) + cast(quality as double) / 4 END",
        "is_fallback": "coalesce(toxic, 0) = 1", "offbook": "doc_id % 13 = 0", "used_default": "doc_id % 8 = 3", "used_curated": "doc_id % 17 = 0",
    }


def units(t):
    """Units of the tables, as the operators read them."""
    labels = t("labels").groupBy("doc_id").agg(F.max("quality").alias("quality"), F.max("toxic").alias("toxic"))
    rows = t("documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(labels, "doc_id", "left")
    return rows.select(*(F.expr(e).alias(name) for name, e in unit_columns(Spark()).items()))


D = Duck()
_select = lambda columns: ", ".join(f"{e} AS {name}" for name, e in columns.items())
UNITS = f"""WITH l AS (SELECT doc_id, max(quality) AS quality, max(toxic) AS toxic FROM labels GROUP BY doc_id),
b AS (SELECT doc_id, coalesce(text, '') AS text, quality, toxic FROM documents LEFT JOIN l USING (doc_id)),
u AS (SELECT {_select(unit_columns(D))} FROM b)"""
PARTS = f"""{UNITS}, r0 AS (SELECT *, {_select(R.derived(D))} FROM u), r1 AS (SELECT *, CASE WHEN length(reflection) >= 20 THEN lower({D.strip('reflection')}) END AS reflection_key FROM r0),
f AS (SELECT reflection_key, min_by(concept_id, position) AS first_concept FROM r1 WHERE reflection_key IS NOT NULL GROUP BY 1 HAVING min(concept_id) <> max(concept_id)),
r AS (SELECT r1.*, first_concept FROM r1 LEFT JOIN f USING (reflection_key))"""
_found = R.conditions(D, ONTOLOGY)


def _set_sql(name: str, rules=None) -> str:
    chosen = rules or R.SETS[name]
    names = lambda kinds: "concat_ws(',', " + ", ".join([f"CASE WHEN NOT ({_found[r][0]}) THEN '{r}' END" for r, k in chosen if k in kinds] or ["NULL::VARCHAR"]) + ")"
    return f"{PARTS}, c AS (SELECT unit_id, concept_id, target_stage, {names((R.HARD,))} AS blocked_by, {names((R.SOFT, R.WARN))} AS warnings FROM r), s AS (SELECT unit_id, concept_id, target_stage, blocked_by = '' AS can_export, blocked_by, warnings FROM c)"


# --- one query for each rule of each set --------------------------------------------
for _k, _rule in enumerate(R.DEFINED, 1):
    _passes, _warns = _found[_rule]
    query(f"rul{_k}_{_rule}", f"{PARTS} SELECT unit_id, ({_passes}) AS passed, (({_passes}) AND ({_warns})) AS warned FROM r")(
        lambda t, r=_rule: R.check(units(t), ONTOLOGY, [r]).select("unit_id", F.col(f"p_{r}").alias("passed"), (F.col(f"p_{r}") & F.col(f"w_{r}")).alias("warned")))

# --- sets of rules -------------------------------------------------------------------
for _name in ("strict", "production", "development", "prototype", "content_quality"):
    query(f"flt1_{_name}", f"{_set_sql(_name)} SELECT * FROM s")(lambda t, n=_name: R.apply_set(units(t), ONTOLOGY, n))
_student = f"""{_set_sql("student_ready")}, core AS (SELECT concept_id FROM s WHERE concept_id IN ({', '.join(map(D.lit, R.CORE_L3))}) GROUP BY 1 HAVING max((target_stage = '{R.L3}')::INT) = 0)
SELECT unit_id, concept_id, target_stage, can_export AND concept_id NOT IN (SELECT concept_id FROM core) AS can_export, blocked_by, warnings, concept_id IN (SELECT concept_id FROM core) AS lacks_explanation FROM s"""
query("flt2_student_library", _student)(lambda t: R.student_library(R.apply_set(units(t), ONTOLOGY, "student_ready")))
query("flt3_exportable", f"{_set_sql('production')} SELECT unit_id FROM s WHERE can_export")(lambda t: R.apply_set(units(t), ONTOLOGY, "production").filter("can_export").select("unit_id"))
query("flt3_rejected", f"{_set_sql('production')} SELECT unit_id, blocked_by FROM s WHERE NOT can_export")(lambda t: R.apply_set(units(t), ONTOLOGY, "production").filter("NOT can_export").select("unit_id", "blocked_by"))
query("flt3_blocks_by_rule", f"{_set_sql('student_ready')}, x AS (SELECT unnest(string_split(blocked_by, ',')) AS rule FROM s) SELECT rule, count(*) AS units FROM x WHERE rule <> '' GROUP BY rule")(lambda t: R.statistics(R.apply_set(units(t), ONTOLOGY, "student_ready")))
_custom = R.custom_set("strict", without=["title_too_long", "no_valid_example"], add=[("low_semantic_score", R.HARD), ("missing_prerequisites", R.SOFT)])
query("flt5_custom_set", f"{_set_sql('custom', _custom)} SELECT * FROM s")(lambda t: R.apply_set(units(t), ONTOLOGY, _custom))

query("flt4_level_filter", f"{UNITS} SELECT unit_id, {R.level(D)} AS level FROM u")(lambda t: units(t).select("unit_id", F.expr(R.level(Spark())).alias("level")))

# --- quality gates ----------------------------------------------------------------------
_checks = K.conditions(D, ONTOLOGY, PREREQUISITES, SUBTYPES)
for _k, _check in K.NUMBERED.items():
    _passes, _score = _checks[_check]
    query(f"gck{_k}_{_check}", f"{UNITS}, r AS (SELECT *, {_select(K.derived(D))} FROM u) SELECT unit_id, ({_passes}) AS passed, round({_score}, 6) AS score FROM r")(
        lambda t, c=_check: K.check(units(t), ONTOLOGY, PREREQUISITES, SUBTYPES, [c]).select("unit_id", F.col(f"p_{c}").alias("passed"), F.round(f"s_{c}", 6).alias("score")))
_gates = f"{UNITS}, r AS (SELECT *, {_select(K.derived(D))} FROM u), c AS (SELECT unit_id, concept_id, " + ", ".join(f"({p}) AS p_{n}, ({s}) AS s_{n}" for n, (p, s) in _checks.items() if n in K.UNIT_GATE) + " FROM r)"
_fails = "concat_ws(',', " + ", ".join(f"CASE WHEN NOT p_{n} THEN '{n}' END" for n in K.UNIT_GATE) + ")"
query("gat3_unit_gates", f"{_gates} SELECT unit_id, concept_id, {' AND '.join(f'p_{n}' for n in K.BLOCKING)} AS passed, round(({' + '.join(f's_{n}' for n in K.UNIT_GATE)}) / {len(K.UNIT_GATE)}, 6) AS score, {_fails} AS failures FROM c")(
    lambda t: K.unit_gates(units(t), ONTOLOGY, PREREQUISITES, SUBTYPES))
_texts = " UNION ALL ".join(f"SELECT unit_id, concept_id, lower({D.strip(f)}) AS text FROM u WHERE length({f}) > 20" for f in K.REPEATED)
_boiler = f"x AS ({_texts}), y AS (SELECT text, count(*) AS places, count(DISTINCT concept_id) AS concepts FROM x GROUP BY text HAVING count(*) >= 3)"
query("gck19_repeated_texts", f"{UNITS}, {_boiler} SELECT * FROM y")(lambda t: K.repeated_texts(units(t)))
_stages = f"g AS (SELECT concept_id, " + ", ".join(f"max((target_stage = '{s}')::INT) = 1 AS {s.lower()}" for s in R.STAGES) + " FROM u GROUP BY concept_id)"
query("gck34_stage_variants", f"{UNITS}, {_stages} SELECT concept_id, concat_ws(',', " + ", ".join(f"CASE WHEN NOT {s.lower()} THEN '{s}' END" for s in R.STAGES) + ") AS missing FROM g")(lambda t: K.stage_variants(units(t)))
query("gck35_reinforcement", f"{UNITS}, {_stages} SELECT concept_id, reinforcement AS passed FROM g")(lambda t: K.has_stage(units(t), R.REINFORCEMENT))
_admin = D.rx("lower(concept_id)", "|".join(K.ADMIN_CONCEPTS))
query("gck36_core_explanations", f"{UNITS}, {_stages} SELECT concept_id, l3_explanation AS passed FROM g WHERE NOT {_admin}")(lambda t: K.has_stage(units(t).filter(~F.expr(Spark().rx("lower(concept_id)", "|".join(K.ADMIN_CONCEPTS)))), R.L3))
query("gck37_boilerplate_content", f"{UNITS}, {_boiler} SELECT count(*) = 0 AS passed, CASE WHEN count(*) = 0 THEN 1.0::DOUBLE ELSE 0.6::DOUBLE END AS score, count(*) AS texts, coalesce(sum(places), 0)::BIGINT AS places FROM y")(lambda t: K.boilerplate_content(units(t)))
_library = f"""{UNITS}, {_stages}, {_boiler}, v AS (SELECT 'stage_variants' AS gate, avg((l1_hint AND l2_hint_plus_example AND l3_explanation AND l4_reflective_note AND reinforcement)::INT) AS score FROM g
UNION ALL SELECT 'reinforcement_present', avg(reinforcement::INT) FROM g UNION ALL SELECT 'explanations_of_core_concepts', avg(l3_explanation::INT) FROM g WHERE NOT {_admin} UNION ALL SELECT 'boilerplate_content', CASE WHEN count(*) = 0 THEN 1.0 ELSE 0.6 END FROM y)"""
query("gat4_library_gates", f"{_library} SELECT gate, round(score, 6) AS score, score = 1 AS passed FROM v")(lambda t: K.library_gates(units(t)))
_advice = "CASE " + " ".join(f"WHEN name = '{n}' THEN {D.lit(a)}" for n, a in K.ADVICE.items()) + " END"
query("gat7_recommendations", f"{_gates}, q AS (SELECT unnest(string_split({_fails}, ',')) AS name FROM c) SELECT name AS check_name, count(*) AS units, {_advice} AS advice FROM q WHERE name <> '' GROUP BY name")(lambda t: K.recommendations(K.unit_gates(units(t), ONTOLOGY, PREREQUISITES, SUBTYPES)))
