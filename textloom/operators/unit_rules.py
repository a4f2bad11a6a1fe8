"""Export rules over instructional units, and the sets of rules that exports use.

A unit is a row: unit_id, position (its place in the library), concept_id, target_stage,
unit_type, the texts TEXTS (empty where missing; example_sql null where the unit has no such field),
examples (sql, explanation, is_synthetic, from_source, is_curated, difficulty, schema_used), difficulty, mistakes (fix_sql),
practice_links (needs_resolution, problem_ids, placeholders), practice_ids, objectives,
prerequisites, error_subtypes, reflection_prompts, transfer_questions and evidence (texts),
source_pages, confidence, quality_score and the flags FLAGS.

A rule is an expression that holds where a unit passes, and one that holds where it
passes with a warning. All but one look at a single row: no shuffle, one projection
for any number of rules. `repeated_boilerplate` compares units and adds one
aggregate by text and one join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .dialect import Spark, any_in, one_of

L1, L2, L3, L4, REINFORCEMENT = STAGES = ["L1_hint", "L2_hint_plus_example", "L3_explanation", "L4_reflective_note", "reinforcement"]
TEXTS = ["title", "definition", "why_it_matters", "hint_text", "syntax_cue", "example_explanation", "common_pitfall", "reflective_content", "key_concept_summary", "key_takeaway", "recall_prompt", "quick_check_question", "quick_check_answer", "source_mode", "l2_source", "content_source", "definition_source"]
FLAGS = ["is_fallback", "offbook", "used_default", "used_curated"]

# The words, patterns and concepts that decide which units may be exported.
FRAGMENT_WORDS = "the and for of in to a an with by from on at"
PLACEHOLDER_TEXT = [r"see textbook", r"refer to", r"content could not be extracted", r"extraction failed", r"\[placeholder\]", r"\[example needed\]", r"\[todo\]", r"not available", r"coming soon", r"\[tbd\]"]
SMALL_WORDS = "a an the in on at to for of and or is are with by".split()
SQL_OPTIONAL = "transactions isolation-levels acid-properties normalization erd-design schema-design transaction-management concurrency-control database-design".split()
SQL_VERBS = "SELECT INSERT UPDATE DELETE CREATE ALTER DROP WITH".split()
NOT_ADMIN = "correlated-subquery subquery scalar-subquery exists-operator in-operator any-all-operators nested-query query-reference table-reference foreign-key primary-key unique-constraint check-constraint default-constraint referential-integrity cross-reference self-reference recursive-query with-clause cte common-table-expression".split()
ADMIN_TYPES = "admin reference metadata toc".split()
ADMIN_WORDS = "admin internal teacher-only instructor copyright preface".split()
ADMIN_REFERENCES = [r"system\s+table", r"metadata\s+table", r"information_schema", r"pg_catalog", r"sys\.", r"reference\s+document", r"golden\s+reference", r"bibliography", r"citation", r"works\s+cited"]
GENERIC_HINTS = [r"^Remember how to use", r"^Common Mistakes to Avoid:", r"^Chapter \d+", r"^Section \d+", r"Golden Reference", r"Key concepts:.*only$"]
FALLBACK_DEFINITIONS = [r"is an important SQL concept\.?$", r"is a crucial SQL concept\.?$", r"is an essential SQL concept\.?$", r"is a fundamental SQL concept\.?$"]
HEADED_DEFINITIONS = [r"^Chapter \d+", r"^Section \d+", r"Golden Reference"]
CONFIG = [r"log_output\s*=", r"settings\s*[=\{]", r"config\s*[=\{]", r"DEBUG\s*=", r"PORT\s*=", r"HOST\s*=", r"API_KEY", r"password\s*=", r"username\s*=", r"\.env", r"environment variable"]
CONTENTS = [r"^chapter\s+\d+", r"^section\s+\d+", r"^\d+\.\d+\s+", r"^appendix\s+[a-z]", r"^table of contents", r"^contents$", r"^index$", r"^glossary$", r"^references$"]
APPENDIX = ["appendix", "bibliography", "acknowledgments", "about the author", "about this book", "preface", "foreword", "copyright", "trademark", "disclaimer", "license", "errata", "revision history"]
BOILERPLATE = ["golden reference document", "golden reference", "this is a placeholder", "insert content here", "your content here", "lorem ipsum", "example content", "sample text"]
CORE_L2 = "select-basic where-clause joins-intro inner-join outer-join group-by order-by aggregate-functions subqueries-intro null-handling pattern-matching insert-statement update-statement delete-statement self-join having-clause alias comparison-operators distinct".split()
CORE_L3 = "select-basic where-clause joins joins-intro join-inner join-outer join-left join-right join-cross join-self group-by aggregation aggregate-functions order-by limit-offset having-clause subqueries-intro insert-statement update-statement delete-statement null-handling pattern-matching".split()
FIRST_WEEK = "select-basic where-clause order-by alias distinct comparison-operators pattern-matching null-handling".split()
DEFAULT_SQL = ["SELECT * FROM table", "SELECT column FROM table", "INSERT INTO table", "UPDATE table SET", "DELETE FROM table"]
#: Concepts by a part of their name, the first that fits, and statements one of which an example must hold.
STATEMENTS_OF = [
    ("create-table", ["CREATE TABLE"]), ("create-index", ["CREATE INDEX"]), ("create-view", ["CREATE VIEW"]), ("alter-table", ["ALTER TABLE"]), ("drop-table", ["DROP TABLE"]), ("drop-index", ["DROP INDEX"]),
    ("insert", ["INSERT"]), ("update", ["UPDATE"]), ("delete", ["DELETE"]), ("merge", ["MERGE"]), ("upsert", ["UPSERT", "INSERT", "UPDATE"]),
    ("select", ["SELECT"]), ("where", ["SELECT"]), ("join", ["SELECT", "JOIN"]), ("group-by", ["SELECT"]), ("order-by", ["SELECT"]), ("having", ["SELECT"]), ("limit", ["SELECT"]), ("offset", ["SELECT"]), ("subquery", ["SELECT"]),
    ("cte", ["WITH"]), ("common-table-expression", ["WITH"]), ("union", ["SELECT", "UNION"]), ("intersect", ["SELECT", "INTERSECT"]), ("except", ["SELECT", "EXCEPT"]),
    ("transaction", ["BEGIN", "COMMIT", "ROLLBACK", "START TRANSACTION"]), ("commit", ["COMMIT"]), ("rollback", ["ROLLBACK"]), ("grant", ["GRANT"]), ("revoke", ["REVOKE"]),
]


def derived(d: Spark) -> dict[str, str]:
    """Name -> expression of what several rules read: computed once, under the rules."""
    have = "example_sql IS NOT NULL"
    return {
        # statements that are not empty, the unit's own example first
        "statements": d.keep(d.both(f"CASE WHEN {have} THEN {d.array('example_sql')} ELSE {d.empty()} END", d.each("examples", "e", "e.sql")), "s", "s <> ''"),
        "n_examples": f"{d.size('examples')} + CASE WHEN {have} THEN 1 ELSE 0 END",
        "unexplained": f"({d.some('examples', 'e', "e.explanation = ''")} OR ({have} AND example_explanation = ''))",
        "real_examples": d.some("examples", "e", "e.from_source OR e.is_curated OR NOT e.is_synthetic"),
        "not_synthetic": f"({d.some('examples', 'e', 'NOT e.is_synthetic')} OR {have})",
        "all_text": f"lower(concat_ws(' ', title, definition, coalesce(example_sql, ''), example_explanation, {d.join(d.each('examples', 'e', 'concat_ws(' + d.lit(' ') + ', e.sql, e.explanation)'))}))",
        "links": d.size("practice_links"),
        "link_ids": d.total(d.each("practice_links", "p", f"cast({d.size('p.problem_ids')} as bigint)")),
        "unresolved_ids": d.total(d.each("practice_links", "p", f"cast(CASE WHEN p.needs_resolution THEN {d.size('p.problem_ids')} ELSE 0 END + {d.size(d.keep('p.problem_ids', 'i', 'i LIKE ' + d.lit('unresolved-%')))} as bigint)")),
        "placeholder_ids": d.total(d.each("practice_links", "p", f"cast(p.placeholders + {d.size(d.keep('p.problem_ids', 'i', 'i LIKE ' + d.lit('problem-%')))} as bigint)")),
        "reflection": f"CASE WHEN target_stage = '{L4}' AND reflective_content <> '' THEN reflective_content ELSE key_concept_summary END",
    }


def _any(patterns: list[str], flags: str = "") -> str:
    return flags + "|".join(f"(?:{p})" for p in patterns)


def upper_case(x: str) -> str:
    return f"({x} = upper({x}) AND {x} <> lower({x}))"


def _small(words: str, d: Spark, more: tuple[str, ...] = ()) -> str:
    return d.some(words, "w", one_of("lower(w)", [*SMALL_WORDS, *more], d))


def _heading_like(d: Spark) -> str:
    words = d.words("definition")
    low = d.rx("w", r"^[\p{Ll}\p{Lo}\p{Lm}]")
    capital = f"({d.size(words)} > 1 AND NOT {d.some(words, 'w', low)} AND NOT {_small(words, d)})"
    label = d.rx("definition", r"(?i)^(Chapter|Section|Unit|Module|Lesson|Part)\s+\d+[:\-]")
    bare = d.rx(d.strip("definition"), r"(?i)^(Chapter|Section|Unit|Module|Lesson|Part)\s+\d+[a-z]?$|^References?$")
    ending = d.rx("definition", r"(?i)\s+-\s+(Examples|Overview|Summary|Details|Introduction)$")
    return f"({label} OR {bare} OR {any_in('lower(definition)', ['reference manual', 'golden reference', 'reference document'], d)} OR {ending} OR {upper_case('definition')} OR {capital})"


def _heading_why(d: Spark) -> str:
    why, words = d.strip("why_it_matters"), d.words("why_it_matters")
    plain = d.keep(words, "w", d.rx("w", r"^\p{L}+$"))
    capital = f"({d.size(words)} BETWEEN 2 AND 9 AND {d.size(plain)} > 0 AND NOT {d.some(plain, 'w', 'NOT ' + d.rx('w', r'^\p{Lu}'))} AND NOT {_small(words, d, ('as',))})"
    return f"({d.rx(why, r'(?i)^How\s+to\s+|^(Chapter|Section|Unit|Module|Lesson|Part)\s+\d+')} OR {upper_case(why)} OR {capital} OR {d.rx(why, r'(?i)\s+-\s+(Examples|Overview|Summary|Details)$')})"


def _broken(s: str, d: Spark) -> str:
    up = f"upper({d.strip(s)})"
    verbs = any_in(up, SQL_VERBS, d)
    bare = d.rx(d.strip(s), r"(?i)^(SELECT|INSERT|UPDATE|DELETE|CREATE|ALTER|DROP)\s*;\s*$|^(S|SE|SEL|SELE|SELEC|SELECT)\s*;?\s*$")
    return f"({bare} OR length({d.strip(s)}) < 30 OR {d.size(d.words(s))} < 3 OR NOT {verbs} OR ({up} LIKE 'SELECT%' AND NOT contains({up}, 'FROM')))"


def _default_l2(d: Spark) -> str:
    generic = f"({any_in('coalesce(example_sql, ' + d.lit('') + ')', DEFAULT_SQL, d)} AND NOT contains(lower(coalesce(example_sql, '')), 'customers'))"
    return f"(used_default OR l2_source = 'default' OR ({d.size('evidence')} = 0 AND source_pages = 0) OR {generic})"


def _wrong_example(d: Spark) -> str:
    """Whether a statement lacks what its concept's examples must hold."""
    concept = "lower(concept_id)"
    cases = " ".join(f"WHEN contains({concept}, {d.lit(part)}) THEN {d.lit('|'.join(verbs))}" for part, verbs in STATEMENTS_OF)
    wanted = f"(CASE {cases} ELSE '' END)"
    fits = " OR ".join(f"(contains({wanted}, {d.lit(v)}) AND contains(upper(s), {d.lit(v)}))" for v in sorted({v for _, vs in STATEMENTS_OF for v in vs}))
    return f"({wanted} <> '' AND {d.some('statements', 's', 'NOT (' + fits + ')')})"


def _placeholder_id(i: str) -> str:
    return f"({i} LIKE 'unresolved-%' OR contains(lower({i}), 'placeholder'))"


def conditions(d: Spark, ontology: list[str]) -> dict[str, tuple[str, str]]:
    """Rule -> (holds where a unit passes, holds where it passes with a warning)."""
    l1, l2, l3 = (f"target_stage = '{s}'" for s in (L1, L2, L3))
    strip, n = d.strip, "false"
    title_and = "lower(concat_ws(' ', title, definition))"
    fallback = d.rx("definition", _any(FALLBACK_DEFINITIONS, "(?i)"))
    all_links = "(link_ids > 0 AND placeholder_ids + unresolved_ids >= link_ids)"
    some_links = "(placeholder_ids > 0 OR unresolved_ids > 0)"
    link_ids = d.some("practice_links", "p", d.some("p.problem_ids", "i", _placeholder_id("i")))
    unresolved = d.some("practice_links", "p", "p.needs_resolution OR NOT " + d.some("p.problem_ids", "i", "NOT (i LIKE 'unresolved-%')"))
    curated = "(used_curated OR content_source = 'curated')"
    score = "(CASE WHEN quality_score = 0 THEN confidence ELSE quality_score END)"
    pieces = "lower(concat_ws(' ', definition, why_it_matters, title, hint_text, reflective_content))"
    executable = d.some("statements", "s", d.rx(f"upper({strip('s')})", "^(" + "|".join(SQL_VERBS) + ")") + f" AND {strip('s')} LIKE '%;'")
    return {
        "title_too_long": (f"{d.size(d.words('title'))} <= 10", n),
        "title_is_heading_fragment": ("NOT " + d.rx("lower(title)", r"(^|\s)(" + FRAGMENT_WORDS.replace(" ", "|") + r")\s*$"), n),
        "low_relevance_score": (f"{curated} OR confidence >= 0.3", n),
        "placeholder_example_present": ("NOT " + d.rx("all_text", _any(PLACEHOLDER_TEXT)), n),
        "empty_definition": (f"NOT ({l3}) OR length({strip('definition')}) >= 20", n),
        "heading_like_definition": (f"NOT ({l3}) OR definition = '' OR NOT {_heading_like(d)}", n),
        "no_valid_example": (f"{one_of('concept_id', SQL_OPTIONAL, d)} OR NOT ({l2} OR {l3}) OR {executable}", n),
        "not_in_canonical_ontology": (one_of("concept_id", ontology, d), n),
        "no_source_evidence": (f"{d.size('evidence')} > 0 AND confidence > 0 AND source_pages > 0", n),
        "admin_only_concept": (f"{one_of('concept_id', NOT_ADMIN, d)} OR NOT ({one_of('unit_type', ADMIN_TYPES, d)} OR {any_in(title_and, ADMIN_WORDS, d)} OR (contains({title_and}, 'reference') AND {d.rx(title_and, _any(ADMIN_REFERENCES))}))", n),
        "extraction_confidence_too_low": ("confidence >= 0.3", n),
        "unresolved_practice_links": ("true", f"{l3} AND {unresolved}"),
        "broken_sql_example": (f"NOT ({l2} OR {l3}) OR NOT {d.some('statements', 's', _broken('s', d))}", n),
        "generic_hint_text": (f"NOT ({l1}) OR NOT {d.rx('hint_text', _any(GENERIC_HINTS, '(?i)'))}", n),
        "generic_definition": (f"NOT ({l3}) OR NOT {d.rx('definition', _any(FALLBACK_DEFINITIONS + HEADED_DEFINITIONS, '(?i)'))} OR real_examples", n),
        "synthetic_only_examples": ("true", f"{l3} AND {d.size('examples')} > 0 AND NOT {d.some('examples', 'e', 'NOT e.is_synthetic')}"),
        "missing_learning_objectives": (f"NOT ({l3}) OR {d.size('objectives')} > 0", n),
        "missing_prerequisites": (f"{d.size('prerequisites')} > 0", n),
        "missing_error_subtypes": (f"{d.size('error_subtypes')} > 0", n),
        "incomplete_stage_variants": (one_of("target_stage", STAGES, d), n),
        "example_not_validated": ("NOT unexplained", n),
        "low_semantic_score": ("confidence >= 0.7", n),
        "contains_config_variables": (f"NOT {d.rx(title_and, _any(CONFIG))}", n),
        "looks_like_toc_entry": (f"NOT {d.rx(strip('lower(title)'), _any(CONTENTS))} AND NOT (length(definition) < 50 AND n_examples = 0)", n),
        "appendix_content": (f"NOT {any_in('lower(title)', APPENDIX, d)}", n),
        "placeholder_practice_ids": (f"NOT ({link_ids} OR {d.some('practice_ids', 'i', _placeholder_id('i'))})", n),
        "empty_why_it_matters": (f"NOT ({l3}) OR length({strip('why_it_matters')}) >= 30", n),
        "generic_boilerplate": (f"NOT {any_in(pieces, BOILERPLATE, d)}", n),
        "wrong_example_for_concept": (f"NOT ({l2} OR {l3}) OR NOT {_wrong_example(d)}", n),
        "placeholder_practice_links_warn": ("true", f"{l3} AND links > 0 AND {some_links}"),
        "fallback_unit": ("NOT is_fallback", n),
        "offbook_curated_concept": ("NOT (source_mode = 'curated_only_offbook' OR offbook)", n),
        "placeholder_practice_links_strict": (f"NOT ({l3}) OR NOT {d.some('practice_links', 'p', 'p.needs_resolution')}", n),
        "default_example_no_source_evidence": (f"NOT ({l2}) OR NOT used_default OR {d.size('evidence')} >= 2", n),
        "placeholder_practice_links": (f"NOT ({l3}) OR NOT {all_links}", f"{l3} AND {some_links} AND NOT {all_links}"),
        "default_only_l2_example": (f"NOT ({l2}) OR NOT used_default", n),
        "core_concept_default_l2": (f"NOT ({l2}) OR NOT {one_of('concept_id', CORE_L2, d)} OR NOT {_default_l2(d)}", n),
        "week_1_demo_default_l2": (f"NOT ({l2}) OR NOT {one_of('concept_id', FIRST_WEEK, d)} OR NOT {_default_l2(d)}", n),
        "synthetic_only_l3": (f"NOT ({l3}) OR content_source <> 'synthetic' OR ({d.size('evidence')} > 0 AND confidence >= 0.3)", n),
        "weak_curated_fallback": (f"NOT {curated} OR length({strip('definition')}) >= 20", n),
        # the first unit of a text gives it its concept
        "repeated_boilerplate": ("length(reflection) < 20 OR first_concept IS NULL OR first_concept = concept_id", n),
        "low_quality_score": ("true", f"{score} < 0.7"),
        "heading_like_why_it_matters": (f"NOT ({l3}) OR why_it_matters = '' OR NOT {_heading_why(d)}", n),
        "ontology_fallback_definition": (f"NOT ({l3}) OR (NOT {one_of('definition_source', ['ontology', 'default'], d)} AND (content_source = 'curated' OR NOT {fallback} OR not_synthetic))", n),
        "insufficient_evidence_spans": (f"content_source = 'curated' OR {d.size('evidence')} >= 2", n),
    }


HARD, SOFT, WARN = "HARD_BLOCK", "SOFT_BLOCK", "WARN"
_hard = "title_too_long title_is_heading_fragment low_relevance_score placeholder_example_present empty_definition heading_like_definition no_valid_example not_in_canonical_ontology no_source_evidence admin_only_concept extraction_confidence_too_low".split()
HARD_RULES = [*((r, HARD) for r in _hard), ("unresolved_practice_links", WARN), ("broken_sql_example", HARD), ("generic_hint_text", HARD), ("generic_definition", HARD), ("synthetic_only_examples", WARN)]
SOFT_RULES = [(r, SOFT) for r in "missing_learning_objectives missing_prerequisites missing_error_subtypes incomplete_stage_variants example_not_validated low_semantic_score".split()]
CONTENT_RULES = [(r, HARD) for r in "contains_config_variables looks_like_toc_entry appendix_content".split()]
_strict = [(r, HARD) for r in "placeholder_practice_ids empty_why_it_matters generic_boilerplate wrong_example_for_concept".split()]
_production = [(r, HARD) for r in "missing_learning_objectives example_not_validated".split()]
_development = [("title_too_long", WARN), ("low_relevance_score", WARN), ("placeholder_example_present", HARD), ("empty_definition", HARD)]
_student = [*((r, HARD) for r in "fallback_unit offbook_curated_concept placeholder_practice_links_strict default_example_no_source_evidence placeholder_practice_links placeholder_practice_ids default_only_l2_example core_concept_default_l2 week_1_demo_default_l2 synthetic_only_l3 weak_curated_fallback empty_why_it_matters generic_boilerplate repeated_boilerplate wrong_example_for_concept missing_learning_objectives example_not_validated".split()),
            ("low_quality_score", SOFT), *((r, HARD) for r in "heading_like_why_it_matters ontology_fallback_definition insufficient_evidence_spans".split())]
_prototype = [("placeholder_practice_links_warn", WARN)]
#: Set -> its rules and what each does.
SETS: dict[str, list[tuple[str, str]]] = {
    "strict": HARD_RULES + _strict, "production": HARD_RULES + _production, "development": _development + SOFT_RULES, "prototype": HARD_RULES + _production + _prototype, "student_ready": HARD_RULES + _student, "content_quality": CONTENT_RULES,
}
#: The rules in the order of their definitions: those of all sets, one after the other.
DEFINED = [r for rs in (HARD_RULES, SOFT_RULES, CONTENT_RULES, _strict, _production, _development, _prototype, _student) for r, _ in rs]


def with_parts(units: DataFrame) -> DataFrame:
    """units with what the rules read: derived columns and, for texts that several concepts share, the concept of the first unit."""
    rows = units.select("*", *(F.expr(e).alias(name) for name, e in derived(Spark()).items()))
    key = F.lower(F.expr(Spark().strip("reflection")))
    rows = rows.withColumn("reflection_key", F.when(F.length("reflection") >= 20, key))
    # copies of a text meet in the map tasks; texts of one concept only need no join
    first = rows.filter("reflection_key is not null").groupBy("reflection_key").agg(F.min_by("concept_id", "position").alias("first_concept"), F.min("concept_id").alias("a"), F.max("concept_id").alias("b")).filter("a <> b").select("reflection_key", "first_concept")
    return rows.join(first, "reflection_key", "left")


def check(units: DataFrame, ontology: list[str], rules: list[str] | None = None) -> DataFrame:
    """unit_id, concept_id, target_stage and, for each rule, p_<rule> (passes) and w_<rule> (passes with a warning)."""
    found = conditions(Spark(), ontology)
    names = list(dict.fromkeys(rules or found))
    return with_parts(units).select("unit_id", "position", "concept_id", "target_stage", *(F.expr(found[r][k]).alias(f"{p}_{r}") for r in names for k, p in enumerate("pw")))


def apply_set(units: DataFrame, ontology: list[str], rules: str | list[tuple[str, str]] = "prototype") -> DataFrame:
    """unit_id, concept_id, target_stage, can_export, blocked_by (hard rules broken), warnings (others broken), in the set's order."""
    chosen = SETS[rules] if isinstance(rules, str) else rules
    checked = check(units, ontology, [r for r, _ in chosen])
    names = lambda kinds: F.concat_ws(",", *(F.when(~F.col(f"p_{r}"), r) for r, k in chosen if k in kinds))
    out = checked.select("unit_id", "concept_id", "target_stage", names((HARD,)).alias("blocked_by"), names((SOFT, WARN)).alias("warnings"))
    return out.select("unit_id", "concept_id", "target_stage", (F.col("blocked_by") == "").alias("can_export"), "blocked_by", "warnings")


def student_library(checked: DataFrame) -> DataFrame:
    """checked (apply_set of student_ready) where, besides, no unit of a core concept without any explanation may be exported."""
    core = checked.filter(F.col("concept_id").isin(CORE_L3)).groupBy("concept_id").agg(F.max((F.col("target_stage") == L3).cast("int")).alias("has")).filter("has = 0").select("concept_id", F.lit(True).alias("missing"))
    # at most the core concepts, a fixed list
    rows = checked.join(F.broadcast(core), "concept_id", "left")
    return rows.select("unit_id", "concept_id", "target_stage", (F.col("can_export") & F.col("missing").isNull()).alias("can_export"), "blocked_by", "warnings", F.coalesce("missing", F.lit(False)).alias("lacks_explanation"))


def statistics(checked: DataFrame) -> DataFrame:
    """rule, units that it blocks."""
    return checked.select(F.explode(F.split("blocked_by", ",")).alias("rule")).filter("rule <> ''").groupBy("rule").agg(F.count("*").alias("units"))


def custom_set(name: str, without: Sequence[str] = (), add: Sequence[tuple[str, str]] = ()) -> list[tuple[str, str]]:
    """A set's rules without some and with others."""
    return [r for r in SETS[name] if r[0] not in without] + list(add)


def level(d: Spark) -> str:
    """The strictest level of export that a unit is fit for; curated units are fit for all."""
    grounded = f"({d.size('evidence')} > 0 AND confidence > 0)"
    return f"CASE WHEN used_curated OR content_source = 'curated' OR ({grounded} AND confidence >= 0.9) THEN 'strict' WHEN {grounded} AND confidence >= 0.7 THEN 'production' ELSE 'development' END"
