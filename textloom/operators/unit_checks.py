"""Quality gates over instructional units: single checks, each with a score, and gates over whole libraries.

Units are the rows that `unit_rules` describes. A check of one unit is a pair of
expressions (passes, score from 0 to 1); any number of them is one projection
without a shuffle. Checks over a library aggregate by concept or by text, with
partial aggregates, and keep nothing on the driver.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .dialect import Spark, any_in, one_of
from .unit_rules import L1, L2, L3, L4, REINFORCEMENT, SMALL_WORDS, STAGES, upper_case

# The patterns, words and lengths that decide whether a unit teaches.
PLACEHOLDERS = [r"see\s+textbook", r"content\s+could\s+not\s+be\s+extracted", r"\[placeholder\s*\]", r"\[to\s+be\s+added\s*\]", r"\[tbd\s*\]", r"\[todo\s*\]", r"not\s+available", r"coming\s+soon"]
ADMIN_CONCEPTS = [r"^(preface|introduction|foreword|appendix)", r"^(setup|installation|configuration)", r"^(about|copyright|acknowledgment)", r"^sql\.(history|overview)$"]
FRAGMENTS = [r"^\d+\.\d+\s+", r"^chapter\s+\d+", r"^section\s+\d+", r"^part\s+[ivx]+"]
TEST_TEXTS = [r"golden\s+reference\s+document", r"test\s+string", r"lorem\s+ipsum", r"sample\s+content", r"placeholder\s+text", r"your\s+text\s+here", r"insert\s+content\s+here", r"example\s+text"]
TEST_MARKS = ["test_", "_test", "sample_", "example_", "dummy"]
FILLER = [r"this\s+is\s+important\s+because", r"understanding\s+this\s+concept\s+is\s+crucial", r"this\s+is\s+a\s+fundamental\s+concept", r"it\s+is\s+essential\s+to\s+understand", r"this\s+helps\s+you\s+learn\s+sql", r"mastering\s+this\s+will\s+help\s+you", r"this\s+concept\s+is\s+widely\s+used", r"you\s+will\s+use\s+this\s+feature\s+often"]
VAGUE = ["it is important", "this is useful", "you need to know", "this helps", "good to know"]
BROKEN = r"^\s*(SELECT|FROM|WHERE|INSERT|UPDATE|DELETE|JOIN|GROUP\s+BY|ORDER\s+BY)\s*;?\s*$|^\s*SELECT\s+\*\s*$"
PROSE = [r"\bretrieves\b", r"\breturns\b", r"\bshows\b", r"\bdisplays\b", r"\blists\b", r"\bfetches\b", r"\bselects\b", r"\bfor\s+retrieving", r"\bfor\s+selecting", r"\bthis\s+query\b", r"\bthis\s+example\b", r"\bexample\s+of\b", r"\bquery\s+that\b", r"\bused\s+to\b", r"\bwill\s+(return|show|display|retrieve)", r"\bget\s+all\b", r"\bget\s+the\b"]
KEYWORDS = "SELECT FROM WHERE INSERT INTO VALUES UPDATE SET DELETE JOIN ON GROUP BY ORDER HAVING LIMIT OFFSET CREATE TABLE ALTER DROP ADD AND OR NOT NULL IS AS DISTINCT INNER LEFT RIGHT OUTER FULL COUNT SUM AVG MIN MAX EXISTS UNION ALL".split()
STATEMENTS = "SELECT INSERT UPDATE DELETE CREATE ALTER DROP".split()
ADMIN_MARKS = ["copyright", "all rights reserved", "isbn", "published by", "printed in", "dedicated to", "acknowledgment", "preface", "foreword"]
DEFAULTS = ["SELECT * FROM TABLE", "SELECT * FROM USERS", "SELECT * FROM CUSTOMERS", "SELECT COLUMN FROM TABLE"]
GENERIC_TABLES, GENERIC_COLUMNS = "TABLE1 TABLE2 T1 T2 A B X Y".split(), "COL1 COL2 C1 C2 COLUMN1 COLUMN2".split()
CORE = "select-basic where-clause order-by group-by join-operations inner-join outer-join aggregate-functions subqueries insert-statement update-statement delete-statement alias distinct comparison-operators pattern-matching null-handling".split()
CORE_PARTS = "join group aggregate subquery".split()
#: Concept -> words that its examples should hold (half of them for the semantic check, one for the others).
SEMANTIC = {
    "select-basic": "SELECT FROM", "where-clause": "WHERE", "null-handling": "NULL IS", "pattern-matching": "LIKE", "order-by": "ORDER BY", "limit-offset": "LIMIT OFFSET", "alias": "AS", "distinct": "DISTINCT", "inner-join": "JOIN ON",
    "outer-join": "LEFT RIGHT OUTER FULL", "self-join": "JOIN ON", "aggregate-functions": "COUNT SUM AVG MIN MAX", "group-by": "GROUP BY", "having-clause": "HAVING", "subqueries-intro": "SELECT FROM", "correlated-subquery": "EXISTS SELECT FROM",
    "union": "UNION", "insert-statement": "INSERT INTO", "update-statement": "UPDATE SET", "delete-statement": "DELETE FROM", "create-table": "CREATE TABLE", "alter-table": "ALTER TABLE", "constraints": "PRIMARY FOREIGN KEY UNIQUE CHECK",
}
APPROPRIATE = {**SEMANTIC, "limit-offset": "LIMIT", "outer-join": "LEFT JOIN", "self-join": "JOIN", "having-clause": "HAVING GROUP", "subqueries-intro": "SELECT", "correlated-subquery": "EXISTS", "constraints": "PRIMARY FOREIGN UNIQUE CHECK"}
MATCHING = {
    "outer-join": "LEFT RIGHT FULL", "left-join": "LEFT", "right-join": "RIGHT", "full-join": "FULL", "group-by": "GROUP BY", "having-clause": "HAVING", "where-clause": "WHERE", "order-by": "ORDER BY", "limit-offset": "LIMIT", "distinct": "DISTINCT",
    "pattern-matching": "LIKE", "null-handling": "NULL IS", "alias": "AS", "aggregate-functions": "COUNT SUM AVG MIN MAX", "subqueries-intro": "SELECT", "correlated-subquery": "EXISTS", "union": "UNION", "insert-statement": "INSERT INTO",
    "update-statement": "UPDATE SET", "delete-statement": "DELETE",
}
LEAST_DEFINITION, LEAST_REASON = 50, 40
ALLOWED_SCHEMAS = "users orders products departments employees".split()
LEVELS = "beginner intermediate advanced".split()
MISTAKES, LEAST_PRACTICE = (1, 5), 0
HEADINGS = [r"(Chapter|Section|Part|Unit|Module|Lesson)\s+\d+", r"\d+\.\d+\s+", r"(How to|Working with|Understanding|Introduction to|Overview of)", r"(In this chapter|Learning objectives|Summary|Exercises|Review|Quiz)", r"Reference\s+(Document|Manual|Guide)", r"Golden\s+Reference", r"Table of Contents"]
REASON_HEADINGS = [r"(Chapter|Section|Part|Unit|Module|Lesson)\s+\d+", r"\d+\.\d+\s+", r"(Understanding|Working with|Introduction to|Overview of)", r"(In this chapter|Learning objectives|Summary|Exercises)", r"[A-Z][a-z]+ing\s+[A-Z]", r"The\s+[A-Z][a-z]+\s+(Clause|Operator|Function)"]
#: Texts that several units should not share.
REPEATED = ["why_it_matters", "definition", "example_explanation", "hint_text"]


def _any(patterns: list[str]) -> str:
    return "|".join(f"(?:{p})" for p in patterns)


def _starts(patterns: list[str]) -> str:
    return "(?i)^(?:" + _any(patterns) + ")"


def _case(*cases: tuple[str, str], last: str = "1") -> str:
    """A score, as a double."""
    return "CASE " + " ".join(f"WHEN {c} THEN cast({v} as double)" for c, v in cases) + f" ELSE cast({last} as double) END"


def _count(conditions: list[str]) -> str:
    return "(" + " + ".join(f"CASE WHEN {c} THEN 1 ELSE 0 END" for c in conditions) + ")"


def valid_sql(s: str, d: Spark) -> str:
    """Whether a statement looks whole: a known verb, SELECT and FROM, and a name besides keywords."""
    up = f"upper({s})"
    bare = f"translate({up}, {d.lit(''';,()'"''')}, '      ')"
    named = d.some(d.words(bare), "w", "NOT " + one_of("w", KEYWORDS, d))
    return f"({d.strip(s)} <> '' AND NOT {d.rx(d.strip(up), BROKEN)} AND NOT {d.rx(f'lower({s})', _any(PLACEHOLDERS))} AND {any_in(up, STATEMENTS, d)} AND {named} AND contains({up}, 'SELECT') AND contains({up}, 'FROM'))"


def parses_as(x: str, d: Spark) -> tuple[str, str]:
    """Whether a statement passes the checks of its text, and whether it does so with a warning."""
    s, up = d.strip(x), f"upper({d.strip(x)})"
    balanced = f"length(replace({s}, '(', '')) = length(replace({s}, ')', ''))"
    faults = d.rx(s, r"(?i)\bFROM\s+FROM\b|\bWHERE\s+WHERE\b|\bSELECT\s+SELECT\b|\*\*|==")
    clauses = f"NOT ({up} LIKE 'SELECT%' AND NOT contains({up}, 'FROM')) AND NOT ({up} LIKE 'INSERT%' AND NOT (contains({up}, 'INTO') AND (contains({up}, 'VALUES') OR contains({up}, 'SELECT')))) AND NOT ({up} LIKE 'UPDATE%' AND NOT contains({up}, 'SET'))"
    parses = f"({d.rx(up, '^(SELECT|INSERT|UPDATE|DELETE|CREATE|ALTER|DROP|WITH)')} AND {s} LIKE '%;' AND {balanced} AND NOT {faults} AND {clauses})"
    warned = f"({d.rx(s, r'(?i);\s*DROP\s+')} OR {d.rx(up, r'^SELECT\s+\*')} OR ({d.rx(up, '^(UPDATE|DELETE)')} AND NOT contains({up}, 'WHERE')))"
    return parses, warned


def _title_case(words: str, share: str, low: int, high: int, d: Spark) -> str:
    plain = d.keep(words, "w", d.rx("w", r"^\p{L}+$"))
    capital = d.keep(words, "w", d.rx("w", r"^\p{Lu}\p{L}*$"))
    small = d.some(words, "w", one_of("lower(w)", SMALL_WORDS, d))
    return f"({d.size(words)} BETWEEN {low} AND {high} AND {d.size(plain)} > 0 AND {d.size(capital)} > {share} * {d.size(plain)} AND NOT {small})"


def heading_like(x: str, d: Spark) -> str:
    s = d.strip(x)
    return f"({s} <> '' AND ({d.rx(s, _starts([*HEADINGS, r'[A-Z][a-z]+ing\s+[A-Z]']))} OR ({upper_case(s)} AND length({s}) > 5) OR {_title_case(d.words(x), '0.8', 2, 9, d)} OR {s} LIKE '%:'))"


def test_text(x: str, d: Spark) -> str:
    """Whether a text is of a test or a template."""
    return f"({d.strip(x)} <> '' AND ({d.rx(f'lower({x})', _any(TEST_TEXTS))} OR {any_in(f'lower({x})', TEST_MARKS, d)}))"


def filler(x: str, d: Spark) -> str:
    s = d.strip(x)
    return f"(length({s}) < {LEAST_REASON} OR {d.rx(f'lower({s})', _any(FILLER))} OR ({any_in(f'lower({s})', VAGUE, d)} AND length({s}) < 80))"


def _has_words(sql: str, concepts: dict[str, str], d: Spark) -> str:
    """Whether a statement holds one of its concept's words, if that has any."""
    cases = " ".join(f"WHEN {d.lit(c)} THEN {any_in(f'upper({sql})', ws.split(), d)}" for c, ws in concepts.items())
    return f"(CASE concept_id {cases} ELSE true END)"


def default_sql(x: str, d: Spark) -> str:
    up, flat = f"upper({x})", f"upper({d.join(d.words(x))})"
    tables = any_in(up, [f" {k} {t}" for t in GENERIC_TABLES for k in ("FROM", "JOIN")], d)
    return f"({d.strip(x)} = '' OR {any_in(flat, DEFAULTS, d)} OR ({tables} AND {any_in(up, GENERIC_COLUMNS, d)}))"


def derived(d: Spark) -> dict[str, str]:
    """Name -> expression of what several checks read."""
    sql = "coalesce(example_sql, '')"
    texts = ["title", "definition", "why_it_matters", "hint_text", "syntax_cue", "example_explanation", "common_pitfall", "reflective_content", "key_concept_summary", "key_takeaway", "recall_prompt", "quick_check_question", "quick_check_answer"]
    nonempty = lambda xs: d.keep(xs, "s", "s <> ''")
    return {
        "own_sql": sql,
        "listed_sql": d.each("examples", "e", "e.sql"),
        "all_sql": nonempty(d.both(d.both(d.array(sql), d.each("examples", "e", "e.sql")), d.each("mistakes", "m", "m.fix_sql"))),
        "shown_sql": f"CASE WHEN {sql} <> '' THEN {sql} ELSE coalesce({d.at(nonempty(d.each('examples', 'e', 'e.sql')), '1')}, '') END",
        "everything": f"concat_ws(' ', {', '.join(texts)}, {sql}, {d.join(d.each('examples', 'e', 'concat_ws(' + d.lit(' ') + ', e.sql, e.explanation)'))})",
        "link_ids": d.total(d.each("practice_links", "p", f"cast({d.size('p.problem_ids')} as bigint)")),
        "unresolved_ids": d.total(d.each("practice_links", "p", f"cast({d.size(d.keep('p.problem_ids', 'i', 'i LIKE ' + d.lit('unresolved-%')))} as bigint)")),
        "unreal_ids": d.total(d.each("practice_links", "p", f"cast(p.placeholders + {d.size(d.keep('p.problem_ids', 'i', 'p.needs_resolution OR i LIKE ' + d.lit('unresolved-%') + ' OR i LIKE ' + d.lit('problem-%')))} as bigint)")),
        "practice_text": f"lower(concat_ws(' ', {d.join(d.each('practice_links', 'p', d.join('p.problem_ids')))}, quick_check_question))",
    }


def conditions(d: Spark, ontology: list[str], prerequisites: dict[str, list[str]], subtypes: list[str]) -> dict[str, tuple[str, str]]:
    """Check -> (passes, score)."""
    l1, l2, l3, l4, re = (f"target_stage = '{s}'" for s in (L1, L2, L3, L4, REINFORCEMENT))
    strip, size = d.strip, d.size
    short = lambda x, n: f"length({strip(x)}) < {n}"
    plain = lambda passed: (passed, _case((f"NOT ({passed})", "0")))
    out: dict[str, tuple[str, str]] = {}
    valid, heading, test, generic = valid_sql("own_sql", d), heading_like("definition", d), test_text("definition", d), filler("why_it_matters", d)
    fits, standard = f"(own_sql <> '' AND {_has_words('own_sql', APPROPRIATE, d)})", default_sql("own_sql", d)
    out["valid_sql_example"] = plain(valid)
    out["heading_like"] = plain(f"NOT {heading}")
    out["placeholder_content"] = plain(f"NOT {test}")
    out["generic_reason"] = plain(f"NOT {generic}")
    out["example_appropriate"] = plain(fits)
    out["default_example"] = plain(f"NOT {standard}")
    whole = lambda x: f"({parses_as(x, d)[0]})"
    share = lambda xs, v, c: (f"({size(xs)} > 0 AND {size(d.keep(xs, v, c))} = {size(xs)})", _case((f"{size(xs)} = 0", "0"), last=f"round(cast({size(d.keep(xs, v, c))} as double) / {size(xs)}, 2)"))
    schemas = f"(x.schema_used <> '' AND NOT {d.some(d.each(d.split('x.schema_used', ','), 'y', 'lower(' + strip('y') + ')'), 'z', 'NOT ' + one_of('z', ALLOWED_SCHEMAS, d))})"
    n_mistakes = size("mistakes")
    out["examples_sql_valid"] = share("examples", "x", whole("x.sql"))
    out["examples_schemas_allowed"] = share("examples", "x", schemas)
    out["mistakes_count"] = (f"{n_mistakes} BETWEEN {MISTAKES[0]} AND {MISTAKES[1]}", _case((f"{n_mistakes} < {MISTAKES[0]}", f"cast({n_mistakes} as double) / {MISTAKES[0]}"), (f"{n_mistakes} > {MISTAKES[1]}", "0.5"), (f"{n_mistakes} BETWEEN 2 AND 3", "1"), last="0.9"))
    out["mistakes_sql_valid"] = share("mistakes", "x", whole("x.fix_sql"))
    out["practice_references"] = (f"{size('practice_links')} >= {LEAST_PRACTICE}", _case((f"{size('practice_links')} < {LEAST_PRACTICE}", f"cast({size('practice_links')} as double) / {max(1, LEAST_PRACTICE)}")))
    out["difficulty_set"] = plain(one_of("difficulty", LEVELS, d))
    known, admin = one_of("concept_id", ontology, d), d.rx("lower(concept_id)", _any(ADMIN_CONCEPTS))
    out["canonical_mapping"] = (f"{known} AND NOT {admin}", _case((f"NOT {known}", "0"), (admin, "0.5")))
    spans, blank = size("evidence"), size(d.keep("evidence", "e", d.rx("lower(e)", _any(PLACEHOLDERS))))
    out["source_evidence"] = (f"{spans} > {blank}", _case((f"{spans} = 0", "0"), last=f"({spans} - {blank}) / cast({spans} as double)"))
    marks, n_words = _count([f"contains(lower(everything), {d.lit(m)})" for m in ADMIN_MARKS]), size(d.words("title"))
    fragment = d.rx("title", _starts([p.removeprefix("^") for p in FRAGMENTS]))
    out["content_relevance"] = (f"{n_words} < 10 AND NOT {fragment} AND {marks} < 2", _case((f"{n_words} >= 10", "0.5"), (fragment, "0.6"), (f"{marks} >= 2", "0.3"), (f"{n_words} > 7", "0.8"), (f"{marks} > 0", "0.7")))
    s, up = strip("own_sql"), f"upper({strip('own_sql')})"
    blanked = d.rx("lower(own_sql)", _any(PLACEHOLDERS))
    parses, warned = parses_as("own_sql", d)
    out["sql_executable"] = (f"{s} <> '' AND NOT {blanked} AND {parses}", _case((f"{s} = '' OR {blanked}", "0"), (f"NOT {parses}", "0.3"), (warned, "0.9")))
    shares = " ".join(f"WHEN {d.lit(c)} THEN cast({_count([f'contains({up}, {d.lit(w)})' for w in ws.split()])} as double) / {len(ws.split())}" for c, ws in SEMANTIC.items())
    low_share = f"((CASE concept_id {shares} ELSE cast(1 as double) END) < 0.5)"
    wrong_join, no_group = f"(concept_id = 'inner-join' AND (contains({up}, 'LEFT') OR contains({up}, 'RIGHT')))", f"(concept_id = 'having-clause' AND NOT contains({up}, 'GROUP'))"
    out["sql_semantic"] = (f"{s} <> '' AND NOT {low_share} AND NOT {wrong_join} AND NOT {no_group}", _case((f"{s} = ''", "0"), (low_share, "0.4"), (wrong_join, "0.5"), (no_group, "0.4")))
    # all examples against one level; a level that goes down more than once breaks the progression
    level = lambda x: f"(CASE {x} WHEN 'beginner' THEN 0 WHEN 'advanced' THEN 2 ELSE 1 END)"
    n, same = size("examples"), size(d.keep("examples", "e", "e.difficulty = 'beginner'"))
    rises = size(d.keep(d.steps(f"{n} - 1"), "i", f"{level(d.at('examples', 'i + 1') + '.difficulty')} >= {level(d.at('examples', 'i') + '.difficulty')}"))
    grows = f"({n} >= 2 AND {rises} >= {n} - 2)"
    out["example_difficulty"] = (f"{same} > 0", _case((f"{n} = 0", "0"), (grows, f"least(1.0, cast({same} as double) / {n} + 0.1)"), last=f"cast({same} as double) / greatest({n}, 1)"))
    lacks = lambda *fields: " - ".join(f"(CASE WHEN {short(f, 10)} THEN 0.3 ELSE 0 END)" for f in fields)
    minus = lambda condition, by: f"(CASE WHEN {condition} THEN {by} ELSE 0 END)"
    repaired = d.some("mistakes", "m", "m.fix_sql <> ''")
    quality = f"""round(cast(CASE WHEN {l1} THEN 1 - {lacks('hint_text', 'syntax_cue')}
 WHEN {l2} THEN least(1.0, 1 - {minus(f"own_sql <> '' AND NOT {valid}", '0.4')} - {minus(f"own_sql <> '' AND {valid} AND NOT {fits}", '0.2')} - {minus(f"own_sql <> '' AND {standard}", '0.15')} + {minus("common_pitfall <> ''", '0.1')}) - {lacks('hint_text', 'own_sql', 'example_explanation')}
 WHEN {l3} THEN 1 - {minus(f"definition <> '' AND {heading}", '0.5')} - {minus(f"definition <> '' AND {test}", '0.4')} - {minus(f"definition <> '' AND {short('definition', LEAST_DEFINITION)}", '0.2')} - {minus(f"why_it_matters <> '' AND {generic}", '0.3')}
  - {minus(f"{size('examples')} > 0 AND NOT {d.some('listed_sql', 's', valid_sql('s', d))}", '0.2')} - {minus(f"{size('mistakes')} = 0", '0.3')} - {minus(f"{size('mistakes')} > 0 AND NOT {repaired}", '0.2')} - {lacks('definition', 'why_it_matters')}
 WHEN {l4} THEN 1 - {minus(f"{size('reflection_prompts')} = 0", '0.2')} - {minus(f"{size('transfer_questions')} = 0", '0.2')} - {lacks('key_concept_summary')}
 ELSE 1 - {lacks('recall_prompt', 'quick_check_question', 'quick_check_answer')} END as double), 6)"""
    least = f"(CASE WHEN {l3} THEN 0.7 ELSE 0.6 END)"
    out["explanation_quality"] = (f"{quality} >= {least}", f"greatest(cast(0 as double), {quality})")
    body = strip("definition")
    titled = d.rx(body, _starts([*HEADINGS, r"[A-Z][a-z]+ing\s+[a-z\s]+$"]))
    ending = d.rx(body, r"( -|:) (Overview|Summary|Details|Examples)$")
    cased = _title_case(d.words("definition"), "0.7", 0, 9, d)
    out["definition_not_heading"] = (f"NOT ({l3}) OR (definition <> '' AND NOT ({titled} OR {upper_case(body)} OR {cased} OR {ending}))", _case((f"NOT ({l3})", "1"), (f"definition = '' OR {titled} OR {upper_case(body)}", "0"), (cased, "0.2"), (ending, "0")))
    practice = f"({size('practice_links')} + {size('practice_ids')} + CASE WHEN quick_check_question <> '' THEN 1 ELSE 0 END)"
    names = d.words("replace(concept_id, '-', ' ')")
    aligned = f"least(1.0, 0.5 + cast({size(d.keep(names, 'w', 'contains(practice_text, lower(w))'))} as double) / greatest(1, {size(names)}) * 0.5)"
    prompts, questions = f"{size('reflection_prompts')} > 0", f"{size('transfer_questions')} > 0"
    out["practice_included"] = (f"CASE WHEN {l1} THEN true WHEN {l2} THEN own_sql <> '' WHEN {l3} THEN {practice} > 0 WHEN {l4} THEN {questions} OR {prompts} ELSE quick_check_question <> '' END", _case((l1, "1"), (f"{l2} AND own_sql <> ''", "0.9"), (l2, "0.4"), (f"{l3} AND {practice} = 0", "0"), (l3, aligned), (f"{l4} AND {questions}", "0.9"), (f"{l4} AND {prompts}", "0.7"), (l4, "0.3"), ("quick_check_question <> ''", "1"), last="0"))
    none, all_unreal = "(link_ids = 0)", "(unreal_ids >= link_ids)"
    real = _case((none, "1"), (all_unreal, "0"), last="greatest(cast(0 as double), cast(link_ids - unreal_ids as double) / greatest(link_ids, 1))")
    out["practice_links_real"] = (f"{none} OR NOT {all_unreal}", real)
    out["practice_links_strict"] = (f"{none} OR (unreal_ids = 0 AND unresolved_ids = 0)", real)
    pick = lambda *fields: "coalesce(" + ", ".join(f"nullif({f}, '')" for f in fields) + ", '')"
    takeaway = f"(CASE WHEN {l1} THEN {pick('hint_text', 'syntax_cue')} WHEN {l2} THEN {pick('hint_text', 'common_pitfall', 'key_takeaway')} WHEN {l3} THEN {pick('key_takeaway', 'definition', 'why_it_matters')} WHEN {l4} THEN key_concept_summary ELSE {pick('quick_check_question', 'recall_prompt')} END)"
    out["takeaway_present"] = (f"{takeaway} <> ''", _case((f"{takeaway} = ''", "0"), (f"NOT ({l1} OR {re}) AND {d.count(takeaway, '[.!?]')} > 2", "0.7")))
    rooted = f"NOT {one_of('concept_id', list(prerequisites) or [''], d)}"
    unknown = d.some("prerequisites", "p", "NOT " + one_of("p", ontology, d))
    out["prerequisite_tags"] = (f"CASE WHEN {size('prerequisites')} = 0 THEN {rooted} ELSE NOT {unknown} END", _case((f"{size('prerequisites')} = 0 AND {rooted}", "1"), (f"{size('prerequisites')} = 0", "0.3"), (unknown, "0.5")))
    strange = d.some("error_subtypes", "x", f"NOT {one_of('x', subtypes, d)} AND NOT {d.rx('x', chr(94) + r'E\d+\.\d+$')}")
    out["error_subtype_tags"] = (f"NOT {strange}", _case((f"{size('error_subtypes')} = 0", "0.7"), (strange, f"cast({size(d.keep('error_subtypes', 'x', one_of('x', subtypes, d)))} as double) / {size('error_subtypes')}")))
    missing = f"""(CASE WHEN {l3} THEN CASE WHEN {short('definition', 20)} THEN 1 WHEN {short('definition', LEAST_DEFINITION)} THEN 0.5 ELSE 0 END WHEN {l1} THEN {minus(short('hint_text', 10), '1')}
 WHEN {l2} THEN {minus(short('hint_text', 10), '1')} + CASE WHEN own_sql = '' THEN 0 WHEN {short('own_sql', 5)} THEN 1 WHEN NOT {valid} THEN 1 ELSE 0 END WHEN {l4} THEN {minus(short('key_concept_summary', 10), '1')}
 ELSE {minus(f"{short('recall_prompt', 10)} AND {short('quick_check_question', 10)}", '1')} END)"""
    placeholders = f"({d.count('lower(everything)', _any(PLACEHOLDERS))} + {minus(test_text('everything', d), '1')} + {missing})"
    out["no_placeholders"] = (f"{placeholders} = 0", f"greatest(cast(0 as double), cast(1 - {placeholders} * 0.2 as double))")
    out["no_broken_sql"] = plain(f"NOT {d.some('all_sql', 's', 'NOT ' + valid_sql('s', d))}")
    parts = ["canonical_mapping", "source_evidence", "content_relevance", "no_placeholders"]
    # an admin concept and a faulty title only warn
    out["learner_ready"] = (f"{known} AND ({out['source_evidence'][0]}) AND (({out['content_relevance'][0]}) OR {n_words} >= 10 OR {fragment}) AND {placeholders} = 0", "(" + " + ".join(f"({out[p][1]})" for p in parts) + ") / 4")
    out["sql_prose_contamination"] = plain(f"NOT {d.some('all_sql', 's', d.rx('lower(s)', _any(PROSE)))}")
    match = f"(shown_sql = '' OR {_has_words('shown_sql', MATCHING, d)})"
    out["concept_example_match"] = (match, _case((f"NOT {match}", "0.5")))
    core = f"({l2} AND ({one_of('concept_id', CORE, d)} OR {any_in('concept_id', CORE_PARTS, d)}))"
    out["default_example_of_core_concept"] = (f"NOT {core} OR (own_sql <> '' AND NOT {standard})", _case((f"{core} AND own_sql = ''", "0"), (f"{core} AND {standard}", "0.3")))
    why = strip("why_it_matters")
    headed, loud, cased_why = d.rx(why, _starts(REASON_HEADINGS)), f"({upper_case(why)} AND length({why}) > 10)", _title_case(d.words("why_it_matters"), "0.8", 2, 7, d)
    asked = f"({l3} AND why_it_matters <> '')"
    out["reason_not_heading"] = (f"NOT {asked} OR NOT ({headed} OR {loud} OR {cased_why})", _case((f"NOT {asked}", "1"), (headed, "0.3"), (loud, "0.2"), (cased_why, "0.4")))
    cut = lambda s: f"(length({strip(s)}) <= 30 OR NOT {any_in(f'upper({s})', STATEMENTS, d)} OR (contains(upper({s}), 'SELECT') AND NOT contains(upper({s}), 'FROM')) OR {d.rx(f'upper({strip(s)})', BROKEN)})"
    out["explanation_examples_whole"] = plain(f"NOT ({l3}) OR NOT {d.some('listed_sql', 's', cut('s'))}")
    return out


#: Number of a check in the inventory -> its name.
NUMBERED = {
    6: "examples_sql_valid", 7: "examples_schemas_allowed", 8: "mistakes_count", 9: "mistakes_sql_valid", 10: "practice_references", 11: "difficulty_set",
    13: "valid_sql_example", 14: "heading_like", 15: "placeholder_content", 16: "generic_reason", 17: "example_appropriate", 18: "default_example", 20: "canonical_mapping", 21: "source_evidence", 22: "content_relevance", 23: "sql_executable",
    24: "sql_semantic", 25: "example_difficulty", 26: "explanation_quality", 27: "definition_not_heading", 28: "practice_included", 29: "practice_links_real", 30: "practice_links_strict", 31: "takeaway_present", 32: "prerequisite_tags",
    33: "error_subtype_tags", 38: "no_placeholders", 39: "no_broken_sql", 40: "learner_ready", 41: "sql_prose_contamination", 42: "concept_example_match", 43: "default_example_of_core_concept", 44: "reason_not_heading", 45: "explanation_examples_whole",
}
#: The checks that a unit's gate runs, those that must hold, and what to do about each.
BLOCKING = ["canonical_mapping", "source_evidence", "definition_not_heading", "no_placeholders", "no_broken_sql"]
UNIT_GATE = [*BLOCKING, "content_relevance", "explanation_quality", "practice_included", "practice_links_real", "takeaway_present", "prerequisite_tags", "error_subtype_tags"]
ADVICE = {
    "canonical_mapping": "Map the unit to a concept of the ontology.", "source_evidence": "Attach passages of the source.", "definition_not_heading": "Write the definition as a sentence.", "no_placeholders": "Replace placeholder texts.", "no_broken_sql": "Repair the statements.",
    "content_relevance": "Shorten the title or drop the unit.", "explanation_quality": "Complete the texts of the stage.", "practice_included": "Add practice.", "practice_links_real": "Link real problems.", "takeaway_present": "Add a takeaway.",
    "prerequisite_tags": "List known prerequisites.", "error_subtype_tags": "Use known error subtypes.",
}


def check(units: DataFrame, ontology: list[str], prerequisites: dict[str, list[str]], subtypes: list[str], names: list[str] | None = None) -> DataFrame:
    """unit_id, concept_id and, for each check, p_<check> (passes) and s_<check> (score)."""
    found = conditions(Spark(), ontology, prerequisites, subtypes)
    rows = units.select("*", *(F.expr(e).alias(name) for name, e in derived(Spark()).items()))
    return rows.select("unit_id", "concept_id", *(F.expr(found[n][k]).alias(f"{p}_{n}") for n in names or found for k, p in enumerate("ps")))


def unit_gates(units: DataFrame, ontology: list[str], prerequisites: dict[str, list[str]], subtypes: list[str]) -> DataFrame:
    """unit_id, concept_id, passed (all blocking checks), score (mean), failures."""
    rows = check(units, ontology, prerequisites, subtypes, UNIT_GATE)
    passed = reduce(lambda a, n: a & F.col(f"p_{n}"), BLOCKING, F.lit(True))
    mean = sum((F.col(f"s_{n}") for n in UNIT_GATE), F.lit(0.0)) / len(UNIT_GATE)
    return rows.select("unit_id", "concept_id", passed.alias("passed"), F.round(mean, 6).alias("score"), F.concat_ws(",", *(F.when(~F.col(f"p_{n}"), n) for n in UNIT_GATE)).alias("failures"))


def recommendations(gated: DataFrame) -> DataFrame:
    """check_name, units that fail it, advice."""
    counts = gated.select(F.explode(F.split("failures", ",")).alias("check_name")).filter("check_name <> ''").groupBy("check_name").agg(F.count("*").alias("units"))
    advice = F.create_map(*(F.lit(x) for pair in ADVICE.items() for x in pair))
    return counts.select("check_name", "units", F.element_at(advice, F.col("check_name")).alias("advice"))


def repeated_texts(units: DataFrame, longest: int = 20, times: int = 3) -> DataFrame:
    """text, places, concepts of texts that stand in three places or more."""
    each = units.select("concept_id", F.explode(F.array(*REPEATED)).alias("t")).filter(F.length("t") > longest)
    return each.select("concept_id", F.lower(F.expr(Spark().strip("t"))).alias("text")).groupBy("text").agg(F.count("*").alias("places"), F.count_distinct("concept_id").alias("concepts")).filter(F.col("places") >= times)


def boilerplate_content(units: DataFrame) -> DataFrame:
    """passed, score, texts, places: whether no text is repeated across the library."""
    found = repeated_texts(units).agg(F.count("*").alias("texts"), F.coalesce(F.sum("places"), F.lit(0)).cast("long").alias("places"))
    return found.select((F.col("texts") == 0).alias("passed"), F.when(F.col("texts") == 0, 1.0).otherwise(0.6).alias("score"), "texts", "places")


def _stages(units: DataFrame) -> DataFrame:
    return units.groupBy("concept_id").agg(*(F.max(F.col("target_stage") == s).alias(s) for s in STAGES))


def stage_variants(units: DataFrame) -> DataFrame:
    """concept_id, missing: stages that no unit of the concept has."""
    return _stages(units).select("concept_id", F.concat_ws(",", *(F.when(~F.col(s), s) for s in STAGES)).alias("missing"))


def has_stage(units: DataFrame, stage: str) -> DataFrame:
    """concept_id, passed: whether a unit of the concept is of the stage."""
    return _stages(units).select("concept_id", F.col(stage).alias("passed"))


def library_gates(units: DataFrame) -> DataFrame:
    """gate, score, passed of the gates over a whole library."""
    stages = _stages(units)
    core = stages.filter(~F.expr(Spark().rx("lower(concept_id)", _any(ADMIN_CONCEPTS))))
    share = lambda rows, gate, c: rows.agg(F.avg(c.cast("int")).alias("score")).select(F.lit(gate).alias("gate"), "score")
    rows = share(stages, "stage_variants", reduce(lambda a, s: a & F.col(s), STAGES, F.lit(True))).unionByName(share(stages, "reinforcement_present", F.col(REINFORCEMENT))).unionByName(share(core, "explanations_of_core_concepts", F.col(L3)))
    rows = rows.unionByName(boilerplate_content(units).select(F.lit("boilerplate_content").alias("gate"), "score"))
    return rows.select("gate", F.round("score", 6).alias("score"), (F.col("score") == 1).alias("passed"))
