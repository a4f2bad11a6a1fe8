"""One unit that passes every rule and check, and what each change to it breaks."""

import pytest
from pyspark.sql import Row

from textloom.operators import unit_checks, unit_rules
from textloom.plans import units as plan

LINK = Row(needs_resolution=False, problem_ids=["p1", "p2"], placeholders=0)
SELECT = "SELECT name FROM products WHERE price > 10 ORDER BY name;"


def example(sql=SELECT, explanation="It keeps dear products.", synthetic=False, source=True):
    return Row(sql=sql, explanation=explanation, is_synthetic=synthetic, from_source=source, is_curated=False, difficulty="beginner", schema_used="products")


GOOD = {
    "unit_id": "good", "position": 0, "concept_id": "where-clause", "target_stage": "L3_explanation", "unit_type": "explanation", "title": "Filtering rows with a condition",
    "definition": "A where clause keeps the rows for which its condition holds and drops all the others.", "why_it_matters": "Filters decide which rows a report shows, so a wrong one gives wrong numbers.",
    "hint_text": "Think of the rows first.", "syntax_cue": "SELECT ... FROM ... WHERE", "example_explanation": "It keeps dear products.", "common_pitfall": "Forgetting quotes.", "reflective_content": "", "key_concept_summary": "Rows are kept.",
    "key_takeaway": "A condition keeps rows.", "recall_prompt": "Which rows are kept?", "quick_check_question": "What does where keep?", "quick_check_answer": "Rows whose condition holds.", "source_mode": "textbook", "l2_source": "textbook", "content_source": "textbook",
    "definition_source": "extracted", "example_sql": SELECT, "examples": [example()], "difficulty": "beginner", "mistakes": [Row(fix_sql=SELECT)], "practice_links": [LINK], "practice_ids": ["p1"], "objectives": ["Filter rows"], "prerequisites": ["select-basic"],
    "error_subtypes": ["missing-where"], "reflection_prompts": ["What was hard?"], "transfer_questions": ["And with joins?"], "evidence": ["A passage on rows.", "Another passage."], "source_pages": 2, "confidence": 0.95, "quality_score": 0.9,
    "is_fallback": False, "offbook": False, "used_default": False, "used_curated": False,
}
L1, L2, L4 = "L1_hint", "L2_hint_plus_example", "L4_reflective_note"

#: (changes, rules that they break, checks that they break)
CASES = [
    ({}, "", ""),
    ({"title": "a b c d e f g h i j k"}, "title_too_long", "content_relevance"),
    ({"title": "Rows and columns of the"}, "title_is_heading_fragment", ""),
    ({"title": "Chapter 3 rows"}, "looks_like_toc_entry", "content_relevance"),
    ({"confidence": 0.2}, "low_relevance_score extraction_confidence_too_low low_semantic_score", ""),
    ({"confidence": 0.2, "used_curated": True}, "extraction_confidence_too_low low_semantic_score", ""),
    ({"confidence": 0.2, "content_source": "synthetic"}, "low_relevance_score extraction_confidence_too_low low_semantic_score synthetic_only_l3", ""),
    ({"definition": ""}, "empty_definition", "definition_not_heading no_placeholders learner_ready"),
    ({"definition": "CHAPTER NINE ON ROWS AND THEIR CONDITIONS"}, "heading_like_definition", "heading_like definition_not_heading no_placeholders learner_ready explanation_quality"),
    ({"definition": "Selecting Rows By Their Keys - Overview"}, "heading_like_definition", "heading_like definition_not_heading no_placeholders learner_ready explanation_quality"),
    ({"concept_id": "where-clause", "examples": [], "example_sql": None}, "no_valid_example", "valid_sql_example example_appropriate default_example sql_executable sql_semantic example_difficulty examples_sql_valid examples_schemas_allowed"),
    ({"concept_id": "cooking"}, "not_in_canonical_ontology", "canonical_mapping learner_ready"),
    ({"evidence": []}, "no_source_evidence insufficient_evidence_spans", "source_evidence learner_ready"),
    ({"evidence": ["see textbook", "[TODO]"]}, "", "source_evidence learner_ready"),
    ({"unit_type": "toc"}, "admin_only_concept", ""),
    ({"title": "Notes of the instructor"}, "admin_only_concept", ""),
    ({"practice_links": [Row(needs_resolution=False, problem_ids=["unresolved-1"], placeholders=0)]}, "placeholder_practice_links placeholder_practice_ids", "practice_links_real practice_links_strict"),
    ({"practice_links": [Row(needs_resolution=True, problem_ids=["p1", "p2"], placeholders=0)]}, "placeholder_practice_links placeholder_practice_links_strict", "practice_links_real practice_links_strict"),
    ({"practice_links": [Row(needs_resolution=False, problem_ids=["p1", "problem-2"], placeholders=0)]}, "", "practice_links_strict"),
    ({"example_sql": "SELECT;"}, "broken_sql_example", "valid_sql_example no_broken_sql sql_executable example_appropriate sql_semantic concept_example_match"),
    ({"examples": [example("SELECT name, price")]}, "broken_sql_example", "no_broken_sql examples_sql_valid explanation_examples_whole"),
    ({"target_stage": L1, "hint_text": "Remember how to use where"}, "generic_hint_text", ""),
    ({"definition": "The where clause of a query is an important SQL concept.", "examples": [example(synthetic=True, source=False)], "example_sql": None}, "generic_definition ontology_fallback_definition", "valid_sql_example example_appropriate default_example sql_executable sql_semantic"),
    ({"objectives": []}, "missing_learning_objectives", ""),
    ({"prerequisites": []}, "missing_prerequisites", "prerequisite_tags"),
    ({"error_subtypes": []}, "missing_error_subtypes", ""),
    ({"error_subtypes": ["odd"]}, "", "error_subtype_tags"),
    ({"target_stage": "L9"}, "incomplete_stage_variants", None),
    ({"examples": [example(explanation="")]}, "example_not_validated", ""),
    ({"definition": "settings = {a} keeps the rows for which its condition holds and drops the others."}, "contains_config_variables", ""),
    ({"title": "Copyright of rows"}, "appendix_content admin_only_concept", ""),
    ({"why_it_matters": "Short."}, "empty_why_it_matters", "generic_reason explanation_quality"),
    ({"why_it_matters": "How to filter the rows of a table by a condition"}, "heading_like_why_it_matters", ""),
    ({"why_it_matters": "Section 4 on the many kinds of conditions and rows"}, "heading_like_why_it_matters", "reason_not_heading"),
    ({"hint_text": "Lorem ipsum dolor sit amet"}, "generic_boilerplate", "no_placeholders learner_ready"),
    ({"concept_id": "create-table"}, "wrong_example_for_concept", "example_appropriate sql_semantic"),
    ({"is_fallback": True}, "fallback_unit", ""),
    ({"source_mode": "curated_only_offbook"}, "offbook_curated_concept", ""),
    ({"target_stage": L2, "used_default": True}, "default_only_l2_example core_concept_default_l2 week_1_demo_default_l2", ""),
    ({"target_stage": L2, "used_default": True, "evidence": ["one"]}, "default_only_l2_example core_concept_default_l2 week_1_demo_default_l2 default_example_no_source_evidence insufficient_evidence_spans", ""),
    ({"target_stage": L2, "example_sql": "SELECT * FROM customers WHERE a = 1;"}, "", "default_example default_example_of_core_concept"),
    ({"used_curated": True, "definition": "Too short."}, "empty_definition weak_curated_fallback", "heading_like definition_not_heading no_placeholders learner_ready explanation_quality"),
    ({"definition_source": "ontology"}, "ontology_fallback_definition", ""),
    ({"example_sql": "SELECT name FROM users WHERE this query returns rows;"}, "", "sql_prose_contamination"),
    ({"mistakes": []}, "", "mistakes_count mistakes_sql_valid"),
    ({"difficulty": "odd"}, "", "difficulty_set"),
    ({"target_stage": L4, "transfer_questions": [], "reflection_prompts": []}, "", "practice_included"),
    ({"target_stage": "reinforcement", "quick_check_question": "", "recall_prompt": ""}, "", "practice_included takeaway_present no_placeholders learner_ready explanation_quality"),
]


@pytest.fixture(scope="module")
def found(spark):
    rows = [Row(**{**GOOD, **change, "unit_id": str(i), "position": i, "reflective_content": f"A note of unit number {i}, long enough."}) for i, (change, _, _) in enumerate(CASES)]
    kinds = plan.units(lambda t: spark.createDataFrame([], "doc_id long, text string" if t == "documents" else "doc_id long, quality int, toxic int")).schema
    units = spark.createDataFrame([tuple(r[f.name] for f in kinds) for r in rows], kinds)
    rules = {r["unit_id"]: r for r in unit_rules.check(units, plan.ONTOLOGY).collect()}
    checks = {r["unit_id"]: r for r in unit_checks.check(units, plan.ONTOLOGY, plan.PREREQUISITES, plan.SUBTYPES).collect()}
    return rules, checks


@pytest.mark.parametrize("i", range(len(CASES)))
def test_what_a_change_breaks(found, i):
    rules, checks = found
    _, broken_rules, broken_checks = CASES[i]
    assert {k[2:] for k, v in rules[str(i)].asDict().items() if k.startswith("p_") and not v} == set(broken_rules.split())
    if broken_checks is not None:
        assert {k[2:] for k, v in checks[str(i)].asDict().items() if k.startswith("p_") and not v} == set(broken_checks.split())
    assert all(0 <= v <= 1 for k, v in checks[str(i)].asDict().items() if k.startswith("s_"))


def test_warnings(found):
    rules, _ = found
    assert rules["16"]["w_unresolved_practice_links"] and not rules["0"]["w_unresolved_practice_links"]
    assert rules["18"]["w_placeholder_practice_links_warn"] and rules["18"]["w_placeholder_practice_links"]


def test_sets_and_repeated_notes(spark):
    kinds = plan.units(lambda t: spark.createDataFrame([], "doc_id long, text string" if t == "documents" else "doc_id long, quality int, toxic int")).schema
    note = "Rows meet where their keys agree."
    change = [{}, {"title": "a b c d e f g h i j k"}, {"concept_id": "order-by", "target_stage": L4}, {"concept_id": "group-by", "target_stage": L4}, {"concept_id": "order-by", "target_stage": L4}]
    rows = [{**GOOD, **c, "unit_id": str(i), "position": i, "reflective_content": note if i > 1 else ""} for i, c in enumerate(change)]
    units = spark.createDataFrame([tuple(r[f.name] for f in kinds) for r in rows], kinds)
    by = lambda name: {r["unit_id"]: r for r in unit_rules.apply_set(units, plan.ONTOLOGY, name).collect()}
    assert by("production")["0"]["can_export"] and by("production")["1"]["blocked_by"] == "title_too_long"
    assert by("development")["1"]["can_export"] and by("development")["1"]["warnings"] == "title_too_long"
    student = by("student_ready")
    assert [("repeated_boilerplate" in student[str(i)]["blocked_by"]) for i in (2, 3, 4)] == [False, True, False]
    library = {r["unit_id"]: r for r in unit_rules.student_library(unit_rules.apply_set(units, plan.ONTOLOGY, "student_ready")).collect()}
    assert library["0"]["can_export"] and library["2"]["lacks_explanation"] and not library["2"]["can_export"]
    assert unit_rules.apply_set(units.limit(0), plan.ONTOLOGY, "strict").count() == 0
