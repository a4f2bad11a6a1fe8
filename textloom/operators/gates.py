"""Concept gates, library checks and integrity checks over units of documents."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as X

STAGES = ["L1_hint", "L2_hint_plus_example", "L3_explanation", "L4_reflective_note", "reinforcement"]


@dataclass(frozen=True)
class GateLimits:
    definition: tuple[int, int] = (100, 1000)
    points: tuple[int, int] = (2, 10)
    point_length: int = 10
    examples: tuple[int, int] = (1, 5)
    minutes: tuple[int, int] = (5, 120)
    overall: float = 0.7


def units(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Instructional units of the document table: first line as definition, further lines as points, code lines as examples."""
    l = labels.groupBy("doc_id").agg(F.max("quality").alias("quality"), F.max("toxic").alias("toxic"))  # noqa: E741
    lines = F.transform(F.split("text", "\n", -1), X.strip)
    rows = docs.join(l, "doc_id", "left").select(F.col("doc_id").alias("unit_id"), F.col("source").alias("concept"), F.element_at(F.array(*map(F.lit, STAGES)), (F.col("doc_id") % 5 + 1).cast("int")).alias("stage"), lines.alias("lines"), "n_chars",
                                                 ((F.col("doc_id") % 100) / 100).alias("confidence"), (F.coalesce("toxic", F.lit(0)) == 1).alias("fallback"), F.coalesce("quality", F.lit(1)).alias("quality"))
    return rows.select("*", F.get("lines", F.lit(0)).alias("definition"), F.filter("lines", lambda x, i: (i > 0) & (x != "")).alias("points"), F.filter("lines", lambda x: X.code_kind(x) != "").alias("examples"), F.greatest(F.lit(1), F.ceil(F.col("n_chars") / 1000)).alias("minutes"))


def _band(n: Column, low: int, high: int, ideal: tuple[int, int], inside: float) -> tuple[Column, Column]:
    """(passed, score) of a count: its share below, half above, full in the ideal band."""
    score = F.when(n < low, n / low).when(n > high, 0.5).when(n.between(*ideal), 1.0).otherwise(inside)
    return (n >= low) & (n <= high), score


def gate_checks(limits: GateLimits = GateLimits()) -> dict[str, tuple[Column, Column]]:
    """Name -> (passed, score) of each check of a unit."""
    size = F.length("definition")
    low, high = limits.definition
    long_score = F.when(size < low, size / low).when(size > high, 0.5).when(size.between(150, 1000), 1.0).when(size < 150, F.round(0.7 + 0.3 * (size / 150), 2)).otherwise(0.8)
    good = F.when(F.size("points") > 0, F.size(F.filter("points", lambda p: F.length(p) >= limits.point_length)) / F.size("points"))
    quality = F.coalesce(F.round(good, 2), F.lit(0.0))
    as_score = lambda c: c.cast("double")
    present, timed = size > 0, F.col("minutes").between(*limits.minutes)
    return {
        "definition_present": (present, as_score(present)),
        "definition_length": (size.between(low, high), long_score),
        "points_count": _band(F.size("points"), *limits.points, (3, 7), 0.8),
        "points_quality": (F.coalesce(good >= 0.7, F.lit(False)), quality),
        "examples_count": _band(F.size("examples"), *limits.examples, (1, 3), 0.9),
        "minutes": (timed, as_score(timed)),
    }


REQUIRED = ["definition_present", "points_count"]


def concept_gate(rows: DataFrame, limits: GateLimits = GateLimits()) -> DataFrame:
    """unit_id, score (mean), passed (required checks and the mean), failures."""
    checks = gate_checks(limits)
    flat = rows.select("unit_id", *(c.alias(f"p_{n}") for n, (c, _) in checks.items()), *(s.alias(f"s_{n}") for n, (_, s) in checks.items()))
    mean = sum((F.col(f"s_{n}") for n in checks), F.lit(0.0)) / len(checks)
    must = F.lit(True)
    for name in REQUIRED:
        must = must & F.col(f"p_{name}")
    return flat.select("unit_id", F.round(mean, 6).alias("score"), (must & (F.round(mean, 6) >= limits.overall)).alias("passed"), F.concat_ws(",", *(F.when(~F.col(f"p_{n}"), n) for n in checks)).alias("failures"))


def stage_coverage(rows: DataFrame) -> DataFrame:
    """concept, units, and for each stage whether a unit has it; complete if all do."""
    has = [F.max((F.col("stage") == s).cast("int")).alias(s.lower()) for s in STAGES]
    out = rows.groupBy("concept").agg(F.count("*").alias("units"), *has)
    return out.withColumn("complete", sum((F.col(s.lower()) for s in STAGES), F.lit(0)) == len(STAGES))


def boilerplate(rows: DataFrame, longest: int = 20, times: int = 3) -> DataFrame:
    """text, units of definitions and points that three or more places share."""
    each = rows.select("unit_id", F.explode(F.concat(F.array("definition"), "points")).alias("t")).select("unit_id", F.lower(X.strip(F.col("t"))).alias("text")).filter(F.length("text") > longest)
    return each.groupBy("text").agg(F.count("*").alias("places"), F.count_distinct("unit_id").alias("units")).filter(F.col("places") >= times)


def integrity(parents: DataFrame, children: DataFrame, key: str) -> DataFrame:
    """kind, rows: children without parents, parents without children, repeated parent keys."""
    orphan = children.join(parents, key, "left_anti").agg(F.count("*").alias("rows")).select(F.lit("orphans").alias("kind"), "rows")
    unused = parents.join(children, key, "left_anti").agg(F.count("*").alias("rows")).select(F.lit("unused").alias("kind"), "rows")
    twice = parents.groupBy(key).agg(F.count("*").alias("c")).filter("c > 1").agg(F.count("*").alias("rows")).select(F.lit("repeated").alias("kind"), "rows")
    return orphan.unionByName(unused).unionByName(twice)
