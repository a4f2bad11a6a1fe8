"""Learner traces: state at each event, escalation policies, replay and behaviour metrics.

All operators read (trace_id, seq, ...) rows and share one partitioning, by
trace_id; order is seq, never the timestamp.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ESCALATIONS = ["hint_requested", "hint_shown", "explanation_requested", "explanation_shown", "escalation_triggered"]

def order():
    return Window.partitionBy("trace_id").orderBy("seq")


def so_far():
    return order().rowsBetween(Window.unboundedPreceding, Window.currentRow)


def before():
    return order().rowsBetween(Window.unboundedPreceding, -1)


def traces(events: DataFrame) -> DataFrame:
    """The event table as learner traces: one per user and week, half an hour as the unit of time."""
    us = F.unix_micros(F.col("ts").cast("timestamp"))
    k = F.get_json_object("props", "$.k").cast("int")
    week = F.floor((F.col("us") - 1704067200000000) / F.lit(604800000000.0)).cast("long")
    kind = F.create_map(*map(F.lit, ["signup", "problem_attempt", "click", "hint_requested", "view", "explanation_shown", "error", "error_recorded", "purchase", "problem_solved"]))
    rows = events.select("event_id", "user_id", "value", F.col("event_type").alias("raw"), us.alias("us"), k.alias("k"))
    rows = rows.withColumn("trace_id", F.concat_ws("-w", F.col("user_id").cast("string"), week.cast("string")))
    by_time = Window.partitionBy("trace_id").orderBy("us", "event_id")
    since = lambda c: (F.col("us") - c) / F.lit(1800000000.0)
    return rows.select(
        "trace_id", "event_id", F.row_number().over(by_time).alias("seq"), F.concat(F.lit("p"), (F.col("k") % 12).cast("string")).alias("problem_id"), F.concat(F.lit("c"), (F.col("k") % 7).cast("string")).alias("concept_id"),
        F.coalesce(kind[F.col("raw")], F.col("raw")).alias("event_type"), F.when(F.col("raw") == "error", F.concat(F.lit("e"), (F.col("k") % 3).cast("string"))).alias("error_subtype"),
        F.when(F.col("raw") == "click", "L1").when(F.col("raw") == "view", "L2").otherwise("L0").alias("escalation_level"),
        since(F.min("us").over(Window.partitionBy("trace_id"))).alias("t"), F.coalesce(since(F.lag("us").over(by_time)), F.lit(0.0)).alias("gap"), F.col("value").alias("time_stuck"),
    )


def is_error() -> Column:
    return F.col("error_subtype").isNotNull()


def is_escalation() -> Column:
    return F.col("event_type").isin(ESCALATIONS)


def _count(c: Column) -> Column:
    return F.sum(F.when(c, 1).otherwise(0)).over(so_far())


def learner_state(rows: DataFrame) -> DataFrame:
    """Each event with what is known of the learner then.

    An event that solves or leaves a problem ends a run of errors before its own
    error counts, so it opens a new group.
    """
    solved = F.col("event_type") == "problem_solved"
    rows = rows.withColumn("grp", _count(solved | (F.col("event_type") == "problem_abandoned")))
    in_group = Window.partitionBy("trace_id", "grp").orderBy("seq").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumn("consecutive_errors", F.sum(F.when(is_error(), 1).otherwise(0)).over(in_group))
    rows = rows.withColumns({
        "run_before": F.coalesce(F.lag("consecutive_errors").over(order()), F.lit(0)),
        "last_subtype": F.last("error_subtype", ignorenulls=True).over(before()),
        "subtypes": F.slice(F.reverse(F.collect_list("error_subtype").over(so_far())), 1, 3),
    })
    return rows.withColumns({
        "total_errors": _count(is_error()),
        "hints_requested": _count(F.col("event_type").isin("hint_requested", "hint_shown")),
        "explanations_shown": _count(F.col("event_type") == "explanation_shown"),
        "recoveries": _count(solved & (F.col("run_before") > 0)),
        "repeated": F.max(F.when(is_error() & F.coalesce(F.col("last_subtype") == F.col("error_subtype"), F.lit(False)), 1).otherwise(0)).over(so_far()) == 1,
        "stuck": F.coalesce(F.last(F.when(F.col("time_stuck") != 0, F.col("time_stuck")), ignorenulls=True).over(so_far()), F.lit(0.0)),
        "concepts": F.size(F.collect_set("concept_id").over(so_far())),
        "same_three": is_error() & (F.size(F.filter("subtypes", lambda x: x == F.col("error_subtype"))) >= 3),
    }).drop("run_before", "last_subtype", "subtypes", "grp")


def _round4(c: Column) -> Column:
    """Four decimals, halves up, whatever the last bits of a sum of decimals are."""
    return F.round(F.round(c, 9), 4)


def _first_of(rules: list[tuple[Column, str, Column | str, str]], default: tuple[str, Column, str]) -> Column:
    """struct(action, level, rule) of the first rule that holds."""
    as_struct = lambda a, level, r: F.struct(F.lit(a).alias("action"), (F.lit(level) if isinstance(level, str) else level).alias("level"), F.lit(r).alias("rule"))
    out = as_struct(*default)
    for holds, action, level, rule in reversed(rules):
        out = F.when(holds, as_struct(action, level, rule)).otherwise(out)
    return out


def fast_policy() -> Column:
    """Steps in early."""
    run, stuck, level = F.col("consecutive_errors"), F.col("stuck"), F.col("escalation_level")
    free = level == "L0"
    return _first_of([
        (F.col("repeated") & (run >= 2), "escalate_to_l3", "L3", "fast_escalator_rule_3"),
        ((run >= 4) | (stuck > 120), "escalate_to_l4", "L4", "fast_escalator_rule_6"),
        (run >= 3, "escalate_to_l3", "L3", "fast_escalator_rule_3"),
        ((stuck > 60) & free, "show_hint", "L1", "fast_escalator_rule_4"),
        ((F.col("hints_requested") > 0) & free, "show_hint", "L1", "fast_escalator_rule_5"),
        (run >= 2, "show_explanation", "L2", "fast_escalator_rule_2"),
        ((run >= 1) & free, "offer_hint", "L1", "fast_escalator_rule_1"),
    ], ("wait", level, "fast_escalator_default"))


def slow_policy() -> Column:
    """Waits for clear struggle, one error longer for learners who recovered twice."""
    run, stuck, level = F.col("consecutive_errors"), F.col("stuck"), F.col("escalation_level")
    patience = F.when(F.col("recoveries") >= 2, 1).otherwise(0)
    return _first_of([
        (stuck > 300, "escalate_to_l4", "L4", "slow_escalator_rule_5"),
        (F.col("same_three"), "show_explanation", "L3", "slow_escalator_rule_4"),
        ((run >= 5 + patience) | (F.col("hints_requested") >= 2), "show_explanation", "L2", "slow_escalator_rule_3"),
        (((run >= 3 + patience) | (stuck > 120)) & (level == "L0"), "offer_hint", "L1", "slow_escalator_rule_2"),
        (run.between(1, 2), "wait", level, "slow_escalator_rule_1"),
    ], ("wait", level, "slow_escalator_default"))


def adaptive_policy() -> Column:
    """By a strain score: errors in a row, repeats and time stuck, less resilience and novelty."""
    point = lambda c, n: F.when(c, n).otherwise(0)
    strain = F.col("consecutive_errors") + point(F.col("repeated"), 2) + F.floor(F.col("stuck") / 60).cast("int") - point(F.col("recoveries") >= 2, 1) - point(F.col("concepts") <= 2, 1)
    strain, level = F.greatest(F.lit(0), strain), F.col("escalation_level")
    return _first_of([
        (strain >= 5, "show_explanation", "L3", "adaptive_escalator_rule_2"),
        (strain == 4, "show_explanation", "L2", "adaptive_escalator_rule_3"),
        (strain == 3, "offer_hint", "L1", "adaptive_escalator_rule_4"),
        (F.col("hints_requested") > 0, "show_hint", "L1", "adaptive_escalator_rule_6a"),
    ], ("wait", level, "adaptive_escalator_rule_5"))


POLICIES = {"fast_escalator": fast_policy, "slow_escalator": slow_policy, "adaptive_escalator": adaptive_policy}


def decide(state: DataFrame, policies: dict | None = None) -> DataFrame:
    """trace_id, seq, policy_id, action, target_level, rule: what each policy does at each event."""
    each = F.explode(F.array(*(F.struct(F.lit(name).alias("policy_id"), p().alias("d")) for name, p in (policies or POLICIES).items())))
    return state.select("*", each.alias("p")).select(*state.columns, "p.policy_id", F.col("p.d.action").alias("action"), F.col("p.d.level").alias("target_level"), F.col("p.d.rule").alias("rule"))


def replay(rows: DataFrame, policies: dict | None = None) -> DataFrame:
    """Decision points: events where a policy acts, or that escalate themselves; a concept with three errors so far violates its prerequisites."""
    on_concept = Window.partitionBy("trace_id", "concept_id").orderBy("seq").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    state = learner_state(rows).withColumn("violation", F.sum(F.when(is_error(), 1).otherwise(0)).over(on_concept) >= 3)
    return decide(state, policies).filter((F.col("action") != "wait") | is_escalation())


def replay_summary(points: DataFrame) -> DataFrame:
    """Per policy: traces, decision points, actions, violations and actions per trace."""
    per_trace = points.groupBy("policy_id", "trace_id").agg(F.count("*").alias("n"), F.sum(F.when(F.col("action") != "wait", 1).otherwise(0)).alias("a"), F.sum(F.col("violation").cast("int")).alias("v"))
    return per_trace.groupBy("policy_id").agg(F.count("*").alias("traces"), F.sum("n").alias("decision_points"), F.sum("a").alias("escalations"), F.sum("v").alias("violations"), F.round(F.avg("a"), 4).alias("avg_escalations"))


def problems(rows: DataFrame) -> DataFrame:
    """Per trace: distinct problems and concepts, duration."""
    return rows.groupBy("trace_id").agg(F.count("*").alias("events"), F.count_distinct("problem_id").alias("problems"), F.count_distinct("concept_id").alias("concepts"), F.sum(is_error().cast("int")).alias("errors"), F.sum(is_escalation().cast("int")).alias("escalations"), (F.max_by("t", "seq") - F.min_by("t", "seq")).alias("duration"))


def hint_dependency(rows: DataFrame) -> DataFrame:
    """trace_id, hdi and its parts."""
    t = F.col("event_type")
    marks = rows.withColumns({
        "explained": F.max(F.when(t == "explanation_shown", 1).otherwise(0)).over(before()),
        # 1: an error still open, 0: closed by a hint or a solution
        "open": F.last(F.when(is_error(), 1).when(t.isin("hint_requested", "problem_solved"), 0), ignorenulls=True).over(before()),
    })
    n = lambda c: F.sum(F.when(c, 1).otherwise(0))
    sums = marks.groupBy("trace_id").agg(
        n(t.isin("hint_requested", "hint_shown")).alias("hints"), n(t.isin("explanation_requested", "explanation_shown")).alias("explanations"), F.greatest(n(t.isin("problem_attempt", "error_recorded")), F.lit(1)).alias("attempts"),
        F.avg(F.expr("try_cast(substr(escalation_level, 2) as int)")).alias("level"), F.count_distinct("problem_id").alias("problems"),
        n((F.col("explained") == 1) & is_error() & (t != "explanation_shown")).alias("late"), n((t == "problem_solved") & ~is_error() & (F.col("open") == 1)).alias("own"),
    )
    parts = sums.select("trace_id", F.least(F.col("hints") / F.col("attempts"), F.lit(1.0)).alias("f"), (F.col("level") / 4).alias("d"), (F.col("explanations") / F.greatest("problems", F.lit(1))).alias("x"), F.least(F.col("late") * 0.2, F.lit(0.5)).cast("double").alias("p"), F.least(F.col("own") * 0.1, F.lit(0.3)).cast("double").alias("r"))
    value = F.greatest(F.lit(0.0), F.least(F.lit(1.0), 0.3 * F.col("f") + 0.3 * F.col("d") + 0.2 * F.col("x") + 0.2 * F.col("p") - F.col("r")))
    return parts.select("trace_id", _round4(value).alias("hdi"), F.round("f", 4).alias("hint_frequency"), F.round("p", 4).alias("post_explanation_penalty"), F.round("r", 4).alias("recovery_bonus"))


def cognitive_strain(rows: DataFrame) -> DataFrame:
    """trace_id, csi: bursts of errors, rapid actions, pauses before help, help per problem and the longest run of errors."""
    errors_only = F.last(F.when(is_error(), F.col("t")), ignorenulls=True).over(before())
    rows = rows.withColumns({"prev_error": errors_only, "prev": F.lag("t").over(order()), "grp": _count(~is_error() & (F.col("event_type") == "problem_solved"))})
    run = F.sum(is_error().cast("int")).over(Window.partitionBy("trace_id", "grp"))
    n = lambda c: F.sum(F.when(c, 1).otherwise(0))
    sums = rows.withColumn("run", run).groupBy("trace_id").agg(
        n(is_error() & (F.col("t") - F.col("prev_error") < 30)).alias("bursts"), n(F.col("t") - F.col("prev") < 10).alias("rapid"),
        F.sum(F.when(is_escalation() & (F.col("time_stuck") != 0), F.least(F.col("time_stuck") * 0.001, F.lit(0.1))).otherwise(0.0)).alias("pause"),
        n(is_escalation()).alias("esc"), F.count_distinct("problem_id").alias("problems"), F.max("run").alias("run"),
    )
    value = F.col("bursts") * F.lit(0.15) + F.col("rapid") * F.lit(0.1) + F.least("pause", F.lit(0.3)) + F.col("esc") / F.greatest("problems", F.lit(1)) * F.lit(0.3) + F.greatest(F.lit(0), F.col("run") - 2) * F.lit(0.05)
    return sums.select("trace_id", _round4(F.greatest(F.lit(0.0), F.least(F.lit(1.0), value))).alias("csi"), "bursts", "rapid", F.col("run").alias("longest_run"))


def persistence(rows: DataFrame) -> DataFrame:
    """trace_id, score, longest repeat of one subtype among the errors (a single error does not count), subtypes."""
    errors = rows.filter(is_error())
    new = F.when(F.lag("error_subtype").over(order()) == F.col("error_subtype"), 0).otherwise(1)
    runs = errors.withColumn("new", new).withColumn("grp", F.sum("new").over(so_far())).groupBy("trace_id", "grp").agg(F.count("*").alias("n"), F.first("error_subtype").alias("s"))
    found = runs.groupBy("trace_id").agg(F.max(F.when(F.col("n") >= 2, F.col("n")).otherwise(0)).alias("longest"), F.count_distinct("s").alias("subtypes"))
    every = rows.select("trace_id").distinct().join(found, "trace_id", "left").na.fill(0, ["longest", "subtypes"])
    return every.select("trace_id", F.round(F.least(F.col("longest") / 5.0, F.lit(1.0)), 4).alias("score"), "longest", "subtypes")


def coverage(rows: DataFrame, available: int = 10) -> DataFrame:
    """trace_id, score, concepts, abandoned: concepts met, less those without a solution."""
    n = lambda c: F.sum(F.when(c, 1).otherwise(0))
    solved = F.collect_set(F.when(F.col("event_type") == "problem_solved", F.col("concept_id")))
    sums = rows.groupBy("trace_id").agg(F.count_distinct("concept_id").alias("concepts"), n(F.col("event_type") == "save_unit").alias("units"), n(F.col("event_type") == "save_note").alias("notes"), F.size(F.array_except(F.collect_set("concept_id"), solved)).alias("abandoned"))
    value = F.col("concepts") / available + F.least(F.col("units") * F.lit(0.1), F.lit(0.3)) + F.least(F.col("notes") * F.lit(0.1), F.lit(0.2)) - F.least(F.col("abandoned") * F.lit(0.1), F.lit(0.3))
    return sums.select("trace_id", F.round(F.greatest(F.lit(0.0), F.least(F.lit(1.0), value)), 4).alias("score"), "concepts", "abandoned")


def time_to_success(rows: DataFrame) -> DataFrame:
    """trace_id, score, seconds, solved: from a problem's first event to its last solution; 1 up to 60, 0 from 600."""
    each = rows.filter("problem_id is not null").groupBy("trace_id", "problem_id").agg(F.min_by("t", "seq").alias("a"), F.max_by(F.when(F.col("event_type") == "problem_solved", F.col("t")), F.when(F.col("event_type") == "problem_solved", F.col("seq"))).alias("b"))
    sums = each.groupBy("trace_id").agg(F.avg(F.col("b") - F.col("a")).alias("mean"), F.count("b").alias("solved"))
    value = F.greatest(F.lit(0.0), F.least(F.lit(1.0), 1.0 - (F.col("mean") - 60) / 540))
    return sums.select("trace_id", F.when(F.col("solved") > 0, F.round(value, 4)).otherwise(0.0).alias("score"), F.when(F.col("solved") > 0, F.round("mean", 2)).otherwise(0.0).alias("seconds"), "solved")


def productive_struggle(rows: DataFrame) -> DataFrame:
    """trace_id, aps: from a neutral half, recoveries add; repeats, hasty help, leaving problems, idling and bursts take away."""
    t, time = F.col("event_type"), F.col("t")
    solved_so_far = F.collect_set(F.when(t == "problem_solved", F.col("problem_id"))).over(before())
    ahead = Window.partitionBy("trace_id").orderBy("t").rangeBetween(Window.currentRow, 60)
    on_problem = Window.partitionBy("trace_id", "problem_id").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    marks = rows.withColumns({
        "last_subtype": F.last("error_subtype", ignorenulls=True).over(before()), "last_error": F.last(F.when(is_error(), time), ignorenulls=True).over(before()),
        "left": F.lag("problem_id").over(order()), "solved": solved_so_far,
        "close": F.when(is_error(), F.sum(is_error().cast("int")).over(ahead)).otherwise(0), "tries": F.coalesce(F.sum(is_error().cast("int")).over(on_problem), F.lit(0)),
    })
    n = lambda c: F.sum(F.when(c, 1).otherwise(0))
    sums = marks.groupBy("trace_id").agg(
        n(is_error() & (F.col("error_subtype") == F.col("last_subtype"))).alias("repeats"), n(~is_error() & is_escalation() & (F.col("last_error") != 0) & (time != 0) & (time - F.col("last_error") < 20)).alias("hasty"),
        n(F.col("left").isNotNull() & (F.col("left") != F.col("problem_id")) & ~F.array_contains("solved", F.col("left"))).alias("switches"), n(F.col("gap") > 60).alias("idle"),
        F.max("close").alias("close"), n(~is_error() & (t == "problem_solved") & (F.col("tries") >= 2)).alias("recoveries"),
    )
    value = F.lit(0.5) + F.col("recoveries") * F.lit(0.1) - F.col("repeats") * F.lit(0.15) - F.col("hasty") * F.lit(0.1) - F.col("switches") * F.lit(0.2) - F.col("idle") * F.lit(0.05) - F.when(F.col("close") >= 3, 0.1).otherwise(0.0)
    return sums.select("trace_id", F.round(F.greatest(F.lit(0.0), F.least(F.lit(1.0), value)), 4).alias("aps"), "repeats", "hasty", "switches", "idle", "recoveries")


# Words that show reflection in a note, and signs of code in one.
REFLECTIVE = ["why", "because", "understand", "realize", "realized", "think", "thought", "learned", "confused", "clarified", "mistake", "error", "fix", "solution", "approach"]
CODE_SIGNS = [";", "{", "}", "select", "from", "where", "="]


def reflection(notes: DataFrame) -> DataFrame:
    """trace_id, score, notes, questions of (trace_id, note): length, questions, reflective words and code in notes."""
    note, low = F.col("note"), F.lower(F.col("note"))
    size = F.size(F.filter(F.split(note, r"\s+", -1), lambda x: x != ""))
    questions = F.length(note) - F.length(F.replace(note, F.lit("?"), F.lit("")))
    keywords = sum((F.contains(low, F.lit(w)).cast("int") for w in REFLECTIVE), F.lit(0))
    code = F.lit(False)
    for sign in CODE_SIGNS:
        code = code | F.contains(note, F.lit(sign))
    score = F.when(size <= 5, 0.2).when(size <= 20, 0.5).otherwise(0.8) + F.least(questions * F.lit(0.1), F.lit(0.2)) + F.least(keywords * F.lit(0.1), F.lit(0.3)) + F.when(code, 0.2).otherwise(0.0)
    each = notes.filter(note != "").select("trace_id", F.least(score, F.lit(1.0)).alias("s"), questions.alias("q"))
    return each.groupBy("trace_id").agg(F.round(F.avg("s"), 4).alias("score"), F.count("*").alias("notes"), F.sum("q").alias("questions"))
