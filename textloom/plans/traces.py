"""Trace queries over the event table."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import traces as T
from .registry import query, sql_text

V = """
v0 AS (SELECT event_id, user_id, value, event_type AS raw, epoch_us(ts) AS us, CAST(json_extract(props, '$.k') AS INT) AS k FROM events),
v1 AS (SELECT *, user_id || '-w' || CAST(floor((us - 1704067200000000) / 604800000000.0::DOUBLE) AS BIGINT) AS trace_id FROM v0),
v AS (SELECT trace_id, event_id, row_number() OVER w AS seq, 'p' || (k % 12) AS problem_id, 'c' || (k % 7) AS concept_id,
 CASE raw WHEN 'signup' THEN 'problem_attempt' WHEN 'click' THEN 'hint_requested' WHEN 'view' THEN 'explanation_shown' WHEN 'error' THEN 'error_recorded' WHEN 'purchase' THEN 'problem_solved' ELSE raw END AS event_type,
 CASE WHEN raw = 'error' THEN 'e' || (k % 3) END AS error_subtype, CASE raw WHEN 'click' THEN 'L1' WHEN 'view' THEN 'L2' ELSE 'L0' END AS escalation_level,
 (us - min(us) OVER (PARTITION BY trace_id)) / 1800000000.0::DOUBLE AS t, coalesce((us - lag(us) OVER w) / 1800000000.0::DOUBLE, 0.0::DOUBLE) AS gap, value AS time_stuck
 FROM v1 WINDOW w AS (PARTITION BY trace_id ORDER BY us, event_id))"""
ESC = "event_type IN ('hint_requested', 'hint_shown', 'explanation_requested', 'explanation_shown', 'escalation_triggered')"
ERR = "error_subtype IS NOT NULL"
SOFAR = "(PARTITION BY trace_id ORDER BY seq ROWS UNBOUNDED PRECEDING)"
BEFORE = "(PARTITION BY trace_id ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"


def n(c: str, over: str = "") -> str:
    return f"CAST(sum(CASE WHEN {c} THEN 1 ELSE 0 END){' OVER ' + over if over else ''} AS BIGINT)"


STATE = f"""{V},
g AS (SELECT *, {n("event_type IN ('problem_solved', 'problem_abandoned')", SOFAR)} AS grp FROM v),
c AS (SELECT *, {n(ERR, '(PARTITION BY trace_id, grp ORDER BY seq ROWS UNBOUNDED PRECEDING)')} AS consecutive_errors FROM g),
l AS (SELECT *, coalesce(lag(consecutive_errors) OVER (PARTITION BY trace_id ORDER BY seq), 0) AS run_before, last_value(error_subtype IGNORE NULLS) OVER {BEFORE} AS last_subtype, list(error_subtype) FILTER ({ERR}) OVER {SOFAR} AS subtypes FROM c),
state AS (SELECT *, {n(ERR, SOFAR)} AS total_errors, {n("event_type IN ('hint_requested', 'hint_shown')", SOFAR)} AS hints_requested, {n("event_type = 'explanation_shown'", SOFAR)} AS explanations_shown,
 {n("event_type = 'problem_solved' AND run_before > 0", SOFAR)} AS recoveries, coalesce(bool_or({ERR} AND last_subtype = error_subtype) OVER {SOFAR}, false) AS repeated,
 coalesce(last_value(CASE WHEN time_stuck <> 0 THEN time_stuck END IGNORE NULLS) OVER {SOFAR}, 0.0::DOUBLE) AS stuck, len(list_distinct(list(concept_id) OVER {SOFAR})) AS concepts,
 {ERR} AND len(list_filter(list_reverse(subtypes)[1:3], lambda x: x = error_subtype)) >= 3 AS same_three FROM l)"""
STATE_COLUMNS = ["trace_id", "seq", "consecutive_errors", "total_errors", "hints_requested", "explanations_shown", "recoveries", "repeated", "stuck", "concepts", "same_three"]


def _case(rules: list[tuple[str, str, str, str]], default: str) -> str:
    whens = " ".join(f"WHEN {c} THEN {{'action': '{a}', 'level': {level}, 'rule': '{r}'}}" for c, a, level, r in rules)
    return f"CASE {whens} ELSE {{'action': 'wait', 'level': escalation_level, 'rule': '{default}'}} END"


FAST = _case([
    ("repeated AND consecutive_errors >= 2", "escalate_to_l3", "'L3'", "fast_escalator_rule_3"), ("consecutive_errors >= 4 OR stuck > 120", "escalate_to_l4", "'L4'", "fast_escalator_rule_6"),
    ("consecutive_errors >= 3", "escalate_to_l3", "'L3'", "fast_escalator_rule_3"), ("stuck > 60 AND escalation_level = 'L0'", "show_hint", "'L1'", "fast_escalator_rule_4"),
    ("hints_requested > 0 AND escalation_level = 'L0'", "show_hint", "'L1'", "fast_escalator_rule_5"), ("consecutive_errors >= 2", "show_explanation", "'L2'", "fast_escalator_rule_2"),
    ("consecutive_errors >= 1 AND escalation_level = 'L0'", "offer_hint", "'L1'", "fast_escalator_rule_1"),
], "fast_escalator_default")
_PAT = "(CASE WHEN recoveries >= 2 THEN 1 ELSE 0 END)"
SLOW = _case([
    ("stuck > 300", "escalate_to_l4", "'L4'", "slow_escalator_rule_5"), ("same_three", "show_explanation", "'L3'", "slow_escalator_rule_4"),
    (f"consecutive_errors >= 5 + {_PAT} OR hints_requested >= 2", "show_explanation", "'L2'", "slow_escalator_rule_3"),
    (f"(consecutive_errors >= 3 + {_PAT} OR stuck > 120) AND escalation_level = 'L0'", "offer_hint", "'L1'", "slow_escalator_rule_2"),
    ("consecutive_errors BETWEEN 1 AND 2", "wait", "escalation_level", "slow_escalator_rule_1"),
], "slow_escalator_default")
_STRAIN = "greatest(0, consecutive_errors + CASE WHEN repeated THEN 2 ELSE 0 END + CAST(floor(stuck / 60) AS INT) - CASE WHEN recoveries >= 2 THEN 1 ELSE 0 END - CASE WHEN concepts <= 2 THEN 1 ELSE 0 END)"
ADAPTIVE = _case([
    (f"{_STRAIN} >= 5", "show_explanation", "'L3'", "adaptive_escalator_rule_2"), (f"{_STRAIN} = 4", "show_explanation", "'L2'", "adaptive_escalator_rule_3"),
    (f"{_STRAIN} = 3", "offer_hint", "'L1'", "adaptive_escalator_rule_4"), ("hints_requested > 0", "show_hint", "'L1'", "adaptive_escalator_rule_6a"),
], "adaptive_escalator_rule_5")
CASES = {"fast_escalator": FAST, "slow_escalator": SLOW, "adaptive_escalator": ADAPTIVE}
DECIDED = ", decided AS (" + " UNION ALL ".join(f"SELECT *, '{p}' AS policy_id, {c} AS d FROM state" for p, c in CASES.items()) + ")"

tr = lambda t: T.traces(t("events"))

query("trc0_traces", f"WITH {V} SELECT * FROM v")(tr)
query("trc1_event_predicates", f"WITH {V} SELECT trace_id, seq, {ERR} OR event_type IN ('error_recorded', 'problem_abandoned') AS is_error, {ESC} AS is_escalation FROM v")(
    lambda t: tr(t).select("trace_id", "seq", (T.is_error() | F.col("event_type").isin("error_recorded", "problem_abandoned")).alias("is_error"), T.is_escalation().alias("is_escalation")))
query("trc2_trace_profile", f"WITH {V} SELECT trace_id, count(*) AS events, count(DISTINCT problem_id) AS problems, count(DISTINCT concept_id) AS concepts, {n(ERR)} AS errors, {n(ESC)} AS escalations, arg_max(t, seq) - arg_min(t, seq) AS duration FROM v GROUP BY trace_id")(lambda t: T.problems(tr(t)))
query("trc3_validation", """
WITH e AS (SELECT user_id, event_id, ts, lag(ts) OVER (PARTITION BY user_id ORDER BY event_id) AS prev, props FROM events)
SELECT user_id, count(*) AS events, sum(CASE WHEN ts < prev THEN 1 ELSE 0 END)::BIGINT AS out_of_order, sum(CASE WHEN props IS NULL THEN 1 ELSE 0 END)::BIGINT AS missing FROM e GROUP BY user_id
""")(lambda t: t("events").withColumn("prev", F.lag("ts").over(Window.partitionBy("user_id").orderBy("event_id"))).groupBy("user_id").agg(F.count("*").alias("events"), F.sum(F.when(F.col("ts") < F.col("prev"), 1).otherwise(0)).alias("out_of_order"), F.sum(F.col("props").isNull().cast("int")).alias("missing")))
query("pol1_learner_state", f"WITH {STATE} SELECT {', '.join(STATE_COLUMNS)} FROM state")(lambda t: T.learner_state(tr(t)).select(*STATE_COLUMNS))
for _k, (_p, _c) in enumerate(CASES.items()):
    query(f"pol{_k + 2}_{_p}", f"WITH {STATE}, r AS (SELECT trace_id, seq, {_c} AS d FROM state) SELECT trace_id, seq, d.action AS action, d.level AS target_level, d.rule AS rule FROM r")(
        lambda t, p=_p: T.decide(T.learner_state(tr(t)), {p: T.POLICIES[p]}).select("trace_id", "seq", "action", "target_level", "rule"))
_VIOL = f"{n(ERR, '(PARTITION BY trace_id, concept_id, policy_id ORDER BY seq ROWS UNBOUNDED PRECEDING)')} >= 3 AS violation"
_POINTS = f"{DECIDED}, q AS (SELECT *, {_VIOL} FROM decided), points AS (SELECT * FROM q WHERE d.action <> 'wait' OR {ESC})"
query("rpl1_replay", f"WITH {STATE} {_POINTS} SELECT policy_id, trace_id, seq, event_type, d.action AS action, d.level AS target_level, d.rule AS rule FROM points")(
    lambda t: T.replay(tr(t)).select("policy_id", "trace_id", "seq", "event_type", "action", "target_level", "rule"))
query("rpl2_prerequisite_violations", f"WITH {STATE} {_POINTS} SELECT policy_id, trace_id, count(*) AS violations FROM points WHERE violation GROUP BY ALL")(
    lambda t: T.replay(tr(t)).filter("violation").groupBy("policy_id", "trace_id").agg(F.count("*").alias("violations")))
query("rpl5_policy_comparison", f"""WITH {STATE} {_POINTS}, x AS (SELECT policy_id, trace_id, count(*) AS n, {n("d.action <> 'wait'")} AS a, {n('violation')} AS v FROM points GROUP BY ALL)
SELECT policy_id, count(*) AS traces, sum(n)::BIGINT AS decision_points, sum(a)::BIGINT AS escalations, sum(v)::BIGINT AS violations, round(avg(a), 4) AS avg_escalations FROM x GROUP BY policy_id""")(lambda t: T.replay_summary(T.replay(tr(t))))
query("met1_hint_dependency", f"""WITH {V},
m AS (SELECT *, max(CASE WHEN event_type = 'explanation_shown' THEN 1 ELSE 0 END) OVER {BEFORE} AS explained, last_value(CASE WHEN {ERR} THEN 1 WHEN event_type IN ('hint_requested', 'problem_solved') THEN 0 END IGNORE NULLS) OVER {BEFORE} AS open_ FROM v),
s AS (SELECT trace_id, {n("event_type IN ('hint_requested', 'hint_shown')")} AS hints, {n("event_type IN ('explanation_requested', 'explanation_shown')")} AS explanations, greatest({n("event_type IN ('problem_attempt', 'error_recorded')")}, 1) AS attempts,
 avg(CAST(substr(escalation_level, 2) AS INT)) AS level, count(DISTINCT problem_id) AS problems, {n(f"explained = 1 AND {ERR} AND event_type <> 'explanation_shown'")} AS late, {n(f"event_type = 'problem_solved' AND NOT ({ERR}) AND open_ = 1")} AS own FROM m GROUP BY trace_id),
p AS (SELECT trace_id, least(hints / attempts::DOUBLE, 1.0::DOUBLE) AS f, level / 4 AS d, explanations / greatest(problems, 1)::DOUBLE AS x, least(late * 0.2::DOUBLE, 0.5::DOUBLE) AS p, least(own * 0.1::DOUBLE, 0.3::DOUBLE) AS r FROM s)
SELECT trace_id, round(CAST(greatest(0.0::DOUBLE, least(1.0::DOUBLE, 0.3::DOUBLE * f + 0.3::DOUBLE * d + 0.2::DOUBLE * x + 0.2::DOUBLE * p - r)) AS DECIMAL(18, 9)), 4)::DOUBLE AS hdi, round(f, 4) AS hint_frequency, round(p, 4) AS post_explanation_penalty, round(r, 4) AS recovery_bonus FROM p""")(lambda t: T.hint_dependency(tr(t)))
query("met2_cognitive_strain", f"""WITH {V},
m AS (SELECT *, last_value(CASE WHEN {ERR} THEN t END IGNORE NULLS) OVER {BEFORE} AS prev_error, lag(t) OVER (PARTITION BY trace_id ORDER BY seq) AS prev, {n(f"NOT ({ERR}) AND event_type = 'problem_solved'", SOFAR)} AS grp FROM v),
r AS (SELECT *, {n(ERR, '(PARTITION BY trace_id, grp)')} AS run FROM m),
s AS (SELECT trace_id, {n(f"{ERR} AND t - prev_error < 30")} AS bursts, {n("t - prev < 10")} AS rapid, sum(CASE WHEN {ESC} AND time_stuck <> 0 THEN least(time_stuck * 0.001::DOUBLE, 0.1::DOUBLE) ELSE 0.0 END) AS pause, {n(ESC)} AS esc, count(DISTINCT problem_id) AS problems, max(run) AS longest_run FROM r GROUP BY trace_id)
SELECT trace_id, round(CAST(greatest(0.0::DOUBLE, least(1.0::DOUBLE, bursts * 0.15::DOUBLE + rapid * 0.1::DOUBLE + least(pause, 0.3::DOUBLE) + esc / greatest(problems, 1)::DOUBLE * 0.3::DOUBLE + greatest(0, longest_run - 2) * 0.05::DOUBLE)) AS DECIMAL(18, 9)), 4)::DOUBLE AS csi, bursts, rapid, longest_run FROM s""")(lambda t: T.cognitive_strain(tr(t)))
query("met3_productive_struggle", f"""WITH {V},
m AS (SELECT *, last_value(error_subtype IGNORE NULLS) OVER {BEFORE} AS last_subtype, last_value(CASE WHEN {ERR} THEN t END IGNORE NULLS) OVER {BEFORE} AS last_error, lag(problem_id) OVER (PARTITION BY trace_id ORDER BY seq) AS left_,
 coalesce(list(problem_id) FILTER (event_type = 'problem_solved') OVER {BEFORE}, []) AS solved, CASE WHEN {ERR} THEN {n(ERR, '(PARTITION BY trace_id ORDER BY t RANGE BETWEEN CURRENT ROW AND 60 FOLLOWING)')} ELSE 0 END AS close_,
 coalesce({n(ERR, '(PARTITION BY trace_id, problem_id ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)')}, 0) AS tries FROM v),
s AS (SELECT trace_id, {n(f"{ERR} AND error_subtype = last_subtype")} AS repeats, {n(f"NOT ({ERR}) AND {ESC} AND last_error <> 0 AND t <> 0 AND t - last_error < 20")} AS hasty, {n("left_ IS NOT NULL AND left_ <> problem_id AND NOT list_contains(solved, left_)")} AS switches,
 {n("gap > 60")} AS idle, max(close_) AS close_, {n(f"NOT ({ERR}) AND event_type = 'problem_solved' AND tries >= 2")} AS recoveries FROM m GROUP BY trace_id)
SELECT trace_id, round(greatest(0.0::DOUBLE, least(1.0::DOUBLE, 0.5::DOUBLE + recoveries * 0.1::DOUBLE - repeats * 0.15::DOUBLE - hasty * 0.1::DOUBLE - switches * 0.2::DOUBLE - idle * 0.05::DOUBLE - CASE WHEN close_ >= 3 THEN 0.1::DOUBLE ELSE 0.0::DOUBLE END)), 4) AS aps, repeats, hasty, switches, idle, recoveries FROM s""")(lambda t: T.productive_struggle(tr(t)))
query("met4_persistence", f"""WITH {V}, e AS (SELECT *, CASE WHEN lag(error_subtype) OVER (PARTITION BY trace_id ORDER BY seq) = error_subtype THEN 0 ELSE 1 END AS new_ FROM v WHERE {ERR}),
g AS (SELECT *, sum(new_) OVER {SOFAR} AS grp FROM e), r AS (SELECT trace_id, grp, count(*) AS n, any_value(error_subtype) AS s FROM g GROUP BY ALL),
f AS (SELECT trace_id, max(CASE WHEN n >= 2 THEN n ELSE 0 END) AS longest, count(DISTINCT s) AS subtypes FROM r GROUP BY trace_id)
SELECT trace_id, round(least(coalesce(longest, 0) / 5.0::DOUBLE, 1.0::DOUBLE), 4) AS score, coalesce(longest, 0) AS longest, coalesce(subtypes, 0) AS subtypes FROM (SELECT DISTINCT trace_id FROM v) LEFT JOIN f USING (trace_id)""")(lambda t: T.persistence(tr(t)))
query("met5_coverage", f"""WITH {V}, s AS (SELECT trace_id, count(DISTINCT concept_id) AS concepts, count(DISTINCT concept_id) - count(DISTINCT CASE WHEN event_type = 'problem_solved' THEN concept_id END) AS abandoned FROM v GROUP BY trace_id)
SELECT trace_id, round(greatest(0.0::DOUBLE, least(1.0::DOUBLE, concepts / 10::DOUBLE - least(abandoned * 0.1::DOUBLE, 0.3::DOUBLE))), 4) AS score, concepts, abandoned FROM s""")(lambda t: T.coverage(tr(t)))
query("met6_time_to_success", f"""WITH {V}, p AS (SELECT trace_id, problem_id, arg_min(t, seq) AS a, arg_max(t, seq) FILTER (event_type = 'problem_solved') AS b FROM v GROUP BY ALL),
s AS (SELECT trace_id, avg(b - a) AS mean, count(b) AS solved FROM p GROUP BY trace_id)
SELECT trace_id, CASE WHEN solved > 0 THEN round(greatest(0.0::DOUBLE, least(1.0::DOUBLE, 1.0::DOUBLE - (mean - 60) / 540)), 4) ELSE 0.0 END AS score, CASE WHEN solved > 0 THEN round(mean, 2) ELSE 0.0 END AS seconds, solved FROM s""")(lambda t: T.time_to_success(tr(t)))
_kws = " + ".join(f"CAST(contains(lower(text), '{w}') AS INT)" for w in T.REFLECTIVE)
_code = " OR ".join(f"contains(text, {sql_text(w)})" for w in T.CODE_SIGNS)
query("met7_reflection", f"""WITH m AS (SELECT conv_id AS trace_id, len(list_filter(regexp_split_to_array(text, '[\\s\\x0b]+'), lambda x: x <> '')) AS size, length(text) - length(replace(text, '?', '')) AS q, {_kws} AS kw, {_code} AS code FROM conversations WHERE role = 'user' AND text <> ''),
s AS (SELECT trace_id, q, least(CASE WHEN size <= 5 THEN 0.2::DOUBLE WHEN size <= 20 THEN 0.5::DOUBLE ELSE 0.8::DOUBLE END + least(q * 0.1::DOUBLE, 0.2::DOUBLE) + least(kw * 0.1::DOUBLE, 0.3::DOUBLE) + CASE WHEN code THEN 0.2::DOUBLE ELSE 0.0 END, 1.0::DOUBLE) AS s FROM m)
SELECT trace_id, round(avg(s), 4) AS score, count(*) AS notes, sum(q)::BIGINT AS questions FROM s GROUP BY trace_id""")(lambda t: T.reflection(t("conversations").filter("role = 'user'").select(F.col("conv_id").alias("trace_id"), F.col("text").alias("note"))))
