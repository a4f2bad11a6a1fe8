import random

from pyspark.sql import functions as F

from textloom.operators import cleaning, concepts, gates, learning, retrieval, structure, traces
from textloom.sources import files


def test_fixed_chunks_cover_all_words(spark):
    words = [f"w{i}" for i in range(401)]
    rows = retrieval.fixed_chunks(spark.createDataFrame([(1, " ".join(words)), (2, ""), (3, "one")], "doc_id long, text string")).collect()
    assert {w for r in rows if r["doc_id"] == 1 for w in r["text"].split()} == set(words)
    assert [r["text"] for r in rows if r["doc_id"] == 3] == ["one"]
    assert not [r for r in rows if r["doc_id"] == 2]


def test_sentence_chunks_follow_sentences(spark):
    text = " ".join(f"w{i}." if i % 37 == 36 else f"w{i}" for i in range(500))
    rows = sorted(retrieval.sentence_chunks(spark.createDataFrame([(7, text), (8, None)], "doc_id long, text string")).collect(), key=lambda r: r["n"])
    assert [r["n"] for r in rows] == list(range(1, len(rows) + 1))
    for r in rows:
        assert text[r["char_start"] : r["char_end"]] == r["text"]
    assert rows[-1]["text"].endswith("w499")


def test_headers_need_five_pages(spark):
    page = lambda n: spark.createDataFrame([("d", i, f"HEAD\nbody {i}\nFOOT") for i in range(1, n + 1)], "doc string, page int, text string")
    assert cleaning.strip_headers_footers(page(5)).filter("page = 2").first()["result"] == "body 2"
    assert cleaning.strip_headers_footers(page(4)).filter("page = 2").first()["result"] == "HEAD\nbody 2\nFOOT"


def _state_by_loop(events):
    run = recoveries = errors = hints = 0
    repeated, last = False, None
    out = []
    for e in events:
        if e[2] == "problem_solved":
            recoveries += run > 0
            run = 0
        elif e[2] == "problem_abandoned":
            run = 0
        if e[3]:
            errors, run = errors + 1, run + 1
            repeated |= last == e[3]
            last = e[3]
        hints += e[2] in ("hint_requested", "hint_shown")
        out.append((run, errors, hints, recoveries, repeated))
    return out


def test_learner_state_equals_a_loop(spark):
    rng = random.Random(5)
    kinds = ["problem_attempt", "problem_solved", "problem_abandoned", "hint_requested", "hint_shown", "explanation_shown", "error_recorded"]
    rows, wanted = [], {}
    for t in range(40):
        events = [(f"t{t}", i + 1, rng.choice(kinds), rng.choice([None, None, "e1", "e2"])) for i in range(rng.randint(1, 30))]
        rows += [(*e, f"p{i % 3}", f"c{i % 2}", rng.choice(["L0", "L1"]), float(i), 0.0, float(rng.choice([0, 70, 400]))) for i, e in enumerate(events)]
        wanted |= {(e[0], e[1]): s for e, s in zip(events, _state_by_loop(events))}
    df = spark.createDataFrame(rows, "trace_id string, seq int, event_type string, error_subtype string, problem_id string, concept_id string, escalation_level string, t double, gap double, time_stuck double")
    state = traces.learner_state(df)
    for r in state.collect():
        assert (r["consecutive_errors"], r["total_errors"], r["hints_requested"], r["recoveries"], r["repeated"]) == wanted[r["trace_id"], r["seq"]]
    assert traces.decide(state).count() == 3 * len(rows)


def test_hierarchy_equals_a_stack(spark):
    rng = random.Random(6)
    rows, wanted = [], {}
    for d in range(30):
        stack = []
        for pos in range(25):
            level = rng.choice([None, None, 1, 2, 3, 4])
            if level is None:
                wanted[d, pos] = stack[-1][0] if stack else None
            else:
                while stack and stack[-1][1] >= level:
                    stack.pop()
                wanted[d, pos] = stack[-1][0] if stack else None
                stack.append((pos, level))
            rows.append((d, pos, level))
    got = structure.hierarchy(spark.createDataFrame(rows, "doc_id long, pos int, level int")).collect()
    # a heading's parent is the nearest smaller level; what is no heading hangs below the last heading
    for r in got:
        level = next(x[2] for x in rows if x[:2] == (r["doc_id"], r["pos"]))
        heads = [x for x in rows if x[0] == r["doc_id"] and x[1] < r["pos"] and x[2] is not None and (level is None or x[2] < level)]
        assert r["parent"] == (heads[-1][1] if heads else None)
        if level is not None:
            assert r["parent"] == wanted[r["doc_id"], r["pos"]]


def test_closure_survives_a_cycle(spark):
    links = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a")], "src string, dst string")
    got = {(r["src"], r["dst"]): r["depth"] for r in concepts.closure(links).collect()}
    assert got["a", "c"] == 2 and got["a", "a"] == 3 and len(got) == 9


def test_gate_of_an_empty_unit(spark):
    docs = spark.createDataFrame([(1, "", "s", 0), (2, None, "s", 0)], "doc_id long, text string, source string, n_chars long")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    units = gates.units(docs, labels)
    assert all(not r["passed"] for r in gates.concept_gate(units.filter("unit_id = 1")).collect())


def test_review_schedule(spark):
    rows = spark.createDataFrame([(1, 1, i, True, 10.0) for i in range(1, 4)], "learner long, concept long, seq int, correct boolean, seconds double")
    r = learning.schedule(rows).first()
    assert r["reviews"] == 3 and r["ease"] == 2.8 and abs(r["days"] - 16.2) < 1e-9


def test_integrity(spark):
    p, c = spark.createDataFrame([(1,), (1,), (2,)], "k int"), spark.createDataFrame([(1,), (9,)], "k int")
    assert {r["kind"]: r["rows"] for r in gates.integrity(p, c, "k").collect()} == {"orphans": 1, "unused": 1, "repeated": 1}


def test_library_round_trip(spark, tmp_path):
    units = spark.createDataFrame([(1, "a", "x"), (2, "b", "y")], "unit_id long, concept string, text string")
    links = spark.createDataFrame([("a", "b")], "src string, dst string")
    files.write_library(str(tmp_path), units, links)
    assert [r["unit_id"] for r in files.read_units(spark, str(tmp_path), "b").collect()] == [2]
    chunks = spark.createDataFrame([(1, 1, "t"), (1, 2, "u")], "doc_id long, n int, text string")
    first = files.write_index(f"{tmp_path}/i", chunks)
    assert first == files.write_index(f"{tmp_path}/j", chunks.orderBy(F.desc("n")))


def test_traces_leave_out_broken_files(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"trace_id": "t", "events": [{"event_id": "1", "event_type": "problem_attempt"}, {"event_id": "2"}]}')
    (tmp_path / "b.json").write_text("{no json")
    assert [(r["trace_id"], r["seq"], r["event_id"]) for r in files.read_traces(spark, str(tmp_path)).orderBy("seq").collect()] == [("t", 1, "1"), ("t", 2, "2")]


def test_chunk_ties_and_empty_queries(spark):
    chunks = spark.createDataFrame([(1, 1, [1.0, 0.0]), (2, 1, [1.0, 0.0])], "doc_id long, n int, v array<double>")
    queries = spark.createDataFrame([(9, [1.0, 0.0])], "query_id long, q array<double>")
    assert [r["doc_id"] for r in retrieval.top_chunks(queries, chunks, 1).collect()] == [1]
