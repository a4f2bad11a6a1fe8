"""Toxicity, quality, licences, rules, fingerprints and pages."""

import hashlib
import math
import random
import re
import unicodedata

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from textloom.llm import fingerprint, html_extract, license_scan, quality_classifier, quality_rules, toxicity, vec
from textloom.llm.bpe import code_points

EXTRA = ", uid string, tie string, bucket string"


# --- toxicity ------------------------------------------------------------------


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, before = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(before[j] + 1, row[j - 1] + 1, before[j - 1] + (x != y)))
    return row[-1]


def test_automaton_equals_the_distance():
    rng = random.Random(2)
    terms = [("abcde", False), ("caba", False), ("ddeeddeed", False), ("eabcd", True), ("bé", False)]
    words = ["".join(rng.choices("abcdeé", k=rng.randint(1, 11))) for _ in range(3000)] + [t for t, _ in terms]
    matcher = toxicity.Matcher(terms)
    data = np.frombuffer("".join(words).encode(), dtype=np.uint8)
    points, _ = code_points(data)
    ends = np.cumsum([len(w) for w in words])
    got = matcher.costs(points, ends - [len(w) for w in words], ends)
    for w, cost in zip(words, got.tolist()):
        wanted = 9
        for term, beginning in terms:
            most = sum(len(term) >= n for n in toxicity.FUZZY)
            d = min(distance(w[:k], term) for k in range(len(w) + 1)) if beginning else distance(w, term)
            if d <= most:
                wanted = min(wanted, d)
        assert cost == wanted, w


def test_quoted_hits_are_told_apart():
    pure, none = toxicity.Matcher([("moron", False)]), toxicity.Matcher([])
    data, offsets = vec.buffers(__import__("pyarrow").array(['he said "you moron" to them', "you moron", "you mroon moran", "", "morons"]))
    x = toxicity.features(data, offsets, pure, none)
    exact, near, said = (np.expm1(x[:, k]).round().astype(int).tolist() for k in range(3))
    assert said == [1, 0, 0, 0, 0]
    assert exact == [0, 1, 0, 0, 0]
    assert near == [0, 0, 1, 0, 1]


@pytest.mark.parametrize(("text", "quoted", "plain"), [
    ("he said “moron” and left", 1, 0), ("“moron”", 1, 0), ("don’t you moron, it’s over", 0, 1), ("It’s sad “he said” you moron “they said”", 0, 1),
    ("he wrote 'you moron' to them", 1, 0), ("don't you moron, it's over", 0, 1), ("„du moron“ sagte er", 1, 0), ("« vous moron »", 1, 0), ("»du moron«", 1, 0),
    ('"he said" you moron "they said"', 0, 1), ("the dogs' moron and the cats' tail", 0, 1), ("…moron!", 0, 1), ("‘you moron’", 1, 0), ("x “you moron " + "w " * 20 + "” x", 0, 1),
    ("彼は「moron」と言った", 0, 0), ("「moron」", 1, 0), ('"', 0, 0), ("moron", 0, 1),
])
def test_quotations_and_apostrophes(text, quoted, plain):
    pure, none = toxicity.Matcher([("moron", False)]), toxicity.Matcher([])
    x = toxicity.features(*vec.buffers(pa.array([text.lower()])), pure, none)
    assert [round(float(np.expm1(x[0, k]))) for k in (2, 0)] == [quoted, plain]


def test_marks_are_stripped_as_from_python_strings():
    rng = random.Random(6)
    letters = ["a", "é", "中", "々", "“", "…", "!", "'", "«", "。", "\u2003", "¿"]
    texts = ["".join(rng.choices(letters, k=rng.randint(1, 9))) for _ in range(500)]
    data, offsets = vec.buffers(pa.array(texts))
    start, end, doc, _, _ = toxicity.words(data, offsets)
    assert [data[a:b].tobytes().decode() for a, b in zip(start, end)] == [t.strip(toxicity._MARKS) for t in texts]


def labelled(spark):
    rng = random.Random(3)
    vocabulary = ["".join(rng.choices("abcdefghij", k=rng.randint(3, 9))) for _ in range(300)]
    rows, labels = [], []
    for i in range(600):
        words = rng.choices(vocabulary, k=rng.randint(20, 80))
        bad = rng.random() < 0.2
        if bad:
            for _ in range(3):
                words.insert(rng.randrange(len(words)), rng.choice(["zounds", "zxqwv", "zilch"]))
        if i % 7 == 0:
            words = words + [words[-1]] * 60
        rows.append((i, " ".join(words), "en", "s", "u", "t", "b"))
        labels.append((i, int(i % 7 != 0), int(bad)))
    rows += [(None, None, None, None, "u", "t", "b"), (5000, "", "en", "s", "u", "t", "b"), (5001, "word " * 30_000, "en", "s", "u", "t", "b"), (5001, "word " * 30_000, "en", "s", "u", "t", "b")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string" + EXTRA)
    return docs, spark.createDataFrame([*labels, (None, None, None)], "doc_id long, quality int, toxic int")


def accuracy(scored, labels, label):
    rows = scored.filter("held_out").join(labels, "doc_id").select("predicted", label).collect()
    return sum(r[0] == r[1] for r in rows) / len(rows)


def test_toxicity_on_held_out_rows(spark):
    docs, labels = labelled(spark)
    scored = toxicity.score(docs, labels).cache()
    assert scored.count() == docs.count()
    assert scored.filter("score is null or score < 0 or score > 1").count() == 0
    assert accuracy(scored, labels, "toxic") > 0.97
    assert scored.filter("doc_id = 5000").first()["predicted"] == 0


def test_classifiers_without_labels(spark):
    docs, _ = labelled(spark)
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r["score"] for r in toxicity.score(docs, none).select(F.round("score", 6).alias("score")).distinct().collect()} == {0.0}
    assert {r["score"] for r in quality_classifier.score(docs, none).select("score").distinct().collect()} == {0.5}
    assert toxicity.score(docs.limit(0), none).count() == 0


# --- quality ----------------------------------------------------------------------


def test_quality_on_held_out_rows(spark):
    docs, labels = labelled(spark)
    scored = quality_classifier.score(docs, labels).cache()
    assert scored.count() == docs.count()
    assert accuracy(scored, labels, "quality") > 0.97
    assert scored.filter("score is null or score < 0 or score > 1").count() == 0


def test_isotonic_steps():
    steps, values = quality_classifier.isotonic(np.array([0.1, 0.2, 0.3, 0.4]), np.array([0.0, 1.0, 0.0, 1.0]))
    assert steps.tolist() == [0.1, 0.2, 0.4]
    assert values.tolist() == [0.0, 0.5, 1.0]


def test_isotonic_fit_equals_its_formula():
    """The best non-decreasing fit at i: the largest, over starts up to i, of the least mean from there to an end from i on."""
    rng = np.random.default_rng(4)
    for _ in range(40):
        n = int(rng.integers(1, 25))
        scores, y = np.sort(rng.choice(1000, size=n, replace=False)) / 1000.0, rng.integers(0, 2, n).astype(float)
        steps, values = quality_classifier.isotonic(scores, y)
        got = values[np.searchsorted(steps, scores, side="right") - 1]
        wanted = [max(min(y[j : k + 1].mean() for k in range(i, n)) for j in range(i + 1)) for i in range(n)]
        assert np.allclose(got, wanted)


def test_summed_normal_equations_equal_a_ridge_over_all_rows(spark):
    docs, labels = labelled(spark)
    model = quality_classifier.fit(docs.repartition(7), labels)
    rows = quality_classifier._table(quality_classifier.sample(docs, labels, "quality", 4, 2), ["doc_id", "y"])
    part = F.pmod(F.xxhash64("doc_id", F.lit("part")), F.lit(quality_classifier.CALIBRATION_PARTS)) == 0
    got = rows.withColumn("part", part).toPandas()
    x, y, held = np.stack(got["x"].to_numpy()), got["y"].to_numpy(dtype=float), got["part"].to_numpy(dtype=bool)
    assert np.allclose(model.mean, x.mean(axis=0)) and np.allclose(model.scale, np.maximum(x.std(axis=0), 1e-6))
    z, target = model.lift(x[~held]), y[~held]
    # the ridge as least squares over rows and penalties, solved another way
    side = np.sqrt(quality_classifier.RIDGE) * np.eye(z.shape[1])
    beta, *_ = np.linalg.lstsq(np.vstack([z, side]), np.concatenate([target, np.zeros(len(side))]), rcond=None)
    assert np.allclose(model.lift(x) @ beta, model.raw(x), atol=1e-5)
    raw = model.raw(x[held])
    steps, values = quality_classifier.isotonic(raw, y[held])
    assert np.allclose(steps, model.steps) and np.allclose(values, model.values)


def test_quality_of_an_empty_table_and_of_equal_rows(spark):
    docs, labels = labelled(spark)
    assert quality_classifier.score(docs.limit(0), labels).count() == 0
    scored = quality_classifier.score(docs, labels).filter("doc_id = 5001").collect()
    assert len(scored) == 2 and scored[0]["score"] == pytest.approx(scored[1]["score"], abs=1e-12)  # sums of a batch may round otherwise


def test_statistics_count_repeats():
    data, offsets = vec.buffers(__import__("pyarrow").array(["a a a a", "", "a b\na b\n"]))
    x = dict(zip(quality_classifier.STATISTICS, quality_classifier.statistics(data, offsets).T))
    assert x["again_next"].tolist() == [0.75, 0.0, 0.0]
    assert x["lines_again"].tolist() == [0.0, 0.0, 0.5]
    assert x["log_words"][1] == 0


# --- rules ---------------------------------------------------------------------------


def base_by_hand(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = {}
    for i in range(len(words) - 4):
        windows.setdefault(tuple(words[i : i + 5]), []).append(i)
    covered = {p for v in windows.values() if len(v) > 1 for i in v for p in range(i, i + 5)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered)


def test_base_measures_equal_brute_force(spark):
    rng = random.Random(8)
    texts = ["", None, " \n\t\x0b\f\r", "a", "a b c d e a b c d e f", "x # y\nx # y\n\n \nx # y", "é 中 😀 z", "a b c d e " * 5000]
    texts += ["".join(rng.choices(["a ", "b ", "c\n", "#", "\t", "é "], k=rng.randint(0, 120))) for _ in range(80)]
    docs = spark.createDataFrame([(i, t, "en" if i % 2 else None, "u", "t", "b") for i, t in enumerate(texts)], "doc_id long, text string, lang string" + EXTRA)
    got = {r["doc_id"]: r for r in quality_rules.judge(docs).collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        r = got[i]
        wanted = base_by_hand(t)
        assert tuple(r[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")) == wanted
        assert r["base_failed"] == (wanted[0] < 10 or 100 * wanted[4] > 20 * wanted[0])
        assert not (r["base_failed"] and r["kept"])


def test_repeated_rows_are_judged_like_one(spark):
    rng = random.Random(1)
    word = lambda: rng.choice(["the", "of", "and", "house", "tree", "river", "walk", "green"])
    rows = [(i, " ".join(word() for _ in range(60)) + ".", "en") for i in range(30)]
    rows += [(99, "### %%% " * 40 + rows[0][1], "en")] * 3 + [(None, rows[0][1], "en")] * 2
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = quality_rules.judge(docs).collect()
    assert len(got) == len(rows)
    assert all(0 <= r["words_distance"] <= 1 and 0 <= r["chars_distance"] <= 1 for r in got)
    assert {r["kept"] for r in got if r["doc_id"] == 99} == {False}
    assert quality_rules.kept(docs).count() == sum(r["kept"] for r in got)
    assert quality_rules.judge(docs.limit(0)).count() == 0


def test_letters_without_a_common_word_are_rejected(spark):
    rng = random.Random(3)
    words = ["the", "of", "and", "to", "in"] + ["".join(rng.choices("etaoinshr", k=rng.randint(3, 8))) for _ in range(3000)]
    clean = [" ".join(rng.choices(words[:5], k=20) + rng.choices(words[5:], k=60)) for _ in range(150)]
    for i in range(150):
        clean[i] = " ".join(rng.sample(clean[i].split(), 80))
    junk = " ".join("q" + "".join(rng.choices("etaoinshr", k=rng.randint(3, 8))) for _ in range(80))
    docs = spark.createDataFrame([(i, t, "en") for i, t in enumerate([*clean, junk])], "doc_id long, text string, lang string")
    got = {r["doc_id"]: r for r in quality_rules.judge(docs).collect()}
    assert got[150]["words_distance"] <= quality_rules.MAX_WORDS_DISTANCE and not got[150]["base_failed"]
    assert not got[150]["kept"] and all(got[i]["kept"] for i in range(150))


def test_many_languages_and_a_language_of_one_document(spark, monkeypatch):
    """Each of 70 languages has a reference; a language of one document in more than LEAST_SHARE has none and is judged by the base rules."""
    rng = random.Random(21)
    rows = []
    for k in range(70):
        letters = rng.sample("abcdefghijklmnopqrstuvwxyz", 12)
        common = ["".join(rng.choices(letters, k=3)) for _ in range(12)]
        for i in range(4):
            words = rng.choices(common, k=40) + ["".join(rng.choices(letters, k=7)) for _ in range(40)]
            rng.shuffle(words)
            rows.append((100 * k + i, " ".join(words), f"l{k}"))
    rows.append((9001, "".join(rng.choices("#%&*", k=4)) + " " + " ".join("#" * rng.randint(2, 9) + str(i) for i in range(60)), "l3"))
    rows.append((9002, rows[-1][1], "rare"))
    rows.append((9003, rows[-1][1], None))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    monkeypatch.setattr(quality_rules, "LEAST_SHARE", 75)
    monkeypatch.setattr(quality_rules, "LEAST_DOCS", 4)
    got = {r["doc_id"]: r["kept"] for r in quality_rules.judge(docs).collect()}
    assert all(got[i] for i, _, _ in rows[:-3])
    assert (got[9001], got[9002], got[9003]) == (False, True, True)
    monkeypatch.setattr(quality_rules, "LEAST_SHARE", 1000)
    assert not quality_rules.judge(docs).filter("doc_id = 9001").first()["kept"]


def test_distance_of_equal_and_disjoint_histograms(spark):
    p, q = spark.range(1).select(F.lit(0.5).alias("p"), F.lit(0.5).alias("q"), F.lit(0.0).alias("z")).first()[:2]
    same = spark.range(1).select(quality_rules._distance(quality_rules._term(F.lit(p), q) + quality_rules._term(F.lit(p), q))).first()[0]
    apart = spark.range(1).select(quality_rules._distance(quality_rules._term(F.lit(1.0), 0.0) + quality_rules._term(F.lit(0.0), 1.0))).first()[0]
    assert same == pytest.approx(0) and apart == pytest.approx(1)


# --- fingerprints ------------------------------------------------------------------------


def test_next_documents_and_digests(spark):
    rng = random.Random(4)
    texts = ["", None, "a", "é" * 7, "ab", "ab", "x" * 5001] + ["".join(rng.choices("abé中 \n", k=rng.randint(0, 40))) for _ in range(90)]
    rows = [(i * 3, t) for i, t in enumerate(texts)]
    docs = spark.createDataFrame([(*r, "u", "t", "b") for r in rows], "doc_id long, text string" + EXTRA).repartition(5)
    got = {r["doc_id"]: r for r in fingerprint.fingerprints(docs).collect()}
    plain = [t or "" for t in texts]
    for k, (i, _) in enumerate(rows):
        text, after = plain[k], plain[(k + 1) % len(rows)]
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        assert got[i]["n_chars"] == len(text)
        assert got[i]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert (got[i]["near_edited"] == 1.0) == (got[i]["fingerprint"] == got[i]["edited_fingerprint"])
    assert got[12]["fingerprint"] == got[15]["fingerprint"] and got[12]["near_next"] == 1.0
    assert fingerprint.fingerprints(docs.limit(0)).count() == 0


def test_canonical_forms(spark):
    same = [("Café", "CAFÉ"), ("ﬁne  text", "FINE\ttext "), ("Straße", "STRASSE"), ("ｆｕｌｌ", "full"), ("ᾧ", "ᾧ") if False else ("Å", "Å"), ("ὀδυσσεύς", "ὈΔΥΣΣΕΎΣ")]
    rows = spark.createDataFrame([(a, b, unicodedata.normalize("NFC", "a")) for a, b in same] + [("a", "b", "")], "a string, b string, c string")
    got = [r[0] for r in rows.select(fingerprint.canonical(F.col("a")) == fingerprint.canonical(F.col("b"))).collect()]
    assert got == [True] * len(same) + [False]


def test_canonical_text_of_all_code_points(spark):
    """Every form of a code point meets the others, and what unicodedata normalises to is what the canonical text is made of."""
    points = [chr(c) for c in range(0x80, 0x110000) if not 0xD800 <= c <= 0xDFFF and unicodedata.category(chr(c)) != "Cn"]
    forms = lambda x: {unicodedata.normalize(k, x) for k in ("NFC", "NFKC", "NFD")} - {x}
    rows = [(f"a{x}b", f"a{y}b") for x in points for y in forms(x)] + [("각가", unicodedata.normalize("NFD", "각가")), ("가각", unicodedata.normalize("NFD", "가각"))]
    docs = spark.createDataFrame(rows, "x string, y string")
    apart = docs.select("x", "y", fingerprint.canonical(F.col("x")).alias("cx"), fingerprint.canonical(F.col("y")).alias("cy")).filter("cx <> cy").collect()
    assert [(ascii(r["x"]), ascii(r["y"])) for r in apart] == []


def folded(text):
    once = lambda x: unicodedata.normalize("NFKC", x)
    return re.sub(r"[\s\x85\xa0]+", " ", once(once(text or "").casefold())).strip(" ")


def test_canonical_text_equals_that_of_random_texts_by_unicodedata(spark):
    rng = random.Random(12)
    marks = [chr(c) for c in (0x301, 0x308, 0x323, 0x327, 0x345, 0x5B0, 0x93C, 0x3099, 0x1161, 0x11A8)]
    letters = ["a", "E", "ß", "ẞ", "ς", "İ", "ﬁ", "Å", "각", chr(0x1D400), chr(0x1100), "か", "क", "ש", "ا", chr(0x653), "Ⅷ", "㎏", "\u00a0", "\t", " ", "中"]
    texts = ["".join(rng.choice(letters) + "".join(rng.choices(marks, k=rng.randint(0, 3))) for _ in range(rng.randint(0, 12))) for _ in range(4000)]
    docs = spark.createDataFrame([(t,) for t in texts], "t string")
    got = docs.select("t", fingerprint.canonical(F.col("t")).alias("c")).collect()
    assert [ascii(r["t"]) for r in got if r["c"] != folded(r["t"])] == []


def test_one_row_and_repeated_ids(spark):
    one = spark.createDataFrame([(4, "abcd")], "doc_id long, text string")
    assert fingerprint.fingerprints(one).first()["near_edited"] == 0.0
    rows = spark.createDataFrame([(None, "a"), (None, "a"), (1, "b"), (1, "c")], "doc_id long, text string")
    assert fingerprint.fingerprints(rows).count() == 4
    assert {(r["class_id"], r["copies"]) for r in fingerprint.fingerprints(rows).collect()} == {(None, 2), (1, 1)}


def test_classes_equal_brute_force(spark, monkeypatch):
    rng = random.Random(13)
    base = ["Straße  nach Rom", "STRASSE NACH ROM", "ﬁne", "FINE", "", None, " ", "other", "Other ", "alone"]
    rows = [(i, rng.choice(base) if i % 3 else f"text {i} " * rng.randint(1, 400)) for i in range(200)] + [(500 + i, "copied all over") for i in range(300)]
    wanted = {}
    for i, t in rows:
        wanted.setdefault(folded(t), []).append(i)
    expected = sorted((i, min(ids), len(ids)) for ids in wanted.values() for i in ids)
    docs = spark.createDataFrame([(*r, "u", "t", "b") for r in rows], "doc_id long, text string, canon string, bytes string, class_id string").repartition(7)
    got = fingerprint.fingerprints(docs).select("doc_id", "class_id", "copies").collect()
    assert sorted(map(tuple, got)) == expected
    # every text in one bucket: bytes alone part the classes
    monkeypatch.setattr(fingerprint, "digest", lambda canon: F.substring(F.concat(F.lit("one"), canon), 1, 3))
    got = fingerprint.fingerprints(docs).select("doc_id", "class_id", "copies", "near_next").collect()
    assert sorted((r["doc_id"], r["class_id"], r["copies"]) for r in got) == expected
    after = {i: folded(t) for i, t in rows}
    order = sorted(after)
    assert {r["doc_id"]: r["near_next"] for r in got} == {i: float(after[i] == after[order[(k + 1) % len(order)]]) for k, i in enumerate(order)}


def test_many_buckets(spark, monkeypatch):
    monkeypatch.setattr(fingerprint, "BUCKET_ROWS", 2)
    rows = [(i * i, f"text {i}") for i in range(400)]
    got = fingerprint.fingerprints(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    texts = dict(rows)
    order = sorted(texts)
    for r in got:
        k = order.index(r["doc_id"])
        t, after = texts[order[k]], texts[order[(k + 1) % len(order)]]
        assert r["edited_sha256"] == hashlib.sha256((t[: len(t) - len(t) // 2] + after[: len(t) // 2]).encode()).hexdigest()


# --- licences ------------------------------------------------------------------------------


def dice(a, b):
    return 2 * len(a & b) / (len(a) + len(b))


def test_licences_by_hand(spark):
    rows = [
        (1, "Text here.\nLicensed under the Apache License, Version 2.0. More words follow"),
        (2, "Released under the MIT license!"),
        (3, "All rights reserved"),
        (4, "nothing of the kind in a long sentence of words"),
        (5, None), (6, ""), (7, "This work is licensed under the GNU General Public Licence, version 3."),
        (1, "Released under the MIT License."), (1, "Released under the MIT License."),
    ]
    docs = spark.createDataFrame([(*r, "u", "t") for r in rows], "doc_id long, text string, uid string, license string")
    got = sorted(((r["doc_id"], r["license"], r["matches"]) for r in license_scan.scan(docs).collect()), key=str)
    wanted = [(1, "Apache-2.0", 1), (1, "MIT", 1), (1, "MIT", 1), (2, "MIT", 1), (3, "all-rights-reserved", 1), (4, None, 0), (5, None, 0), (6, None, 0), (7, "GPL-3.0", 1)]
    assert got == sorted(wanted, key=str)
    gpl = set(license_scan.bigrams_of(rows[6][1]))
    score = next(r["score"] for r in license_scan.scan(docs).collect() if r["doc_id"] == 7)
    assert score == pytest.approx(max(dice(gpl, set(license_scan.bigrams_of(t))) for t in license_scan.TEMPLATES["GPL-3.0"]))
    assert license_scan.scan(docs.limit(0)).count() == 0


GPL2_WRAPPED = """/*
 * foo.c - a thing
 * Copyright (C) 2001  Some One <some@one.org>
 *
 * This program is free software; you can redistribute it and/or modify
 * it under the terms of the GNU General Public License as published by
 * the Free Software Foundation; either version 2 of the License, or
 * (at your option) any later version.
 *
 * This program is distributed in the hope that it will be useful,
 * but WITHOUT ANY WARRANTY; without even the implied warranty of
 * MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.
 */
int main(void) { return 0; }
"""


def test_whole_notices_in_any_layout(spark):
    mit = " ".join(license_scan.NOTICES["MIT"][1].split())
    wrapped = lambda text, lead, n=9: "\n".join(lead + " ".join(text.split()[i : i + n]) for i in range(0, len(text.split()), n))
    prose = "A plain sentence about rivers and houses. " * 30
    rows = [
        (1, GPL2_WRAPPED, "GPL-2.0", 1), (2, GPL2_WRAPPED.replace("version 2", "version 3"), "GPL-3.0", 1),
        (3, GPL2_WRAPPED.replace("GNU General", "GNU Affero General").replace("version 2", "version 3"), "AGPL-3.0", 1),
        (4, license_scan.NOTICES["MIT"][0], "MIT", 1), (5, prose + wrapped(mit, "// ") + "\n" + prose, "MIT", 1),
        (6, wrapped(license_scan.NOTICES["Apache-2.0"][0], "# "), "Apache-2.0", 1), (7, wrapped(license_scan.NOTICES["ISC"][0], "; ", 4), "ISC", 1),
        (8, "This work is licensed under the GNU General Public License, version 2.", "GPL-2.0", 1), (9, "This work is licensed under the GNU Affero General Public License, version 3.", "AGPL-3.0", 1),
        (10, (GPL2_WRAPPED + prose) * 3, "GPL-2.0", 3), (11, prose + "the software is provided without warranty and the license has conditions", None, 0),
        (12, wrapped(license_scan.NOTICES["BSD-3-Clause"][0], " * "), "BSD-3-Clause", 1), (13, wrapped(license_scan.NOTICES["BSD-2-Clause"][0], " * "), "BSD-2-Clause", 1),
    ]
    docs = spark.createDataFrame([r[:2] for r in rows] + [rows[0][:2]], "doc_id long, text string")
    got = license_scan.scan(docs).collect()
    assert len(got) == len(rows) + 1
    found = {r["doc_id"]: (r["license"], r["matches"], r["licenses"]) for r in got}
    assert found == {i: (name, n, name or "") for i, _, name, n in rows}
    assert all(r["score"] >= 0.75 for r in got if r["license"])


def test_long_sentences_and_ties(spark):
    many = lambda n: "mit license " * n + "released under the MIT License"
    rows = [(1, many(3)), (2, many(32)), (3, many(40)), (4, many(5000)), (5, "word " * 200_000 + "\nReleased under the MIT License"),
            (6, "Licensed under CC BY 4.0\nLicensed under the MIT License")]
    got = {r["doc_id"]: r for r in license_scan.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    sets = [dice(set(license_scan.bigrams_of(many(n))), set(license_scan.bigrams_of("Released under the MIT License"))) for n in (3, 32)]
    assert [got[i]["score"] for i in (1, 2, 3, 4)] == pytest.approx([sets[0]] * 4) and sets[0] == sets[1]
    assert got[5]["license"] == "MIT"
    assert (got[6]["license"], got[6]["score"], got[6]["licenses"]) == ("CC-BY-4.0", 1.0, "CC-BY-4.0,MIT")


# --- pages -----------------------------------------------------------------------------------

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="</p><p>no</p>";</script></head><body>
<nav><ul><li><a href=/>Home</a><li><a href=/x>About</a></ul></nav><div class="cookie-notice">We use cookies.</div><!-- <p>hidden</p> -->
<article><h1>Head &amp; line</h1><p>First   <b>bold</b> text.<p>Second&nbsp;part<br>goes on.<div class="ad">Buy now, it is a good thing to buy.</div><ul><li>one</li><li>two</li></ul></article>
<section class="comments"><p>I did not like it at all, dear author.</p></section><aside><p>Related reading</p></aside><form><label>Mail</label><button>Send</button></form><footer>&copy; Us</footer></body></html>"""


def test_main_text_of_a_page():
    assert html_extract.extract(PAGE) == "Head & line\nFirst bold text.\nSecond part goes on.\none\ntwo"


@pytest.mark.parametrize("hidden", [
    "<script src=/js/app/>var hidden = 1;</script>", '<script src="/js/app/"/>hidden</script>', "<style/>p { hidden }</style >", "<svg><g><svg x='>'><text>hidden</text></svg><text>hidden</text></g></svg>",
    "<svg/>", "<script>if (a </b) hidden = '<p>hidden</p>'</SCRIPT\n>", "<template><template>hidden</template>hidden</template>", "<noscript>hidden</noscript>", "<!-- <script> hidden -->",
    "<script>document.write('<script>hidden'); hidden</script>",
])
def test_no_code_in_the_text(hidden):
    page = PAGE.replace("<p>Second", hidden + "<p>Second")
    assert html_extract.extract(page) == html_extract.extract(PAGE)


def test_pages_of_an_empty_table(spark):
    empty = spark.createDataFrame([], "page_id long, url string, html string, text string, n_chars int")
    assert html_extract.main_text(empty).count() == 0


def test_odd_pages(spark):
    rows = [(1, "u", None), (2, "u", ""), (3, None, "<p>"), (4, "u", "<nav>x</nav>"), (5, "u", "<article><p>" + "word " * 50_000), (6, "u", "a < b <3 <p"), (5, "u", "<article><p>a<p>b</article>")]
    docs = spark.createDataFrame([(*r, "z") for r in rows], "page_id long, url string, html string, text string")
    got = html_extract.main_text(docs).collect()
    assert len(got) == len(rows)
    assert all(r["n_chars"] == len(r["text"]) for r in got)
    assert [r["text"] for r in got if r["page_id"] in (1, 2, 3, 4)] == ["", "", "", ""]
    assert "a\nb" in [r["text"] for r in got]


def test_field_on_pages_it_has_not_seen():
    rng = random.Random(1234)
    field = html_extract.model()
    right = total = 0
    for _ in range(200):
        page = html_extract.labelled_page(rng)
        got = field.decode([html_extract.Block(t, linked, path) for path, t, linked, _ in page])
        right += sum(a == b for a, (_, _, _, b) in zip(got, page))
        total += len(page)
    assert right / total > 0.99


def test_viterbi_equals_all_labellings():
    rng = random.Random(5)
    field = html_extract.Field({"x": 0, "y": 1}, np.array([[0.3, -0.2], [-0.4, 0.9]]), np.array([[0.5, -0.3], [-0.7, 0.2]]), np.array([0.1, -0.1]))
    field._of = lambda names: 0.0
    for _ in range(50):
        found = [html_extract.Block("t", 0, ()) for _ in range(rng.randint(1, 7))]
        gains = [rng.uniform(-2, 2) for _ in found]
        at = iter(gains * 2)
        field._of = lambda names, it=None: next(at) / 2  # called twice for each block
        seq = [g for g in gains for _ in (0, 1)]
        at = iter(seq)
        got = field.decode(found)

        def total(labels):
            s = field.start[labels[0]] + gains[0] * labels[0]
            for a, b, g in zip(labels, labels[1:], gains[1:]):
                s += field.move[a][b] + g * b
            return s

        best = max((total([(k >> i) & 1 for i in range(len(found))]), k) for k in range(1 << len(found)))[0]
        assert math.isclose(total([int(x) for x in got]), best, abs_tol=1e-9)
