"""Literal cases with results worked out by hand."""

import pytest
from pyspark.sql import functions as F

from textloom.functions import quality as Q
from textloom.functions import text as X
from textloom.functions import vector as V


def one(spark, value, fn):
    return spark.createDataFrame([(value,)], "c string").select(fn(F.col("c")).alias("r")).first()["r"]


@pytest.mark.parametrize(
    ("fn", "text", "wanted"),
    [
        (X.normalize, "  a\t\tb \n\n\n c\x00d ", "a b \n c d"),
        (X.normalize, "", ""),
        (X.fingerprint, "  The  End\n", "the end"),
        (X.join_lines, "state-\nment one\ngoes on.\nNext", "statement one goes on.\nNext"),
        (X.join_lines, "one\n\ntwo", "one\n\ntwo"),
        (X.mend_punctuation, "a.B.C  d , e", "a. B. C d, e"),
        (X.drop_page_furniture, "Chapter 3 How to query 75\nbody\n12\nSection 1 Intro\nend", "body\nend"),
        (X.drop_figure_references, "see Figure 3-1 the plan\nFigure 2.4\nkeep", "see \nkeep"),
        (X.mend_scans, "frrst fr·om t o x—y", "first from to x-y"),
        (X.drop_repeated_lines, "a1\nb\na1\nc\n A1 ", "b\nc"),
        (X.drop_repeated_lines, "a1\na1\nb", "a1\na1\nb"),
        (X.drop_near_paragraphs, "this is a long paragraph\n\nThis is a  long paragraph\n\nshort", "this is a long paragraph\n\nshort"),
        (X.code_kind, "select x", "sql"),
        (X.code_kind, "a | b", "output"),
        (X.code_kind, "prose", ""),
        (X.slug, "My Book (2nd).pdf", "my-book-2nd-pdf"),
        (X.clean, "", ""),
    ],
)
def test_cleaning(spark, fn, text, wanted):
    assert one(spark, text, fn) == wanted


def test_cleaning_keeps_a_text_it_has_cleaned(spark):
    once = one(spark, "One line.\nTwo  lines -\n\n\nmore", X.clean)
    assert one(spark, once, X.clean) == once


def test_null_stays_null(spark):
    for fn in (X.normalize, X.clean, X.fingerprint, X.join_lines):
        assert one(spark, None, fn) is None


def test_coverage_and_bleed(spark):
    assert one(spark, "", Q.coverage) == 0.0
    assert one(spark, "plain words, nothing else.", Q.coverage) == 1.0
    assert one(spark, "", Q.column_bleed) == 0.0
    assert one(spark, "ab\nab", Q.column_bleed) == 0.0
    assert one(spark, "x" * 100, Q.column_bleed) == pytest.approx(0.7)


def test_duplication_needs_four_sentences(spark):
    s = "one two three four five six seven eight"
    assert one(spark, ". ".join([s] * 3), Q.duplication) == 0.0
    assert one(spark, ". ".join([s] * 4), Q.duplication) == pytest.approx(0.75)


def test_embedding_of_a_known_text(spark):
    got = one(spark, "select from where join group by having order", lambda c: V.embed(c, 24))
    wanted = [0.0] * 24
    for i in (4, 6, 10, 13, 18):
        wanted[i] = 1 / 3
    wanted[23] = 2 / 3
    assert got == pytest.approx(wanted)
    assert one(spark, "a b", lambda c: V.embed(c, 4)) == [0.0] * 4
    long = "alpha " * 100_000
    assert sum(x * x for x in one(spark, long, V.embed)) == pytest.approx(1)


def test_cosine(spark):
    rows = spark.createDataFrame([([1.0, 0.0], [1.0, 0.0]), ([1.0, 0.0], [0.0, 2.0]), ([0.0, 0.0], [1.0, 1.0]), ([1.0], [1.0, 1.0])], "a array<double>, b array<double>")
    assert [r[0] for r in rows.select(V.cosine(F.col("a"), F.col("b"))).collect()] == [1.0, 0.0, 0.0, 0.0]


def test_jaccard(spark):
    rows = spark.createDataFrame([("a b c", "B c d"), ("", "a")], "a string, b string")
    assert [r[0] for r in rows.select(X.jaccard(F.col("a"), F.col("b"))).collect()] == [0.5, 0.0]
