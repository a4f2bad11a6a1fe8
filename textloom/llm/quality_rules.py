"""Quality rules by distribution divergence (native).

A document's character-class and common-word histograms are held against
language references by Jensen-Shannon distance (base 2, the square root of the
divergence, 0 to 1); the nearest reference counts. Base rules on length and
repetition come first.

A language has a reference if it has one document in `LEAST_SHARE` or more, and at least `LEAST_DOCS`, so there are at
most `LEAST_SHARE` of them, whatever the column holds, and a few documents do not
make a reference for themselves. A document of a language without one is not
judged by histograms, only by the base rules.

Defined results: a null or empty text has no words, fails the base rule and is
not kept; a null `lang` is a language of its own; repeated rows and repeated
doc_ids are judged row by row; texts of any length are read whole; an empty table gives an empty result; columns
other than doc_id, text and lang are ignored, whatever their names.

Scale: one pass over the texts writes the base measures, one counts words by
language (a partial aggregate) for the references, one counts common words per
row (explode, broadcast hash join with at most `LEAST_SHARE * COMMON_WORDS`
words, partial aggregate). Rows meet again on doc_id and a hash of the text; rows
that repeat in both share their counts, so no scan has to number rows.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import SEPARATORS, cut, table

SYMBOLS = "#*$%&|<>"
PUNCTUATION = ".,;:'\"()-?"
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
REPEAT_WINDOW = 5
COMMON_WORDS = 32
#: A language of one document in so many, and of so many documents, has a reference.
LEAST_SHARE, LEAST_DOCS = 1000, 10
#: Guards: shorter documents are not judged by that histogram.
GUARD_CHARS, GUARD_WORDS = 200, 20
MAX_CHARS_DISTANCE, MAX_WORDS_DISTANCE = 0.25, 0.5
CLASSES = ("lower", "upper", "digit", "space", "punct", "symbol", "ascii_other", "wide")


def _sql_string(s: str) -> str:
    return "".join(f"\\u{ord(c):04x}" for c in s)


def _pattern(chars: str) -> str:
    return "[" + "".join(f"\\\\x{ord(c):02x}" for c in chars) + "]+"


def words_of(text: str = "text") -> Column:
    """The words `[^\\x20\\x09-\\x0D]+` of a SQL expression, in order."""
    seps = _sql_string(SEPARATORS)
    trimmed = f"trim(BOTH '{seps}' FROM {text})"
    return F.expr(f"CASE WHEN {trimmed} = '' THEN cast(array() as array<string>) ELSE split({trimmed}, '[\\\\x20\\\\x09-\\\\x0D]+') END")


def _with_classes(rows: DataFrame) -> DataFrame:
    """rows with the code points of `text` per class; each class is removed before the next is counted."""
    lower = "abcdefghijklmnopqrstuvwxyz"
    known = {"lower": lower, "space": SEPARATORS, "punct": PUNCTUATION, "upper": lower.upper(), "digit": "0123456789", "symbol": SYMBOLS}
    rest = "".join(c for c in map(chr, range(128)) if c not in "".join(known.values()))
    keep = rows.columns
    left, made = "text", []
    for k, (name, chars) in enumerate({**known, "ascii_other": rest}.items()):
        rows = rows.select(*keep, *made, *([left] if left != "text" else []), F.expr(f"regexp_replace({left}, '{_pattern(chars)}', '')").alias(f"left{k}"))
        rows = rows.select(*keep, *made, f"left{k}", F.expr(f"cast(length({left}) - length(left{k}) as bigint)").alias(name))
        left, made = f"left{k}", [*made, name]
    return rows.select(*keep, *made, F.length(left).cast("long").alias("wide"))


def _repeat_words() -> Column:
    """Words in five-word windows found twice or more in the row's `words`."""
    k = REPEAT_WINDOW
    hashes = "transform(words, w -> xxhash64(w))"
    parts = ", ".join(["x"] + [f"get(h, i + {j})" for j in range(1, k)])
    windows = f"transform(slice(h, 1, size(h) - {k - 1}), (x, i) -> xxhash64({parts}))"
    ordered = "array_sort(transform(v, (x, i) -> struct(x as h, i as i)))"
    repeated = """array_sort(transform(filter(o, (x, j) -> (j > 0 and get(o, j - 1).h = x.h) or coalesce(get(o, j + 1).h = x.h, false)), x -> x.i))"""
    covered = f"aggregate({repeated}, struct(0L as n, {-k} as last), (a, p) -> struct(a.n + least({k}, p - a.last) as n, p as last), a -> a.n)"
    # let h, v, o: an array of one element binds a name without computing it twice
    many = f"transform(array({ordered}), o -> {covered})[0]"
    body = f"transform(transform(array({hashes}), h -> {windows}), v -> CASE WHEN size(array_distinct(v)) < size(v) THEN {many} ELSE 0L END)[0]"
    return F.expr(f"CASE WHEN n_words > {k} THEN {body} ELSE 0L END").alias("n_repeat_words")


def base_counts(docs: DataFrame) -> DataFrame:
    """Per row: id, tie, doc_id, lang, the base measures, n_points and the class counts."""
    seps, text = _sql_string(SEPARATORS), F.coalesce(F.col("text"), F.lit(""))
    rows = _with_classes(docs.select("id", "tie", "doc_id", "lang", text.alias("text")))
    lines = f"filter(split(text, '\n', -1), x -> trim(BOTH '{seps}' FROM x) <> '')"
    rows = rows.select("*", words_of().alias("words"), F.expr(lines).alias("lines")).withColumn("n_words", F.size("words").cast("long"))
    return rows.select("id", "tie", "doc_id", "lang", "n_words", (F.length("text") - F.col("space")).cast("long").alias("word_chars"), F.col("symbol").alias("n_symbols"),
                       (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"), _repeat_words(), F.length("text").alias("n_points"), *CLASSES)


def _tokens(docs: DataFrame) -> DataFrame:
    """id, tie, lang and w: each lower-cased word."""
    return docs.select("id", "tie", "lang", F.explode(words_of("lower(coalesce(text, ''))")).alias("w"))


def references(rows: DataFrame, tokens: DataFrame) -> list[dict]:
    """Per language, over all documents: class shares, the commonest words and their shares. Small: at most LEAST_SHARE rows.

    rows: base_counts(); tokens: _tokens().
    """
    sums = rows.groupBy("lang").agg(F.count("*").alias("docs"), F.sum("n_words").alias("n"), *(F.sum(c).alias(c) for c in CLASSES))
    kept = {r["lang"]: r for r in sums.filter((F.col("docs") * LEAST_SHARE >= F.lit(rows.count())) & (F.col("docs") >= LEAST_DOCS)).collect()}
    if not kept:
        return []
    # at most LEAST_SHARE rows; a null is a language, too
    known = rows.sparkSession.createDataFrame([(x,) for x in kept], "known string")
    counts = tokens.join(F.broadcast(known), F.col("lang").eqNullSafe(F.col("known")), "left_semi").groupBy("lang", "w").agg(F.count("*").alias("c"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("c"), "w"))
    best = counts.withColumn("r", rank).filter(F.col("r") <= COMMON_WORDS)
    words: dict = {}
    for r in best.orderBy("lang", "r").collect():
        words.setdefault(r["lang"], []).append((r["w"], r["c"]))
    out = []
    for lang in sorted(kept, key=lambda x: (x is not None, x)):
        if lang in words and (points := sum(kept[lang][c] for c in CLASSES)):
            n = kept[lang]["n"]
            out.append({"lang": lang, "chars": [kept[lang][c] / points for c in CLASSES], "words": [(w, c / n) for w, c in words[lang]], "other": (n - sum(c for _, c in words[lang])) / n})
    return out


def _term(p: Column, q: Column | float) -> Column:
    """What a bin adds to twice the divergence, beyond the q/1 of a bin that the document lacks."""
    q = F.lit(float(q)) if isinstance(q, (int, float)) else q
    m = (p + q) / 2
    return F.when(p > 0, p * F.log2(p / m) + F.when(q > 0, q * F.log2(q / m)).otherwise(0.0) - q).otherwise(0.0)


def _distance(terms: Column) -> Column:
    return F.sqrt(F.greatest(F.lit(0.0), (terms + 1.0) / 2))


def _nearest_classes(refs: list[dict]) -> Column:
    """Least distance of the class counts to a reference's."""
    if not refs:
        return F.lit(1.0)
    points = F.greatest(F.col("n_points"), F.lit(1)).cast("double")
    shares = F.array(*(F.col(c) / points for c in CLASSES))
    known = F.from_json(F.lit(json.dumps([r["chars"] for r in refs])), "array<array<double>>")
    near = F.transform(known, lambda r: _distance(F.aggregate(F.zip_with(shares, r, _term), F.lit(0.0), lambda a, x: a + x)))
    return F.least(F.array_min(near), F.lit(1.0))


def _nearest_words(refs: list[dict]) -> Column:
    """Least distance of the common words to a reference's; found: (ref, terms, common) of the references that the row has words of."""
    if not refs:
        return F.lit(1.0)
    n = F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    other = F.from_json(F.lit(json.dumps([r["other"] for r in refs])), "array<double>")
    hit = F.coalesce(F.col("found"), F.from_json(F.lit("[]"), "array<struct<ref:int,terms:double,common:bigint>>"))
    near = F.transform(hit, lambda x: _distance(x["terms"] + _term((F.col("n_words") - x["common"]) / n, F.get(other, x["ref"]))))
    # a reference without a word of the row
    missing = F.array_except(F.sequence(F.lit(0), F.lit(len(refs) - 1)), F.transform(hit, lambda x: x["ref"]))
    none = F.transform(missing, lambda k: _distance(_term(F.lit(1.0), F.get(other, k))))
    return F.least(F.array_min(F.concat(near, none)), F.lit(1.0))


def judge(docs: DataFrame, keys: bool = False) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, chars_distance, words_distance."""
    # a row is known by doc_id and a hash of its text: scans need not agree on an order
    docs = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))).alias("id"), F.xxhash64(F.coalesce(F.col("text"), F.lit(""))).alias("tie"), "doc_id", "text", "lang")
    spark = docs.sparkSession
    rows = cut(base_counts(docs), "base")
    refs = references(rows, _tokens(docs))
    rows = rows.withColumn("chars_distance", F.when(F.col("n_points") > 0, _nearest_classes(refs)).otherwise(1.0))
    vocabulary = spark.createDataFrame([(k, w, q) for k, r in enumerate(refs) for w, q in r["words"]] or [(-1, "", 0.0)], "ref int, w string, q double")
    counts = _tokens(docs).join(F.broadcast(vocabulary.select("w").distinct()), "w").groupBy("id", "tie", "w").agg(F.count("*").alias("c"))
    # repeated rows count their words together
    sizes = rows.groupBy("id", "tie").agg(F.sum("n_words").alias("words"), F.count("*").alias("times"))
    counts = counts.join(sizes, ["id", "tie"])
    per_row = counts.join(F.broadcast(vocabulary), "w").groupBy("id", "tie", "ref").agg(F.sum(_term(F.col("c") / F.col("words"), F.col("q"))).alias("terms"), F.sum(F.col("c") / F.col("times")).cast("long").alias("common"))
    per_row = per_row.groupBy("id", "tie").agg(F.collect_list(F.struct("ref", "terms", "common")).alias("found"))
    rows = rows.join(per_row, ["id", "tie"], "left")
    rows = rows.withColumn("words_distance", F.when(F.col("n_words") > 0, _nearest_words(refs)).otherwise(1.0))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    # no common word of any reference: the distance is then no measure, as the other words fill one bin
    none = F.col("found").isNull() if refs else F.lit(False)
    own = [r["lang"] for r in refs]
    judged = F.col("lang").isin([x for x in own if x is not None]) if any(x is not None for x in own) else F.lit(False)
    judged = F.coalesce(judged, F.lit(None in own))
    far = judged & (((F.col("n_points") >= GUARD_CHARS) & (F.col("chars_distance") > MAX_CHARS_DISTANCE)) | ((F.col("n_words") >= GUARD_WORDS) & ((F.col("words_distance") > MAX_WORDS_DISTANCE) | none)))
    return rows.select(*(["id", "tie"] if keys else []), "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"), (~failed & ~far).alias("kept"), F.round("chars_distance", 6).alias("chars_distance"), F.round("words_distance", 6).alias("words_distance"))


def kept(docs: DataFrame) -> DataFrame:
    """The rows of docs, all columns, that the rules keep."""
    good = judge(docs, keys=True).filter("kept").select(F.col("id").alias("kept_id"), F.col("tie").alias("kept_tie")).distinct()
    same = (F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))) == F.col("kept_id")) & (F.xxhash64(F.coalesce(F.col("text"), F.lit(""))) == F.col("kept_tie"))
    return docs.join(good, same, "left_semi")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "documents"))


def _oracle() -> str:
    """The same in DuckDB's SQL."""
    seps = "(' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))"
    lower = "abcdefghijklmnopqrstuvwxyz"
    known = {"upper": lower.upper(), "digit": "0123456789", "space": SEPARATORS, "punct": PUNCTUATION, "symbol": SYMBOLS}
    rest = "".join(c for c in map(chr, range(128)) if c not in lower + "".join(known.values()))
    pattern = lambda chars: "[" + "".join(f"\\x{ord(c):02x}" for c in chars) + "]+"
    classes = {"lower": pattern(lower), **{k: pattern(v) for k, v in known.items()}, "ascii_other": pattern(rest), "wide": "[^\\x00-\\x7f]+"}
    counts = ", ".join(f"length(text) - length(regexp_replace(text, '{p}', '', 'g')) AS c_{k}" for k, p in classes.items())
    term = lambda p, q: f"CASE WHEN {p} > 0 THEN {p} * log2({p} / (({p} + {q}) / 2)) + CASE WHEN {q} > 0 THEN {q} * log2({q} / (({p} + {q}) / 2)) ELSE 0 END - {q} ELSE 0 END"
    distance = lambda t: f"sqrt(greatest(0.0::DOUBLE, ({t} + 1.0) / 2))"
    chars = " + ".join(term(f"(r.c_{k} / greatest(points, 1)::DOUBLE)", f"(s.c_{k} / s.points_all::DOUBLE)") for k in CLASSES)
    k = REPEAT_WINDOW
    return f"""
WITH d AS (SELECT row_number() OVER () AS uid, doc_id, lang, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, list_filter(regexp_split_to_array(text, '[\\x20\\x09-\\x0d]+'), lambda x: x <> '') AS words, list_filter(string_split(text, chr(10)), lambda x: trim(x, {seps}) <> '') AS lines FROM d),
r0 AS (SELECT uid, doc_id, lang, words, len(words) AS n_words, length(text) AS points, length(text) - length(regexp_replace(text, '[\\x20\\x09-\\x0d]+', '', 'g')) AS n_sep, len(lines) - len(list_distinct(lines)) AS n_dup_lines, {counts} FROM w),
g AS (SELECT uid, unnest(range(1, n_words - {k - 2})) AS i, unnest([array_to_string(words[j : j + {k - 1}], ' ') FOR j IN range(1, n_words - {k - 2})]) AS win FROM r0 WHERE n_words > {k}),
h AS (SELECT uid, i FROM (SELECT *, count(*) OVER (PARTITION BY uid, win) AS c FROM g) WHERE c > 1),
v AS (SELECT uid, sum(least({k}, coalesce(nxt - i, {k})))::BIGINT AS n_repeat_words FROM (SELECT uid, i, lead(i) OVER (PARTITION BY uid ORDER BY i) AS nxt FROM h) GROUP BY uid),
r AS (SELECT r0.*, coalesce(n_repeat_words, 0) AS n_repeat_words FROM r0 LEFT JOIN v USING (uid)),
s AS (SELECT lang, count(*) AS docs, sum(n_words) AS n, {', '.join(f'sum(c_{c}) AS c_{c}' for c in CLASSES)}, sum(points) AS points_all FROM r GROUP BY lang),
t AS (SELECT uid, lang, lower(unnest(words)) AS w FROM r),
tc AS (SELECT lang, w, count(*) AS c FROM t GROUP BY lang, w),
tops AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY c DESC, w) AS k FROM tc) WHERE k <= {COMMON_WORDS}),
refs AS (SELECT s.*, (s.n - x.c_all) / s.n::DOUBLE AS other FROM s JOIN (SELECT lang, sum(c) AS c_all FROM tops GROUP BY lang) x ON s.lang IS NOT DISTINCT FROM x.lang WHERE points_all > 0 AND docs * {LEAST_SHARE} >= (SELECT count(*) FROM d) AND docs >= {LEAST_DOCS}),
cd AS (SELECT r.uid, CASE WHEN any_value(r.points) > 0 THEN least(min({distance(chars)}), 1.0) ELSE 1.0 END AS chars_distance FROM r LEFT JOIN refs s ON true GROUP BY r.uid),
wc AS (SELECT uid, w, count(*) AS c FROM t GROUP BY uid, w),
wt AS (SELECT wc.uid, tops.lang AS ref, sum({term('(wc.c / r.n_words::DOUBLE)', '(tops.c / refs.n::DOUBLE)')}) AS terms, sum(wc.c) AS common
 FROM wc JOIN r USING (uid) JOIN tops USING (w) JOIN refs ON refs.lang IS NOT DISTINCT FROM tops.lang GROUP BY wc.uid, tops.lang),
wd AS (SELECT r.uid, CASE WHEN any_value(r.n_words) > 0 THEN least(min({distance('(coalesce(terms, 0) + ' + term('((r.n_words - coalesce(common, 0)) / greatest(r.n_words, 1)::DOUBLE)', 'refs.other') + ')')}), 1.0) ELSE 1.0 END AS words_distance
 FROM r LEFT JOIN refs ON true LEFT JOIN wt ON wt.uid = r.uid AND wt.ref IS NOT DISTINCT FROM refs.lang GROUP BY r.uid),
b AS (SELECT r.*, chars_distance, words_distance, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS base_failed, EXISTS (SELECT 1 FROM refs WHERE refs.lang IS NOT DISTINCT FROM r.lang) AS judged FROM r JOIN cd USING (uid) JOIN wd USING (uid))
SELECT doc_id, n_words, points - n_sep AS word_chars, c_symbol AS n_symbols, n_dup_lines, n_repeat_words, base_failed,
 NOT base_failed AND NOT (judged AND points >= {GUARD_CHARS} AND chars_distance > {MAX_CHARS_DISTANCE}) AND NOT (judged AND n_words >= {GUARD_WORDS} AND words_distance > {MAX_WORDS_DISTANCE}) AS kept, round(chars_distance, 6) AS chars_distance, round(words_distance, 6) AS words_distance FROM b
"""


ORACLE_SQL = _oracle()
