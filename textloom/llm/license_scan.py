"""License scans (native): Dice coefficient over word bigrams against notice templates.

A text is lower-cased and cut into sentences (at line breaks and after . ! ?
before white space); a sentence's words are its runs of letters, digits and
inner dots or plus signs. Sentence and template meet as sets of word bigrams (a
single word counts as a bigram with nothing). Only templates whose size allows
the wanted coefficient are counted: min/max >= t / (2 - t). Texts and sentences without any of
a few words, one of which every near sentence must hold (`anchors`), are passed over
before they are cut into words. Bigrams find their
templates by an equality join with the small template table, broadcast (its size
is fixed by TEMPLATES); overlaps are summed per sentence, row and template.

Whole notices and texts (`notices.NOTICES`) are compared with windows of their own
number of words over the words of the whole text, whatever its lines, comment
signs and sentences. Of windows that share more than half of the shorter the best
one counts, and a sentence inside a counted window is part of it. `notices.RIVALS` names
licenses near those of TEMPLATES (GPL-2.0 beside GPL-3.0): a sentence nearer to a
rival is the rival's. The SQL holds the sentences of TEMPLATES only, so it says the
same where no text holds a whole notice or a rival's name.

Defined results: a null or empty text, or one without a matching sentence, has a
null license, score 0 and no matches; equal scores go to the alphabetically first
license; repeated rows are judged row by row; an empty table gives no row; texts and sentences
of any length are read whole; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import functools
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import table
from .notices import NOTICES, RIVALS

THRESHOLD = 0.75
# Short notices by which public licences are named in texts, one sentence each.
TEMPLATES = {
    "Apache-2.0": ["Licensed under the Apache License, Version 2.0", "This project is licensed under the terms of the Apache License 2.0", "You may not use this file except in compliance with the License"],
    "MIT": ["Released under the MIT License", "Licensed under the MIT License", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"],
    "GPL-3.0": ["This work is licensed under the GNU General Public License, version 3", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License"],
    "LGPL-3.0": ["This library is licensed under the GNU Lesser General Public License, version 3"],
    "BSD-3-Clause": ["Use of this source code is governed by a BSD-style license", "Redistribution and use in source and binary forms, with or without modification, are permitted"],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"],
    "CC-BY-4.0": ["Licensed under CC BY 4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License"],
    "CC-BY-SA-4.0": ["Licensed under CC BY-SA 4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"],
    "all-rights-reserved": ["All rights reserved"],
}
_SENTENCE = r"[\n]+|[.!?]+([ \t\r\f]+|$)|[.!?]+\n"
_DROP = r"[^\p{L}\p{N}.+]+"
_DROP_SQL = _DROP.replace("\\", "\\\\")


def _template_words(sentence: str) -> list[str]:
    words = [w for w in re.sub(r"[^\w.+]+|_", " ", sentence.lower()).split(" ") if w.strip(".+")]
    return [w.strip(".+") for w in words]


def _length(text: str) -> int:
    """How many bigrams a notice has in order."""
    return max(1, len(_template_words(text)) - 1)


def bigrams_of(sentence: str) -> list[str]:
    """The distinct bigrams of a template, by the rule that the columns follow."""
    words = _template_words(sentence)
    return sorted({f"{a} {b}" for a, b in zip(words, words[1:])} or {f"{words[0]} "})


def anchors(templates: dict[str, list[str]], least: float) -> list[str]:
    """Words one of which any sentence near enough to a template holds.

    A sentence that reaches `least` shares at least least / (2 - least) of the
    template's bigrams, so if all other bigrams but that share have an anchor in
    them, it holds one. Long words and numbers are taken first.
    """
    chosen: list[str] = []
    for sentence in (s for ss in templates.values() for s in ss):
        found = bigrams_of(sentence)
        need = int(len(found) * (1 - least / (2 - least)) + 1e-9) + 1
        words = sorted({w for b in found for w in b.split(" ") if w}, key=lambda w: (any(c.isdigit() for c in w), len(w), w), reverse=True)
        covered = lambda ws: sum(any(w in b.split(" ") for w in ws) for b in found)  # noqa: E731,B023
        mine = [w for w in chosen if w in words]
        for w in words:
            if covered(mine) >= need:
                break
            mine.append(w)
        chosen += [w for w in mine if w not in chosen]
    return [w for w in chosen if not any(o != w and o in w for o in chosen)]


def notice_anchors(notices: dict[str, list[str]], least: float) -> list[str]:
    """The same for whole notices: letters only, few words, those that are in most bigrams first."""
    chosen: list[str] = []
    for text in (s for ss in notices.values() for s in ss):
        left = [b.split(" ") for b in bigrams_of(text)]
        bound = len(left) - (int(len(left) * (1 - least / (2 - least)) + 1e-9) + 1)
        left = [b for b in left if not any(w in b for w in chosen)]
        while len(left) > bound:
            words = {w for b in left for w in b if w}
            long = next(x for n in (7, 5, 4, 1) if (x := [w for w in sorted(words) if len(w) >= n and (n == 1 or w.isalpha())]))
            word = max(long, key=lambda w: (sum(w in b for b in left), len(w)))  # noqa: B023
            chosen.append(word)
            left = [b for b in left if word not in b]
    return [w for w in chosen if not any(o != w and o in w for o in chosen)]


def _template_rows(templates: dict[str, list[str]], least: float) -> tuple[list[tuple[int, str, str, int]], int, int]:
    rows, sizes = [], []
    for k, (name, sentence) in enumerate((n, s) for n, ss in templates.items() for s in ss):
        found = bigrams_of(sentence)
        rows += [(k, name, b, len(found)) for b in found]
        sizes.append(len(found))
    ratio = least / (2 - least)
    return rows, int(-(-min(sizes) * ratio // 1)), int(max(sizes) / ratio)


def _bigrams() -> Column:
    return F.expr("CASE WHEN size(w) = 1 THEN array(concat(w[0], ' ')) ELSE zip_with(slice(w, 1, greatest(size(w) - 1, 0)), slice(w, 2, greatest(size(w) - 1, 0)), (x, y) -> concat(x, ' ', y)) END")


def _words(text: str) -> Column:
    return F.expr(f"filter(transform(split(trim(regexp_replace({text}, '{_DROP_SQL}', ' ')), ' +'), x -> trim(BOTH '.+' FROM x)), x -> x <> '')")


def _holds(text: str, words: list[str]) -> Column:
    # an array of one element binds the text without computing it for each word
    return F.exists(F.array(text), lambda x: functools.reduce(Column.__or__, (F.contains(x, F.lit(word)) for word in words)))


def _windows(low: DataFrame, notices: dict[str, list[str]], least: float) -> DataFrame:
    """uid, found: the counted windows (score, license, p, e, said) of each row that has any. low: uid, low."""
    rows, _, _ = _template_rows(notices, least)
    texts = [(k, name, bigrams_of(text), _length(text)) for k, (name, text) in enumerate((n, s) for n, ss in notices.items() for s in ss)]
    known = low.sparkSession.createDataFrame([(k, b, n) for k, _, b, n in rows], "t int, bigram string, t_size int")
    whole = low.sparkSession.createDataFrame(texts, "t int, license string, wanted array<string>, length int")
    docs = low.filter(_holds("low", notice_anchors(notices, least))).select("uid", _words("low").alias("w")).filter(F.size("w") > 0)
    docs = docs.select("uid", "w", _bigrams().alias("b"))
    hits = docs.select("uid", F.posexplode("b").alias("p", "bigram")).join(F.broadcast(known), "bigram")
    hits = hits.groupBy("uid", "t", "t_size").agg(F.count_distinct("bigram").alias("common"), F.collect_set("p").alias("p"))
    # a window that reaches `least` shares this much of the notice
    hits = hits.filter(F.col("common") >= least / (2 - least) * F.col("t_size") - 1e-9).join(docs.dropDuplicates(["uid"]), "uid").join(F.broadcast(whole), "t")
    hits = hits.select("uid", "t", "license", "wanted", "length", "w", "b", F.explode("p").alias("p"))
    hits = hits.withColumn("own", F.expr("array_distinct(slice(b, p + 1, length))"))
    score = 2.0 * F.size(F.array_intersect("own", "wanted")) / (F.size("own") + F.size("wanted"))
    hits = hits.withColumn("score", score).filter(F.col("score") >= least)
    # two copies of a notice do not start within one length of it
    one = F.struct("score", (-F.col("p")).alias("back"), "license", "p", (F.col("p") + F.col("length")).alias("e"), F.expr("array_join(slice(w, p + 1, length + 1), ' ')").alias("said"))
    best = hits.groupBy("uid", "t", F.floor(F.col("p") / F.col("length")).alias("block")).agg(F.max(one).alias("h"))
    rows = best.groupBy("uid").agg(F.collect_list("h").alias("all"))
    better = "(o.score > h.score or (o.score = h.score and (o.e - o.p > h.e - h.p or (o.e - o.p = h.e - h.p and (o.license < h.license or (o.license = h.license and o.p < h.p))))))"
    return rows.select("uid", F.expr(f"filter(all, h -> not exists(all, o -> 2 * (least(o.e, h.e) - greatest(o.p, h.p)) > least(o.e - o.p, h.e - h.p) and {better}))").alias("found"))


def scan(docs: DataFrame, templates: dict[str, list[str]] | None = None, least: float = THRESHOLD, notices: dict[str, list[str]] | None = None, rivals: dict[str, list[str]] | None = None) -> DataFrame:
    """doc_id, license, score, matches (sentences and windows that reach `least`), licenses (distinct, sorted) of every row.

    notices, rivals: by default those of the module, none beside a caller's own templates.
    """
    notices, rivals = (NOTICES if notices is None else notices, RIVALS if rivals is None else rivals) if templates is None else (notices or {}, rivals or {})
    rows, low, high = _template_rows(templates or TEMPLATES, least)
    known_rows = [(*r, False) for r in rows] + [(r[0] + len(rows), *r[1:], True) for r in (_template_rows(rivals, least)[0] if rivals else [])]
    known = docs.sparkSession.createDataFrame(known_rows, "t int, license string, bigram string, t_size int, rival boolean")
    # a row is known by doc_id and a hash of its text: scans need not agree on an order
    base = docs.select(F.struct(F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))).alias("id"), F.xxhash64(F.coalesce(F.col("text"), F.lit(""))).alias("tie")).alias("uid"), "doc_id", "text")
    lower = base.select("uid", F.lower(F.coalesce(F.col("text"), F.lit(""))).alias("low"))
    short = anchors({n: [*(templates or TEMPLATES).get(n, []), *rivals.get(n, [])] for n in [*(templates or TEMPLATES), *rivals]}, least)
    sentences = lower.filter(_holds("low", short)).select("uid", F.posexplode(F.split("low", _SENTENCE)).alias("place", "s")).filter(_holds("s", short))
    words = sentences.select("uid", "place", _words("s").alias("w")).filter(F.size("w") > 0)
    # sets of a size that no template allows are passed over, however many words a sentence has
    words = words.select("uid", "place", F.array_join("w", " ").alias("said"), F.array_distinct(_bigrams()).alias("b")).filter((F.size("b") >= low) & (F.size("b") <= high))
    bigrams = words.select("uid", "place", "said", F.size("b").alias("size"), F.explode("b").alias("bigram"))
    ratio = least / (2 - least)
    near = bigrams.join(F.broadcast(known), "bigram").filter((F.col("size") >= ratio * F.col("t_size")) & (F.col("t_size") >= ratio * F.col("size")))
    counts = near.groupBy("uid", "place", "said", "size", "t", "license", "t_size", "rival").agg(F.count_distinct("bigram").alias("common"))
    scored = counts.withColumn("score", 2.0 * F.col("common") / (F.col("size") + F.col("t_size"))).filter(F.col("score") >= least)
    if rivals:
        w = Window.partitionBy("uid", "place")
        top = {"own": F.max(F.when(~F.col("rival"), F.col("score"))).over(w), "other": F.max(F.when(F.col("rival"), F.col("score"))).over(w)}
        scored = scored.withColumns(top).filter(F.when(F.col("rival"), F.col("own").isNull() | (F.col("score") > F.col("own"))).otherwise(F.col("other").isNull() | (F.col("score") >= F.col("other"))))
    scored = scored.select("uid", F.col("place").cast("long").alias("place"), "said", "license", "score")
    if notices:
        windows = _windows(lower, notices, least)
        inside = F.exists("found", lambda h: F.contains(F.concat(F.lit(" "), h["said"], F.lit(" ")), F.concat(F.lit(" "), F.col("said"), F.lit(" "))))
        scored = scored.join(windows, "uid", "left").filter(F.col("found").isNull() | ~inside).drop("found")
        one = windows.select("uid", F.explode("found").alias("h"))
        scored = scored.unionByName(one.select("uid", (-1 - F.col("h.p")).cast("long").alias("place"), F.col("h.said").alias("said"), F.col("h.license").alias("license"), F.col("h.score").alias("score")))
    best = scored.groupBy("uid").agg(F.min(F.struct(-F.col("score"), F.col("license"))).alias("best"), F.countDistinct("place").alias("matches"), F.array_sort(F.collect_set("license")).alias("licenses"))
    out = base.select("uid", "doc_id").join(best, "uid", "left")
    return out.select("doc_id", F.col("best.license").alias("license"), F.coalesce(-F.col("best.col1"), F.lit(0.0)).alias("score"), F.coalesce("matches", F.lit(0)).cast("long").alias("matches"), F.coalesce(F.array_join("licenses", ","), F.lit("")).alias("licenses"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"))


def _oracle() -> str:
    rows, low, high = _template_rows(TEMPLATES, THRESHOLD)
    values = ", ".join(f"({t}, '{name}', '{b}', {n})" for t, name, b, n in rows)
    ratio = THRESHOLD / (2 - THRESHOLD)
    return f"""
WITH known(t, license, bigram, t_size) AS (VALUES {values}),
base AS (SELECT row_number() OVER () AS uid, doc_id, coalesce(text, '') AS text FROM documents),
s AS (SELECT uid, unnest(regexp_split_to_array(lower(text), '[\\n]+|[.!?]+([ \\t\\r\\f]+|$)|[.!?]+\\n')) AS s, generate_subscripts(regexp_split_to_array(lower(text), '[\\n]+|[.!?]+([ \\t\\r\\f]+|$)|[.!?]+\\n'), 1) AS place FROM base),
w AS (SELECT uid, place, list_filter(list_transform(string_split(trim(regexp_replace(s, '[^\\p{{L}}\\p{{N}}.+]+', ' ', 'g')), ' '), lambda x: trim(x, '.+')), lambda x: x <> '') AS w FROM s),
f AS (SELECT * FROM w WHERE len(w) > 0),
d AS (SELECT uid, place, CASE WHEN len(w) = 1 THEN [w[1] || ' '] ELSE list_distinct([w[i] || ' ' || w[i + 1] FOR i IN range(1, len(w))]) END AS b FROM f),
p AS (SELECT * FROM d WHERE len(b) BETWEEN {low} AND {high}),
g AS (SELECT uid, place, len(b) AS size, unnest(b) AS bigram FROM p),
c AS (SELECT uid, place, size, t, license, t_size, count(*) AS common FROM g JOIN known USING (bigram)
      WHERE size >= {ratio!r}::DOUBLE * t_size AND t_size >= {ratio!r}::DOUBLE * size GROUP BY ALL),
q AS (SELECT *, 2.0::DOUBLE * common / (size + t_size) AS score FROM c WHERE 2.0::DOUBLE * common / (size + t_size) >= {THRESHOLD}),
r AS (SELECT uid, min({{'a': -score, 'l': license}}) AS best, count(DISTINCT place) AS matches, array_to_string(list_sort(list(DISTINCT license)), ',') AS licenses FROM q GROUP BY uid)
SELECT doc_id, best.l AS license, coalesce(-best.a, 0.0::DOUBLE) AS score, coalesce(matches, 0)::BIGINT AS matches, coalesce(licenses, '') AS licenses FROM base LEFT JOIN r USING (uid)
"""


ORACLE_SQL = _oracle()
