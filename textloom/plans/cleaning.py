"""Cleaning, deduplication and text-quality queries over documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import quality as Q
from ..functions import text as X
from ..operators import cleaning as C
from .registry import query, sql_text

W = "(' ' || chr(9) || chr(10) || chr(13) || chr(12) || chr(11))"
NL = "chr(10)"


def rx(text: str, pattern: str, to: str = "") -> str:
    """SQL that replaces every match; patterns are those of the columns, in RE2's dialect."""
    return f"regexp_replace({text}, {sql_text(pattern.replace('(?mi)', '(?im)').replace('x0B', 'x0b'))}, {sql_text(to)}, 'g')"


def norm_sql(t: str) -> str:
    return f"trim({rx(rx(f'replace({t}, chr(0), {sql_text(chr(32))})', '[ \\t]+', ' '), '\\n{2,}', chr(10))}, {W})"


def finger_sql(t: str) -> str:
    return rx(f"trim(lower({t}), {W})", "[\\s\\x0b]+", " ")


def per_document(name: str, column, sql: str, out: str = "result"):
    query(name, f"SELECT doc_id, {sql} AS {out} FROM documents")(lambda t: t("documents").select("doc_id", column(F.col("text")).alias(out)))


per_document("cln1_normalize_text", X.normalize, norm_sql("text"))
per_document("cln2_fingerprint", X.fingerprint, finger_sql("text"))
per_document("cln18_similarity_hash", X.similarity_hash, f"md5({finger_sql('text')})")
per_document("cln6_mend_punctuation", X.mend_punctuation, rx(rx(rx(rx("text", r"([a-zA-Z])\.([A-Z])", r"\1. \2"), r"([a-zA-Z])\.([A-Z])", r"\1. \2"), " {2,}", " "), r"[\s\x0b]+([.,;:!?)\]])", r"\1"))


def furniture_sql(t: str) -> str:
    for p in (X.CHAPTER_LINE, X.PAGE_NUMBER_LINE, X.SECTION_LINE):
        t = rx(t, p)
    return f"trim({rx(t, '\\n{2,}', chr(10))}, {W})"


per_document("cln7_page_furniture", X.drop_page_furniture, furniture_sql("text"))


def figures_sql(t: str) -> str:
    kept = f"list_filter(string_split({t}, {NL}), lambda x: NOT regexp_matches(x, {sql_text(X.FIGURE_LINE)}))"
    return f"array_to_string(list_transform({kept}, lambda x: regexp_replace(x, {sql_text(X.FIGURE_REFERENCE)}, '', 'g')), {NL})"


per_document("cln8_figure_references", X.drop_figure_references, figures_sql("text"))


def scans_sql(t: str) -> str:
    for p, to in X.OCR_FIXES:
        t = rx(t, "(?i)" + p, to)
    for a, b in X.PLAIN_CHARACTERS:
        t = f"replace({t}, {sql_text(a)}, {sql_text(b)})"
    return t


per_document("cln9_mend_scans", X.mend_scans, scans_sql("text"))


def lines_sql(t: str) -> str:
    t = rx(t, r"([\p{L}\p{N}_])-\n([\p{L}\p{N}_])", r"\1\2")
    t = rx(f"trim({t}, ' ' || chr(9) || chr(13) || chr(12) || chr(11))", r"[ \t\r\f\x0b]*\n[ \t\r\f\x0b]*", chr(10))
    step = r"([^.!?:;\n])\n([^\n])"
    return rx(rx(t, step, r"\1 \2"), step, r"\1 \2")


per_document("cln5_join_lines", X.join_lines, lines_sql("text"))

query("cln4_repeated_lines", f"""
WITH l AS (SELECT doc_id, unnest(string_split(text, {NL})) AS line, generate_subscripts(string_split(text, {NL}), 1) AS i FROM documents),
n AS (SELECT *, lower(trim(line, {W})) AS norm FROM l),
c AS (SELECT *, count(*) OVER (PARTITION BY doc_id, norm) AS c FROM n)
SELECT doc_id, coalesce(string_agg(line, {NL} ORDER BY i) FILTER (WHERE c < 3 OR length(norm) < 2), '') AS result FROM c GROUP BY doc_id
""")(lambda t: t("documents").select("doc_id", X.drop_repeated_lines(F.col("text")).alias("result")))

query("cln3_near_paragraphs")(lambda t: t("documents").select("doc_id", X.drop_near_paragraphs(F.replace("text", F.lit("\n"), F.lit("\n\n"))).alias("result")))
query("cln12_clean_for_reading")(lambda t: t("documents").select("doc_id", X.clean(F.col("text")).alias("result")))

query("cln3_exact_paragraphs", f"""
WITH l AS (SELECT doc_id, unnest(string_split(text, {NL})) AS p, generate_subscripts(string_split(text, {NL}), 1) AS i FROM documents),
r AS (SELECT *, row_number() OVER (PARTITION BY doc_id, {finger_sql('p')} ORDER BY i) AS k FROM l)
SELECT doc_id, i - 1 AS pos, p AS paragraph FROM r WHERE k = 1 OR length(trim(p, {W})) < 20
""")(lambda t: C.exact_paragraphs(t("documents"), "\n"))

_code = f"""CASE WHEN {' OR '.join(f"starts_with(trim(upper(line), {W}), {sql_text(w)})" for w in X.SQL_LINE_STARTS)} OR regexp_matches(line, '^[\\s\\x0b]*[\\p{{L}}\\p{{N}}_]+[\\s\\x0b]*[=<>!]+[\\s\\x0b]*[\\p{{L}}\\p{{N}}_''"]') THEN 'sql'
 WHEN contains(line, '|') OR regexp_matches(line, '^[\\s\\x0b]*-+[\\s\\x0b]*$') THEN 'output' ELSE '' END"""
_lines = f"SELECT doc_id, unnest(string_split(text, {NL})) AS line, generate_subscripts(string_split(text, {NL}), 1) - 1 AS pos FROM documents"
query("cln10_code_lines", f"WITH l AS ({_lines}) SELECT doc_id, pos, {_code} AS kind FROM l")(
    lambda t: C.lines(t("documents")).select("doc_id", "pos", X.code_kind(F.col("line")).alias("kind")))
query("cln11_code_blocks", f"""
WITH l AS ({_lines}), k AS (SELECT *, {_code} AS kind FROM l),
g AS (SELECT *, sum(CASE WHEN kind = '' THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY pos) AS grp FROM k),
b AS (SELECT doc_id, grp, min(pos) AS first_pos, count(*) AS n_lines, arg_min(kind, pos) AS kind, string_agg(line, {NL} ORDER BY pos) AS body FROM g WHERE kind <> '' GROUP BY doc_id, grp)
SELECT doc_id, first_pos, n_lines, kind, body FROM b WHERE n_lines >= 2
""")(lambda t: C.code_blocks(t("documents")))

_pages = "SELECT source AS doc, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS page, text FROM documents"
_edges = f"""
WITH p AS ({_pages}), s AS (SELECT doc, page, list_transform(string_split(text, {NL}), lambda x: trim(x, {W})) AS lines FROM p),
n AS (SELECT doc, count(*) AS pages FROM s GROUP BY doc),
e AS (SELECT doc, page, len(lines) AS k, unnest(lines) AS line, generate_subscripts(lines, 1) AS i FROM s),
h AS (SELECT 'head' AS place, doc, line, count(*) AS c FROM e WHERE i <= 2 AND line <> '' AND length(line) LIMITSIGN GROUP BY doc, line),
f AS (SELECT 'foot' AS place, doc, line, count(*) AS c FROM e WHERE i > k - 2 AND line <> '' AND length(line) LIMITSIGN GROUP BY doc, line),
b AS (SELECT * FROM h UNION ALL SELECT * FROM f)
"""
query("cln13_strip_headers_footers", _edges.replace("LIMITSIGN", "<= 80") + f"""
, r AS (SELECT b.* FROM b JOIN n USING (doc) WHERE pages >= 5 AND c >= floor(pages * 0.6::DOUBLE)),
x AS (SELECT e.doc, e.page, e.i, e.line FROM e WHERE NOT EXISTS (SELECT 1 FROM r WHERE r.doc = e.doc AND r.line = e.line AND ((r.place = 'head' AND e.i <= 2) OR (r.place = 'foot' AND e.i > e.k - 2))))
SELECT p.doc, p.page, CASE WHEN n.pages < 5 THEN any_value(p.text) ELSE coalesce(string_agg(x.line, {NL} ORDER BY x.i), '') END AS result
FROM p JOIN n USING (doc) LEFT JOIN x ON x.doc = p.doc AND x.page = p.page GROUP BY p.doc, p.page, n.pages
""")(lambda t: C.strip_headers_footers(C.pages(t("documents"))))
query("qlt8_headers_footers", _edges.replace("LIMITSIGN", "< 100") + """
SELECT n.doc, coalesce(bool_or(place = 'head' AND c >= floor(pages * 0.6::DOUBLE)), false) AND n.pages >= 5 AS has_headers,
 coalesce(bool_or(place = 'foot' AND c >= floor(pages * 0.6::DOUBLE)), false) AND n.pages >= 5 AS has_footers,
 CASE WHEN n.pages < 5 THEN 0.0 ELSE coalesce(max(c), 0) / n.pages::DOUBLE END AS confidence
FROM n LEFT JOIN b USING (doc) GROUP BY n.doc, n.pages
""")(lambda t: C.headers_footers(C.pages(t("documents"))))

query("cln19_distinct_chunks", f"""
WITH h AS (SELECT doc_id, source, md5({finger_sql('text')}) AS h FROM documents)
SELECT source, doc_id FROM (SELECT *, row_number() OVER (PARTITION BY source, h ORDER BY doc_id) AS k FROM h) WHERE k = 1
""")(lambda t: C.first_of_each(t("documents").select("source", "doc_id", X.similarity_hash(F.col("text")).alias("h")), ["source", "h"], ["doc_id"]).select("source", "doc_id"))

query("cln23_doc_slugs", """
WITH s AS (SELECT doc_id, trim(regexp_replace(lower(string_split(text, ' ')[1]), '[^a-z0-9]+', '-', 'g'), '-') AS slug FROM documents),
k AS (SELECT *, row_number() OVER (PARTITION BY slug ORDER BY doc_id) AS k FROM s)
SELECT doc_id, CASE WHEN k = 1 THEN slug ELSE slug || '-' || k END AS alias FROM k
""")(lambda t: C.unique_slugs(t("documents").select("doc_id", X.slug(F.element_at(F.split("text", " "), 1)).alias("slug"))))


# --- quality -------------------------------------------------------------------


def count_sql(t: str, p: str) -> str:
    return f"len(regexp_extract_all({t}, {sql_text(p)}))"


def gib_sql(t: str, patterns=Q.GIBBERISH) -> str:
    return "(" + " + ".join(count_sql(t, p) for p in patterns) + ")"


def length_sql(t: str, p: str) -> str:
    return f"(length({t}) - length({rx(t, p)}))"


_total, _read, _bad = "length(text)", length_sql("text", Q.READABLE + "+"), gib_sql("text")


def share_sql(a: str, b: str) -> str:
    return f"CASE WHEN {b} > 0 THEN {a}::DOUBLE / {b} ELSE 0.0::DOUBLE END"


_quality = f"""SELECT *, {share_sql('readable_chars', 'total_chars')} AS readable_ratio, {share_sql('gibberish_patterns', 'total_chars')} AS gibberish_ratio,
 total_chars >= 500 AND {share_sql('readable_chars', 'total_chars')} >= 0.7 AND {share_sql('gibberish_patterns', 'total_chars')} <= 0.3 AS is_quality_good"""
query("qlt1_text_quality", f"WITH q AS (SELECT doc_id, {_total} AS total_chars, {_read} AS readable_chars, {_bad} AS gibberish_patterns FROM documents) {_quality} FROM q")(
    lambda t: t("documents").select("doc_id", *(c.alias(n) for n, c in Q.text_quality(F.col("text")).items())))
query("qlt2_extraction_quality", f"""
WITH d AS (SELECT source, string_agg(text, ' ' ORDER BY doc_id) AS text FROM documents GROUP BY source),
q AS (SELECT source, {_total} AS total_chars, {_read} AS readable_chars, {_bad} AS gibberish_patterns FROM d), r AS ({_quality} FROM q)
SELECT source, total_chars, is_quality_good, CASE WHEN total_chars < 500 THEN 'too_short' WHEN readable_ratio < 0.7 THEN 'unreadable' WHEN gibberish_ratio > 0.3 THEN 'gibberish' ELSE 'good' END AS reason FROM r
""")(lambda t: C.extraction_quality(t("documents").select("source", "text"), "source"))

_cov = f"greatest(0.0::DOUBLE, ({share_sql(_read, _total)}) - 2 * ({share_sql(gib_sql('text', Q.MORE_GIBBERISH), _total)}))"
query("qlt4_text_coverage", f"SELECT doc_id, {_cov} AS coverage, ({_cov}) >= 0.7 AND length(text) >= 50 AS meets_threshold FROM documents")(
    lambda t: t("documents").select("doc_id", Q.coverage(F.col("text")).alias("coverage"), F.length("text").alias("n")).select("doc_id", "coverage", ((F.col("coverage") >= Q.MIN_COVERAGE) & (F.col("n") >= Q.MIN_PAGE_CHARS)).alias("meets_threshold")))
query("qlt6_document_coverage", f"""
WITH c AS (SELECT source, {_cov} AS c, length(text) AS n FROM documents)
SELECT source, count(*) AS pages, round(avg(c), 9) AS avg_coverage, min(c) AS min_coverage, max(c) AS max_coverage, sum(n)::BIGINT AS total_chars, bool_and(c >= 0.7 AND n >= 50) AS all_meet FROM c GROUP BY source
""")(lambda t: C.document_coverage(t("documents"), "source"))
query("qlt5_page_warnings", f"""
WITH c AS (SELECT doc_id, {_cov} AS c, {gib_sql('text', Q.MORE_GIBBERISH)} AS g FROM documents)
SELECT doc_id, concat_ws(',', CASE WHEN c < 0.7 THEN 'low_coverage' END, CASE WHEN g > 10 THEN 'gibberish' END) AS warnings FROM c
""")(lambda t: t("documents").select("doc_id", Q.coverage(F.col("text")).alias("c"), Q.gibberish_count(F.col("text"), Q.MORE_GIBBERISH).alias("g")).select("doc_id", F.concat_ws(",", F.when(F.col("c") < Q.MIN_COVERAGE, "low_coverage"), F.when(F.col("g") > 10, "gibberish")).alias("warnings")))

_bleed = f"""
WITH s AS (SELECT doc_id, list_transform(list_filter(list_transform(string_split(text, {NL}), lambda x: trim(x, {W})), lambda x: x <> ''), lambda x: length(x)) AS s FROM documents)
SELECT doc_id, CASE WHEN len(s) = 0 THEN 0.0::DOUBLE ELSE greatest(0.0::DOUBLE, least(1.0::DOUBLE, (list_max(s) / (list_sum(s)::DOUBLE / len(s)) - 1) * 0.3::DOUBLE + (len(list_filter(s, lambda x: x > 90)) / len(s)::DOUBLE) * 0.7::DOUBLE)) END AS bleed FROM s"""
query("qlt7_column_bleed", _bleed)(lambda t: t("documents").select("doc_id", Q.column_bleed(F.col("text")).alias("bleed")))
query("qlt17_repeated_line_ratio", f"""
WITH l AS (SELECT source, doc_id, trim(unnest(string_split(text, {NL})), {W}) AS line FROM documents),
c AS (SELECT source, doc_id, line, count(*) AS c FROM l WHERE line <> '' GROUP BY ALL)
SELECT source, round(sum(CASE WHEN c > 1 THEN 1 ELSE 0 END) / sum(c)::DOUBLE, 3) AS ratio FROM c GROUP BY source
""")(lambda t: C.repeated_line_ratio(t("documents"), "source", "doc_id"))
query("qlt10_sample_pages", f"""
WITH p AS ({_pages}), n AS (SELECT doc, count(*) AS n FROM p GROUP BY doc)
SELECT p.doc, p.page FROM p JOIN n USING (doc) WHERE n <= 5 OR (p.page - 1) IN (0, 1, 2, n // 2 - 1, n // 2, n // 2 + 1, n - 2, n - 1)
""")(lambda t: C.sample_pages(C.pages(t("documents"))))

query("qlt15_routing", f"""
WITH b AS ({_bleed.strip().replace('WITH s AS', 'WITH s0 AS').replace('FROM s', 'FROM s0')}),
s AS (SELECT d.doc_id, {_cov} AS coverage, {share_sql(_read, _total)} AS readable, {share_sql(_bad, _total)} AS gibberish, bleed > 0.3 AS bleeds, len(string_split(text, '|')) - 1 AS tables_found, quality * 0.5::DOUBLE AS l3 FROM documents d JOIN b USING (doc_id) LEFT JOIN (SELECT doc_id, max(quality) AS quality FROM labels GROUP BY doc_id) l USING (doc_id)),
r AS (SELECT *, CASE WHEN coverage < 0.5 OR readable < 0.5 THEN 'needs_ocr_fallback' WHEN bleeds AND tables_found > 10 THEN 'needs_layout_fallback' WHEN coverage >= 0.7 AND coalesce(l3, 0) > 0 AND l3 < 0.6 THEN 'needs_llm_repair' ELSE 'deterministic_ok' END AS route FROM s)
SELECT doc_id, route, round(CASE route WHEN 'needs_ocr_fallback' THEN greatest(0, least(1, 1.0::DOUBLE - (coverage * 0.5::DOUBLE + readable * 0.5::DOUBLE))) WHEN 'needs_layout_fallback' THEN 0.75::DOUBLE WHEN 'needs_llm_repair' THEN 0.70::DOUBLE
 ELSE greatest(0, least(1, coverage * 0.4::DOUBLE + readable * 0.3::DOUBLE + (1 - gibberish) * 0.3::DOUBLE)) END, 3) AS confidence FROM r
""")(lambda t: C.route(t("documents").select("doc_id", "text").join(t("labels").groupBy("doc_id").agg(F.max("quality").alias("quality")), "doc_id", "left")))


# --- readability audit -----------------------------------------------------------

_first = f"string_split(text, {NL})[1]"
for _name, _p in (("aud2_garble_density", Q.GARBLE), ("aud8_screen_density", Q.SCREEN)):
    per_document(_name, lambda c, p=_p: Q.density(c, p), share_sql(length_sql("text", _p), _total), "density")
for _name, _p in (("aud3_contents_hits", Q.CONTENTS), ("aud4_publisher_hits", Q.PUBLISHER), ("aud9_corruption_hits", Q.CORRUPT)):
    per_document(_name, lambda c, p=_p: Q.matches(c, p), count_sql("text", _p), "hits")
_stop = ", ".join(map(sql_text, Q.TITLE_STOP_WORDS))
_kw = f"list_distinct(list_filter(regexp_extract_all(lower({_first} || ' ' || source), '[a-z]{{4,}}'), lambda x: x NOT IN ({_stop})))"
query("aud6_keyword_overlap", f"""
WITH k AS (SELECT doc_id, text, {_kw} AS kw FROM documents)
SELECT doc_id, len(kw)::INT AS n_keywords, CASE WHEN len(kw) = 0 OR text = '' THEN 0.0::DOUBLE ELSE len(list_filter(kw, lambda x: contains(lower(text), x)))::DOUBLE / len(kw) END AS overlap FROM k
""")(lambda t: t("documents").select("doc_id", "text", Q.title_keywords(F.element_at(F.split("text", "\n"), 1), F.col("source")).alias("kw")).select("doc_id", F.size("kw").alias("n_keywords"), Q.keyword_overlap(F.col("kw"), F.col("text")).alias("overlap")))
_dup = f"""SELECT doc_id, list_filter(list_transform(regexp_split_to_array(text, '[.\\n!]+'), lambda x: trim(x, {W})), lambda x: len(list_filter(regexp_split_to_array(x, '[\\s\\x0b]+'), lambda y: y <> '')) >= 8) AS p FROM documents"""
query("aud7_duplication", f"WITH p AS ({_dup}) SELECT doc_id, CASE WHEN len(p) < 4 THEN 0.0::DOUBLE ELSE (len(p) - len(list_distinct(p)))::DOUBLE / len(p) END AS ratio FROM p")(
    lambda t: t("documents").select("doc_id", Q.duplication(F.col("text")).alias("ratio")))
query("aud11_audit", f"""
WITH k AS (SELECT doc_id, text, {_kw} AS kw FROM documents),
o AS (SELECT doc_id, {share_sql(length_sql('text', Q.GARBLE), _total)} AS garble, {count_sql('text', Q.CONTENTS)} AS toc, {count_sql('text', Q.PUBLISHER)} AS publisher,
 len(kw) >= 2 AND len(list_filter(kw, lambda x: contains(lower(text), x)))::DOUBLE / len(kw) < 0.15 AS drift, {share_sql(length_sql('text', Q.SCREEN), _total)} AS screen, {count_sql('text', Q.CORRUPT)} AS corrupt FROM k)
SELECT doc_id, garble > 0.008 OR toc >= 3 OR publisher >= 2 OR drift OR screen > 0.010 OR corrupt >= 2 AS fallback_only,
 concat_ws(',', CASE WHEN garble > 0.008 THEN 'garble' END, CASE WHEN toc >= 3 THEN 'contents' END, CASE WHEN publisher >= 2 THEN 'publisher' END, CASE WHEN drift THEN 'drift' END, CASE WHEN screen > 0.010 THEN 'screen' END, CASE WHEN corrupt >= 2 THEN 'corrupt' END) AS flags FROM o
""")(lambda t: C.audit(t("documents").select("doc_id", F.element_at(F.split("text", "\n"), 1).alias("title"), F.col("source").alias("definition"), "text")))
