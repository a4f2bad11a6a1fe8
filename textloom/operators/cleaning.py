"""Cleaning and quality operators that need more than one row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import quality as Q
from ..functions import text as X


def pages(docs: DataFrame, keep: str = "text", bits: int = 16) -> DataFrame:
    """doc, page, `keep`: each source is a document whose pages come by doc_id.

    Pages are numbered within blocks of 2**bits ids, so that a source of any size
    is many tasks' work; what the blocks before hold is a running sum over blocks.
    """
    rows = docs.select(F.col("source").alias("doc"), F.shiftright("doc_id", bits).alias("block"), "doc_id", *([keep] if keep != "doc_id" else []))
    sizes = rows.groupBy("doc", "block").agg(F.count("*").alias("c"))
    before = F.sum("c").over(Window.partitionBy("doc").orderBy("block").rowsBetween(Window.unboundedPreceding, -1))
    sizes = sizes.select(F.col("doc").alias("d"), F.col("block").alias("b"), F.coalesce(before, F.lit(0)).alias("before"))
    place = F.row_number().over(Window.partitionBy("doc", "block").orderBy("doc_id"))
    numbered = rows.withColumn("place", place).join(sizes, F.col("doc").eqNullSafe(F.col("d")) & F.col("block").eqNullSafe(F.col("b")))
    return numbered.select("doc", (F.col("before") + F.col("place")).cast("int").alias("page"), keep)


def lines(docs: DataFrame) -> DataFrame:
    """doc_id, pos (from 0), line."""
    return docs.select("doc_id", F.posexplode(F.split("text", "\n", -1)).alias("pos", "line"))


def first_of_each(rows: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """The first row of each key."""
    return rows.withColumn("k", F.row_number().over(Window.partitionBy(*key).orderBy(*order))).filter("k = 1").drop("k")


def exact_paragraphs(docs: DataFrame, separator: str = "\n\n", least: int = 20) -> DataFrame:
    """doc_id, pos, paragraph: of equal fingerprints the first; short paragraphs stay."""
    rows = docs.select("doc_id", F.posexplode(F.split("text", separator, -1)).alias("pos", "paragraph"))
    rank = F.row_number().over(Window.partitionBy("doc_id", "f").orderBy("pos"))
    rows = rows.withColumn("f", X.fingerprint(F.col("paragraph"))).withColumn("k", rank)
    return rows.filter((F.col("k") == 1) | (F.length(X.strip(F.col("paragraph"))) < least)).select("doc_id", "pos", "paragraph")


def code_blocks(docs: DataFrame) -> DataFrame:
    """doc_id, first_pos, n_lines, kind, body of runs of two or more code lines; a run is of its first line's kind."""
    rows = lines(docs).withColumn("kind", X.code_kind(F.col("line")))
    island = F.sum(F.when(F.col("kind") == "", 1).otherwise(0)).over(Window.partitionBy("doc_id").orderBy("pos"))
    runs = rows.withColumn("grp", island).filter("kind <> ''").groupBy("doc_id", "grp").agg(F.sort_array(F.collect_list(F.struct("pos", "line", "kind"))).alias("l"))
    return runs.filter(F.size("l") >= 2).select("doc_id", F.col("l")[0]["pos"].alias("first_pos"), F.size("l").alias("n_lines"), F.col("l")[0]["kind"].alias("kind"), F.array_join("l.line", "\n").alias("body"))


def _edge_lines(rows: DataFrame, within: Column) -> tuple[DataFrame, DataFrame]:
    """(page, line, place) of all stripped lines, and how many pages of a document have a line in their first or last two."""
    split = rows.select("doc", "page", F.transform(F.split("text", "\n", -1), X.strip).alias("lines"))
    every = split.select("doc", "page", F.size("lines").alias("k"), F.posexplode("lines").alias("i", "line"))
    edge = every.filter((F.col("line") != "") & within)
    counted = edge.select("doc", "line", F.explode(F.array_compact(F.array(F.when(F.col("i") < 2, "head"), F.when(F.col("i") >= F.col("k") - 2, "foot")))).alias("place")).groupBy("doc", "line", "place").agg(F.count("*").alias("c"))
    return every, counted


def strip_headers_footers(rows: DataFrame, least_pages: int = 5, ratio: float = 0.6, longest: int = 80) -> DataFrame:
    """doc, page, result: pages without head and foot lines that most pages of the document share."""
    every, counted = _edge_lines(rows, F.length("line") <= longest)
    n = rows.groupBy("doc").agg(F.count("*").alias("pages"))
    common = counted.join(n, "doc").filter((F.col("pages") >= least_pages) & (F.col("c") >= F.floor(F.col("pages") * ratio)))
    gone = common.groupBy("doc", "line").agg(F.bool_or(F.col("place") == "head").alias("head"), F.bool_or(F.col("place") == "foot").alias("foot"))
    left = every.join(gone, ["doc", "line"], "left").filter(~F.coalesce((F.col("head") & (F.col("i") < 2)) | (F.col("foot") & (F.col("i") >= F.col("k") - 2)), F.lit(False)))
    texts = left.groupBy("doc", "page").agg(F.sort_array(F.collect_list(F.struct("i", "line"))).alias("l")).select("doc", "page", F.array_join("l.line", "\n").alias("joined"))
    out = rows.join(n, "doc").join(texts, ["doc", "page"], "left")
    return out.select("doc", "page", F.when(F.col("pages") < least_pages, F.col("text")).otherwise(F.coalesce("joined", F.lit(""))).alias("result"))


def headers_footers(rows: DataFrame, least_pages: int = 5, ratio: float = 0.6) -> DataFrame:
    """doc, has_headers, has_footers, confidence."""
    _, counted = _edge_lines(rows, F.length("line") < 100)
    n = rows.groupBy("doc").agg(F.count("*").alias("pages"))
    often = F.col("c") >= F.floor(F.col("pages") * ratio)
    enough = F.col("pages") >= least_pages
    found = n.join(counted, "doc", "left").groupBy("doc", "pages").agg(F.bool_or((F.col("place") == "head") & often).alias("h"), F.bool_or((F.col("place") == "foot") & often).alias("f"), F.max("c").alias("c"))
    return found.select("doc", (F.coalesce("h", F.lit(False)) & enough).alias("has_headers"), (F.coalesce("f", F.lit(False)) & enough).alias("has_footers"), F.when(enough, F.coalesce("c", F.lit(0)) / F.col("pages")).otherwise(0.0).alias("confidence"))


def unique_slugs(rows: DataFrame) -> DataFrame:
    """doc_id, alias: -2, -3 ... after repeated slugs, by doc_id."""
    k = F.row_number().over(Window.partitionBy("slug").orderBy("doc_id"))
    return rows.withColumn("k", k).select("doc_id", F.when(F.col("k") == 1, F.col("slug")).otherwise(F.concat_ws("-", "slug", F.col("k").cast("string"))).alias("alias"))


def extraction_quality(rows: DataFrame, by: str) -> DataFrame:
    """by, total_chars, is_quality_good, reason over the texts of a group joined by blanks; the first rule that fails.

    No pattern holds a blank, so what the joined text would give are sums over its parts.
    """
    q = rows.select(by, *(c.alias(n) for n, c in Q.text_quality(F.col("text")).items()))
    gaps = F.count("total_chars") - 1
    q = q.groupBy(by).agg((F.sum("total_chars") + gaps).alias("total_chars"), (F.sum("readable_chars") + gaps).alias("readable"), F.sum("gibberish_patterns").alias("bad"))
    readable, bad = Q.share(F.col("readable"), F.col("total_chars")), Q.share(F.col("bad"), F.col("total_chars"))
    good = (F.col("total_chars") >= Q.MIN_CHARS) & (readable >= Q.MIN_READABLE) & (bad <= Q.MAX_GIBBERISH)
    reason = F.when(F.col("total_chars") < Q.MIN_CHARS, "too_short").when(readable < Q.MIN_READABLE, "unreadable").when(bad > Q.MAX_GIBBERISH, "gibberish").otherwise("good")
    return q.select(by, "total_chars", good.alias("is_quality_good"), reason.alias("reason"))


def document_coverage(rows: DataFrame, by: str) -> DataFrame:
    """Coverage of the pages of each group."""
    c = rows.select(by, Q.coverage(F.col("text")).alias("c"), F.length("text").alias("n"))
    return c.groupBy(by).agg(F.count("*").alias("pages"), F.round(F.avg("c"), 9).alias("avg_coverage"), F.min("c").alias("min_coverage"), F.max("c").alias("max_coverage"), F.sum("n").alias("total_chars"), F.every((F.col("c") >= Q.MIN_COVERAGE) & (F.col("n") >= Q.MIN_PAGE_CHARS)).alias("all_meet"))


def repeated_line_ratio(rows: DataFrame, by: str, page: str) -> DataFrame:
    """Distinct lines that a page repeats, over all lines of the group's pages that are not blank."""
    each = rows.select(by, page, F.explode(F.split("text", "\n", -1)).alias("line")).withColumn("line", X.strip(F.col("line"))).filter("line <> ''")
    counts = each.groupBy(by, page, "line").agg(F.count("*").alias("c"))
    return counts.groupBy(by).agg(F.round(F.sum(F.when(F.col("c") > 1, 1).otherwise(0)) / F.sum("c"), 3).alias("ratio"))


def sample_pages(rows: DataFrame, least: int = 5) -> DataFrame:
    """doc, page: all pages of a short document, else the first three, the middle three and the last two."""
    n = rows.groupBy("doc").agg(F.count("*").cast("int").alias("n"))
    i, half = F.col("page") - 1, F.floor(F.col("n") / 2)
    wanted = i.isin(0, 1, 2) | (i == half - 1) | (i == half) | (i == half + 1) | (i == F.col("n") - 2) | (i == F.col("n") - 1)
    return rows.join(n, "doc").filter((F.col("n") <= least) | wanted).select("doc", "page")


def route(rows: DataFrame) -> DataFrame:
    """doc_id, route, confidence: the first that applies of scanning again, layout, repair and none; unknown is not bad.

    rows: doc_id, text, quality (null: unknown).
    """
    t = F.col("text")
    s = rows.select("doc_id", Q.coverage(t).alias("coverage"), *(c.alias(n) for n, c in Q.text_quality(t).items()), (Q.column_bleed(t) > 0.3).alias("bleeds"), (F.size(F.split(t, r"\|", -1)) - 1).alias("tables"), (F.col("quality") * 0.5).alias("l3"))
    kind = (
        F.when((F.col("coverage") < 0.5) | (F.col("readable_ratio") < 0.5), "needs_ocr_fallback")
        .when(F.col("bleeds") & (F.col("tables") > 10), "needs_layout_fallback")
        .when((F.col("coverage") >= Q.MIN_COVERAGE) & (F.col("l3") > 0) & (F.col("l3") < 0.6), "needs_llm_repair")
        .otherwise("deterministic_ok")
    )
    clip = lambda c: F.greatest(F.lit(0.0), F.least(F.lit(1.0), c))
    sure = (
        F.when(F.col("route") == "needs_ocr_fallback", clip(1.0 - (F.col("coverage") * 0.5 + F.col("readable_ratio") * 0.5)))
        .when(F.col("route") == "needs_layout_fallback", 0.75)
        .when(F.col("route") == "needs_llm_repair", 0.70)
        .otherwise(clip(F.col("coverage") * 0.4 + F.col("readable_ratio") * 0.3 + (1 - F.col("gibberish_ratio")) * 0.3))
    )
    return s.withColumn("route", kind).select("doc_id", "route", F.round(sure, 3).alias("confidence"))


def audit(rows: DataFrame) -> DataFrame:
    """doc_id, fallback_only, flags from title, definition and text: any blocking sign sends a text to its fallback."""
    t = F.col("text")
    kw = rows.withColumn("kw", Q.title_keywords(F.col("title"), F.col("definition")))
    overlap = Q.keyword_overlap(F.col("kw"), t)
    signs = {
        "garble": Q.density(t, Q.GARBLE) > Q.LIMITS["garble"],
        "contents": Q.matches(t, Q.CONTENTS) >= Q.LIMITS["contents"],
        "publisher": Q.matches(t, Q.PUBLISHER) >= Q.LIMITS["publisher"],
        "drift": (F.size("kw") >= 2) & (overlap < Q.LIMITS["overlap"]),
        "screen": Q.density(t, Q.SCREEN) > Q.LIMITS["screen"],
        "corrupt": Q.matches(t, Q.CORRUPT) >= Q.LIMITS["corrupt"],
    }
    found = kw.select("doc_id", F.array_compact(F.array(*(F.when(c, n) for n, c in signs.items()))).alias("found"))
    return found.select("doc_id", (F.size("found") > 0).alias("fallback_only"), F.array_join("found", ",").alias("flags"))
