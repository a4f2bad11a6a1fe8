"""Concept registry, matching, identity, prerequisite graph and provenance."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..sources.shared import cut

#: A small registry of our own: id, name, keywords, category, difficulty.
CONCEPTS = [
    ("select-basic", "select basics", ["select", "column", "query"], "query", "beginner"), ("where-filter", "filtering rows", ["where", "filter", "condition"], "query", "beginner"),
    ("order-by", "sorting rows", ["order", "sort"], "query", "beginner"), ("aggregate", "aggregate functions", ["count", "sum", "average"], "summary", "intermediate"),
    ("group-by", "grouping rows", ["group", "having"], "summary", "intermediate"), ("inner-join", "joining tables", ["join", "inner", "table"], "join", "intermediate"),
    ("outer-join", "outer joins", ["outer", "left", "join"], "join", "intermediate"), ("subquery", "subqueries", ["subquery", "nested"], "query", "advanced"),
    ("window", "window functions", ["window", "partition", "over"], "summary", "advanced"), ("recursion", "recursive queries", ["recursive", "hierarchy"], "query", "advanced"),
]
#: (from, to, hard): from is a prerequisite of to, in this order.
EDGES = [
    ("select-basic", "where-filter", True), ("select-basic", "order-by", True), ("select-basic", "aggregate", True), ("where-filter", "inner-join", False), ("aggregate", "group-by", True),
    ("select-basic", "inner-join", True), ("inner-join", "outer-join", True), ("where-filter", "subquery", True), ("inner-join", "subquery", False), ("group-by", "window", True), ("order-by", "window", False), ("subquery", "recursion", True),
]
ALIASES = [("joins", "inner-join"), ("grouping", "group-by"), ("sorting", "order-by"), ("old-topic", "no-such-concept")]


def registry(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(CONCEPTS, "id string, name string, keywords array<string>, category string, difficulty string")


def edges(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(i, *e) for i, e in enumerate(EDGES)], "ord int, src string, dst string, hard boolean")


def match_headings(headings: DataFrame, concepts: DataFrame, least: float = 0.3) -> DataFrame:
    """key, id, confidence, how of every candidate above `least` for (key, heading): name, keyword, category, then shared words.

    The registry is a fixed small table and is broadcast.
    """
    h = F.lower("heading")
    pairs = headings.crossJoin(F.broadcast(concepts))
    words = F.array_distinct(F.filter(F.split(h, r"[^a-z]+"), lambda w: w != ""))
    name_words = F.split(F.lower("name"), " ")
    hits = F.aggregate("keywords", F.lit(0.0), lambda a, k: a + F.when(F.contains(h, k), 1.0).otherwise(0.0))
    shared = F.size(F.array_intersect(words, name_words)) / F.greatest(F.size(words), F.size(name_words))
    scores = pairs.select("key", "id", F.when(F.contains(h, F.lower("name")) | (F.contains(F.lower("name"), h) & (h != "")), 0.95).otherwise(0.0).alias("name"), F.when(hits > 0, F.least(F.lit(0.9), 0.5 + 0.1 * hits)).otherwise(0.0).alias("keyword"),
                          F.when(F.contains(h, F.col("category")), 0.4).otherwise(0.0).alias("category"), F.when(shared > 0.3, F.least(F.lit(0.7), shared)).otherwise(0.0).alias("fuzzy"))
    best = scores.withColumn("confidence", F.greatest("name", "keyword", "category", "fuzzy"))
    how = F.when(F.col("confidence") == F.col("name"), "name").when(F.col("confidence") == F.col("keyword"), "keyword").when(F.col("confidence") == F.col("category"), "category").otherwise("fuzzy")
    return best.filter(F.col("confidence") > least).select("key", "id", "confidence", how.alias("how"))


def resolve(ids: DataFrame, concepts: DataFrame, aliases: DataFrame) -> DataFrame:
    """raw, id, how: exact, then alias, then normalised (lower case, blanks and underscores as hyphens), else none."""
    known = F.broadcast(concepts.select(F.col("id").alias("known")))
    norm = F.regexp_replace(F.lower(F.trim("raw")), r"[_\s]+", "-")
    a = F.broadcast(aliases.join(concepts.select(F.col("id").alias("to")), "to").select("alias", F.col("to")))
    rows = ids.withColumn("norm", norm).join(known, F.col("raw") == F.col("known"), "left").join(a, F.col("raw") == F.col("alias"), "left").join(F.broadcast(concepts.select(F.col("id").alias("n"))), F.col("norm") == F.col("n"), "left")
    how = F.when(F.col("known").isNotNull(), "exact").when(F.col("to").isNotNull(), "alias").when(F.col("n").isNotNull(), "normalised").otherwise("none")
    return rows.select("raw", F.coalesce("known", "to", "n").alias("id"), how.alias("how"))


def closure(links: DataFrame) -> DataFrame:
    """src, dst, depth: every reachable pair with its least number of steps; rounds end when no pair is new."""
    found = links.select("src", "dst").distinct().withColumn("depth", F.lit(1))
    step = links.select(F.col("src").alias("mid"), F.col("dst").alias("to")).distinct()
    ahead, depth = found, 1
    while True:
        depth += 1
        ahead = ahead.join(step, F.col("dst") == F.col("mid")).select("src", F.col("to").alias("dst")).distinct().join(found, ["src", "dst"], "left_anti").withColumn("depth", F.lit(depth))
        ahead = cut(ahead, "closure")
        if ahead.isEmpty():
            return found
        found = found.unionByName(ahead)


def textbook_order(links: DataFrame) -> DataFrame:
    """id, needs, place: concepts by how many others they need, directly or not, then by id; what is needed comes first where links have no cycle."""
    nodes = links.select(F.col("src").alias("id")).union(links.select("dst")).distinct()
    needs = closure(links).groupBy(F.col("dst").alias("id")).agg(F.count_distinct("src").alias("needs"))
    # the concepts of an ontology are few
    return nodes.join(needs, "id", "left").select("id", F.coalesce("needs", F.lit(0)).alias("needs")).withColumn("place", F.row_number().over(Window.orderBy("needs", "id")))


def learning_order(links: DataFrame, goal: str) -> DataFrame:
    """id, depth of what must be learned before goal by hard links, deepest first by id, goal last."""
    need = closure(links.filter("hard")).filter(F.col("dst") == goal).select(F.col("src").alias("id"), "depth")
    return need.unionByName(links.sparkSession.createDataFrame([(goal, 0)], "id string, depth int"))


def shared_links(units: DataFrame, links: DataFrame) -> DataFrame:
    """Links whose both ends have a unit."""
    have = units.select("concept").distinct()
    return links.join(have, F.col("src") == F.col("concept"), "left_semi").join(have, F.col("dst") == F.col("concept"), "left_semi")


def last_wins(rows: DataFrame, key: str, order: Column) -> DataFrame:
    """Of each key the row that comes last: a merge of maps."""
    return rows.withColumn("k", F.row_number().over(Window.partitionBy(key).orderBy(order.desc()))).filter("k = 1").drop("k")


def bridge(records: DataFrame) -> DataFrame:
    """concept, chunk pairs of (concept, chunks): both directions of provenance are joins on it."""
    return records.select("concept", F.explode("chunks").alias("chunk")).distinct()


def merge_records(records: DataFrame) -> DataFrame:
    """concept, pages, confidence: union of pages, mean confidence."""
    return records.groupBy("concept").agg(F.sort_array(F.array_distinct(F.flatten(F.collect_list("pages")))).alias("pages"), F.round(F.avg("confidence"), 6).alias("confidence"))


def manifest(sections: DataFrame, chunks: DataFrame) -> DataFrame:
    """concept, page, position, chunks, first_chunk, last_chunk: a row for each page of a concept, however many chunks it has."""
    pages = sections.select("concept", F.explode("pages").alias("page")).distinct()
    # chunks are counted by page before they meet the concepts
    counts = chunks.groupBy("page").agg(F.count("*").alias("chunks"), F.min("chunk").alias("first_chunk"), F.max("chunk").alias("last_chunk"))
    place = F.row_number().over(Window.partitionBy("concept").orderBy("page"))
    return pages.join(counts, "page").select("concept", "page", place.alias("position"), "chunks", "first_chunk", "last_chunk")