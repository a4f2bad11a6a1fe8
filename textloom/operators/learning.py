"""Spaced repetition and mastery over answer histories."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

LEAST_EASE, FIRST_EASE = 1.3, 2.5


def history(orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    """learner, concept, seq, correct, seconds of the order tables: a returned item is a wrong answer."""
    rows = orders.join(lineitem, F.col("o_orderkey") == F.col("l_orderkey"))
    w = Window.partitionBy("learner", "concept").orderBy("o_orderdate", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_shipdate")
    rows = rows.select(F.col("o_custkey").alias("learner"), (F.col("l_suppkey") % 10).alias("concept"), (F.col("l_returnflag") != "R").alias("correct"), (F.col("l_quantity") * 2).cast("double").alias("seconds"), "o_orderdate", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_shipdate")
    return rows.withColumn("seq", F.row_number().over(w)).select("learner", "concept", "seq", "correct", "seconds")


def recent(rows: DataFrame, n: int = 3) -> DataFrame:
    """learner, concept, rate, seconds, answers: success and mean time of the last n answers."""
    back = F.row_number().over(Window.partitionBy("learner", "concept").orderBy(F.desc("seq")))
    last = rows.withColumn("k", back)
    return last.groupBy("learner", "concept").agg(F.avg(F.when(F.col("k") <= n, F.col("correct").cast("double"))).alias("rate"), F.avg(F.when(F.col("k") <= n, F.col("seconds"))).alias("seconds"), F.count("*").alias("answers"))


def quality(rate: Column, seconds: Column, quick: float = 30.0, slow: float = 80.0) -> Column:
    """0 to 5 from the success rate, one more for quick answers, one less for slow ones."""
    base = F.when(rate >= 0.9, 5).when(rate >= 0.7, 4).when(rate >= 0.5, 3).when(rate >= 0.3, 2).when(rate > 0, 1).otherwise(0)
    return F.when(seconds < quick, F.least(F.lit(5), base + 1)).when(seconds > slow, F.greatest(F.lit(0), base - 1)).otherwise(base)


def review_step(state: Column, q: Column) -> Column:
    """SM-2: struct(days, ease, reviews) after an answer of quality q."""
    ease = F.greatest(F.lit(LEAST_EASE), state["ease"] + (0.1 - (5 - q) * (0.08 + (5 - q) * 0.02)))
    days = F.when(q < 3, 1.0).when(state["reviews"] == 0, 1.0).when(state["reviews"] == 1, 6.0).otherwise(state["days"] * state["ease"])
    return F.struct(days.alias("days"), ease.alias("ease"), F.when(q < 3, 0).otherwise(state["reviews"] + 1).alias("reviews"))


def schedule(rows: DataFrame) -> DataFrame:
    """learner, concept, days, ease, reviews after all answers in order; right is 5, right but slow 3, wrong 1."""
    q = F.when(~F.col("correct"), 1).when(F.col("seconds") > 80, 3).otherwise(5)
    start = F.struct(F.lit(1.0).alias("days"), F.lit(FIRST_EASE).cast("double").alias("ease"), F.lit(0).alias("reviews"))
    ordered = rows.groupBy("learner", "concept").agg(F.sort_array(F.collect_list(F.struct("seq", q.alias("q")))).alias("a"))
    out = ordered.select("learner", "concept", F.aggregate("a", start, lambda s, x: review_step(s, x["q"].cast("double"))).alias("s"))
    return out.select("learner", "concept", F.round("s.days", 6).alias("days"), F.round("s.ease", 6).alias("ease"), F.col("s.reviews").alias("reviews"))


def round_robin(items: DataFrame, by: str, kind: str, order: list[str], most: int) -> DataFrame:
    """The first `most` items of each group, one of each kind in turn."""
    turn = F.row_number().over(Window.partitionBy(by, kind).orderBy(*order))
    place = F.row_number().over(Window.partitionBy(by).orderBy("turn", kind))
    return items.withColumn("turn", turn).withColumn("place", place).filter(F.col("place") <= most)


def mastery(rows: DataFrame) -> DataFrame:
    """learner, concept, attempts, solved, confidence (running mean), mastery (capped sum)."""
    sums = rows.groupBy("learner", "concept").agg(F.count("*").alias("attempts"), F.sum(F.col("correct").cast("int")).alias("solved"), F.round(F.avg(1 - F.col("seconds") / 200), 6).alias("confidence"))
    return sums.withColumn("mastery", F.least(F.lit(1.0), F.round(F.col("solved") * F.lit(0.1), 6)))


def blocked(levels: DataFrame, links: DataFrame, least: float = 0.5) -> DataFrame:
    """learner, concept pairs one of whose prerequisites the learner has not mastered. links: src, dst concepts."""
    learners = levels.select("learner").distinct()
    need = learners.join(F.broadcast(links.select(F.col("src").alias("concept"), "dst")), how="cross")
    short = need.join(levels, ["learner", "concept"], "left").filter(F.coalesce("mastery", F.lit(0.0)) < least)
    return short.select("learner", F.col("dst").alias("concept")).distinct()
