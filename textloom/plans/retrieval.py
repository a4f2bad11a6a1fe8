"""Chunking, embedding, retrieval and evaluation queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as X
from ..functions import vector as V
from ..operators import retrieval as R
from .registry import query

W = "list_filter(regexp_split_to_array(text, '[\\s\\x0b]+'), lambda x: x <> '')"
CHUNKS = f"""
w AS (SELECT doc_id, {W} AS ws FROM documents),
p AS (SELECT doc_id, ws, unnest(range(0, greatest(0, ceil((len(ws) - 150) / 120.0)::INT) + 1)) AS i FROM w WHERE len(ws) > 0),
chunks AS (SELECT doc_id, i + 1 AS n, array_to_string(ws[i * 120 + 1 : i * 120 + 150], ' ') AS text FROM p)"""


def toks(t: str) -> str:
    return f"list_filter(string_split(regexp_replace(lower({t}), '[^a-z0-9]+', ' ', 'g'), ' '), lambda x: length(x) >= 3)"


def hash_sql(t: str) -> str:
    return f"list_reduce(list_transform(string_split({t}, ''), lambda c: ord(c)::BIGINT), lambda h, c: (h * 31 + c) & 4294967295, 0::BIGINT)"


def embed_sql(t: str, dim: int = 24) -> str:
    b = f"list_transform({toks(t)}, lambda x: {hash_sql('x')} % {dim})"
    return f"list_transform(range(0, {dim}), lambda i: len(list_filter({b}, lambda y: y = i))::DOUBLE)"


def unit(v: str) -> str:
    norm = f"sqrt(list_sum(list_transform({v}, lambda x: x * x)))"
    return f"list_transform({v}, lambda x: CASE WHEN {norm} = 0 THEN 0.0::DOUBLE ELSE x / {norm} END)"


ch = lambda t: R.fixed_chunks(t("documents"))

query("chk2_fixed_chunks", f"WITH {CHUNKS} SELECT doc_id, n::INT AS n, text FROM chunks")(ch)
query("chk2_sentence_chunks")(lambda t: R.sentence_chunks(t("documents")))
query("chk6_best_size", f"WITH w AS (SELECT doc_id, len({W}) AS k FROM documents) SELECT doc_id, CASE WHEN k <= 100 THEN k ELSE greatest(100, least(200, k // 5)) END::BIGINT AS size FROM w")(
    lambda t: t("documents").select("doc_id", F.size(X.words(F.col("text"))).alias("k")).select("doc_id", R.best_size(F.col("k")).cast("long").alias("size")))
query("chk7_markdown_sections", """
WITH m AS (SELECT conv_id, string_agg('## ' || role || chr(10) || text, chr(10) ORDER BY turn) AS md FROM conversations GROUP BY conv_id),
s AS (SELECT conv_id, unnest(string_split(md, chr(10) || '## ')) AS s, generate_subscripts(string_split(md, chr(10) || '## '), 1) AS i FROM m)
SELECT conv_id, i - 1 AS pos, CASE WHEN i = 1 THEN s ELSE '## ' || s END AS section FROM s
""")(lambda t: t("conversations").groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", F.concat(F.lit("## "), "role", F.lit("\n"), "text").alias("p")))).alias("l")).select("conv_id", F.posexplode(X.segments_of_markdown(F.array_join("l.p", "\n"))).alias("pos", "section")))
query("emb1_tokens", f"SELECT doc_id, len({toks('text')})::INT AS n, array_to_string({toks('text')}, ' ') AS tokens FROM documents")(
    lambda t: t("documents").select("doc_id", V.tokens(F.col("text")).alias("t")).select("doc_id", F.size("t").alias("n"), F.array_join("t", " ").alias("tokens")))
query("emb2_token_hashes", f"WITH d AS (SELECT DISTINCT unnest({toks('text')}) AS token FROM documents) SELECT token, {hash_sql('token')} AS hash FROM d")(
    lambda t: t("documents").select(F.explode(V.tokens(F.col("text"))).alias("token")).distinct().select("token", V.token_hash(F.col("token")).alias("hash")))
query("emb3_hash_embedding", f"""WITH c AS (SELECT item_id, {embed_sql('text')} AS v FROM benchmark), u AS (SELECT item_id, {unit('v')} AS v FROM c)
SELECT item_id, unnest(range(0, 24))::INT AS i, round(unnest(v), 9) AS x FROM u""")(lambda t: t("benchmark").select("item_id", F.posexplode(V.embed(F.col("text"))).alias("i", "x")).select("item_id", "i", F.round("x", 9).alias("x")))
query("emb3_bucket_counts", f"""WITH {CHUNKS}, b AS (SELECT doc_id, n, unnest({toks('text')}) AS token FROM chunks), d AS (SELECT token, {hash_sql('token')} % 24 AS bucket FROM (SELECT DISTINCT token FROM b))
SELECT doc_id, n::INT AS n, bucket, count(*) AS c FROM b JOIN d USING (token) GROUP BY ALL""")(
    lambda t: (lambda b: b.join(b.select("token").distinct().select("token", (V.token_hash(F.col("token")) % 24).alias("bucket")), "token").groupBy("doc_id", "n", "bucket").agg(F.count("*").alias("c")))(ch(t).select("doc_id", "n", F.explode(V.tokens(F.col("text"))).alias("token"))))


def cos(a: str, b: str) -> str:
    dot = f"list_sum(list_transform(list_zip({a}, {b}), lambda z: z[1]::DOUBLE * z[2]::DOUBLE))"
    norm = lambda v: f"sqrt(list_sum(list_transform({v}, lambda x: x::DOUBLE * x::DOUBLE)))"
    return f"CASE WHEN {norm(a)} = 0 OR {norm(b)} = 0 THEN 0.0::DOUBLE ELSE {dot} / ({norm(a)} * {norm(b)}) END"


query("ret1_cosine", f"""WITH c AS (SELECT label, list_transform(range(1, 65), lambda i: 0.0) AS z FROM embeddings GROUP BY label), q AS (SELECT label, arg_min(embedding, vec_id) AS q FROM embeddings GROUP BY label)
SELECT vec_id, e.label, round({cos('e.embedding', 'q.q')}, 6) AS score FROM embeddings e JOIN q USING (label)""")(
    lambda t: t("embeddings").join(t("embeddings").groupBy("label").agg(F.min_by("embedding", "vec_id").alias("q")), "label").select("vec_id", "label", F.round(V.cosine(F.col("embedding"), F.col("q")), 6).alias("score")))
_tops = f"""WITH {CHUNKS}, cv AS (SELECT doc_id, n, {unit('e')} AS v FROM (SELECT doc_id, n, {embed_sql('text')} AS e FROM chunks)), q AS (SELECT item_id AS query_id, {unit('e')} AS q FROM (SELECT item_id, {embed_sql('text')} AS e FROM benchmark)),
s AS (SELECT query_id, doc_id, n, round({cos('q', 'v')}, 9) AS score FROM cv, q), r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id, n) AS rank FROM s)"""


def _tops_of(t):
    chunks = ch(t).select("doc_id", "n", V.embed(F.col("text")).alias("v"))
    queries = t("benchmark").select(F.col("item_id").alias("query_id"), V.embed(F.col("text")).alias("q"))
    return chunks, queries


query("ret2_top_chunks", f"{_tops} SELECT query_id, rank::INT AS rank, doc_id, n, round(score, 4) AS score FROM r WHERE rank <= 5")(lambda t: R.top_chunks(*reversed(_tops_of(t))).withColumn("score", F.round("score", 4)))
query("ret3_success_rate", f"{_tops}, h AS (SELECT r.query_id, max(contains(d.text, b.text)::INT) AS hit FROM r JOIN documents d USING (doc_id) JOIN benchmark b ON b.item_id = r.query_id WHERE rank <= 5 GROUP BY r.query_id) SELECT count(*) AS queries, round(avg(hit), 4) AS success_rate FROM h")(
    lambda t: R.top_chunks(*reversed(_tops_of(t))).join(t("documents").select("doc_id", "text"), "doc_id").join(t("benchmark").select(F.col("item_id").alias("query_id"), F.col("text").alias("wanted")), "query_id").groupBy("query_id").agg(F.max(F.contains("text", F.col("wanted")).cast("int")).alias("hit")).agg(F.count("*").alias("queries"), F.round(F.avg("hit"), 4).alias("success_rate")))
_cq = "(CASE WHEN length(text) < 50 THEN 0.5::DOUBLE WHEN length(text) < 100 THEN 0.8::DOUBLE ELSE 1.0::DOUBLE END)"
query("evl2_chunk_quality", f"WITH {CHUNKS} SELECT doc_id, n::INT AS n, {_cq} AS quality FROM chunks")(lambda t: R.chunk_quality(ch(t).withColumn("v", F.array(F.lit(1.0)))))
query("evl1_concept_coverage", """
WITH e AS (SELECT DISTINCT p_brand AS c FROM part), f AS (SELECT DISTINCT 'Brand#' || (10 + s_suppkey % 50) AS c FROM supplier)
SELECT (SELECT count(*) FROM e) AS expected, (SELECT count(*) FROM e SEMI JOIN f USING (c)) AS covered, (SELECT count(*) FROM e ANTI JOIN f USING (c)) AS missing, (SELECT count(*) FROM f ANTI JOIN e USING (c)) AS extra
""")(lambda t: (lambda e, f: e.withColumn("e", F.lit(1)).join(f.withColumn("f", F.lit(1)), "c", "full_outer").agg(F.count("e").alias("expected"), F.count(F.when(F.col("e").isNotNull() & F.col("f").isNotNull(), 1)).alias("covered"), F.count(F.when(F.col("f").isNull(), 1)).alias("missing"), F.count(F.when(F.col("e").isNull(), 1)).alias("extra")))(
    t("part").select(F.col("p_brand").alias("c")).distinct(), t("supplier").select(F.concat(F.lit("Brand#"), (10 + F.col("s_suppkey") % 50).cast("string")).alias("c")).distinct()))
query("evl3_grades", f"WITH {CHUNKS}, d AS (SELECT doc_id, avg({_cq}) AS s FROM chunks GROUP BY doc_id) SELECT doc_id, round(s, 6) AS score, CASE " + " ".join(f"WHEN s >= {a} THEN '{g}'" for a, g in R.GRADES) + " ELSE 'F' END AS grade FROM d")(
    lambda t: R.chunk_quality(ch(t).withColumn("v", F.array(F.lit(1.0)))).groupBy("doc_id").agg(F.avg("quality").alias("s")).select("doc_id", F.round("s", 6).alias("score"), R.grade(F.col("s")).alias("grade")))
# the documents that have a label are the baseline, all documents what there is now
query("evl5_regression", """
WITH b AS (SELECT source, count(*) AS x FROM documents SEMI JOIN labels USING (doc_id) GROUP BY source), c AS (SELECT source, count(*) AS y FROM documents GROUP BY source)
SELECT source, coalesce(x, 0) AS before, coalesce(y, 0) AS now, CASE WHEN y IS NULL THEN 'error' WHEN x IS NULL THEN 'warning' WHEN abs(y - x) / x::DOUBLE > 0.1 THEN 'error' WHEN y <> x THEN 'info' ELSE 'ok' END AS severity FROM b FULL JOIN c USING (source)
""")(lambda t: R.regression(t("documents").join(t("labels"), "doc_id", "left_semi"), t("documents"), "source"))
query("evl6_manifest_regression", "SELECT * FROM (SELECT 'missing' AS kind, o_orderstatus AS id FROM orders EXCEPT SELECT 'missing', l_linestatus FROM lineitem) UNION ALL SELECT * FROM (SELECT 'extra' AS kind, l_linestatus AS id FROM lineitem EXCEPT SELECT 'extra', o_orderstatus FROM orders)")(
    lambda t: (lambda a, b: a.exceptAll(b).select(F.lit("missing").alias("kind"), "id").union(b.exceptAll(a).select(F.lit("extra").alias("kind"), "id")))(t("orders").select(F.col("o_orderstatus").alias("id")).distinct(), t("lineitem").select(F.col("l_linestatus").alias("id")).distinct()))
query("evl8_content_hash", "SELECT doc_id, sha256(text) AS sha256 FROM documents")(lambda t: t("documents").select("doc_id", F.sha2(F.col("text").cast("binary"), 256).alias("sha256")))
