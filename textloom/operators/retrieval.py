"""Chunking, retrieval and evaluation of an index."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as X
from ..functions import vector as V

SIZE, OVERLAP, LEAST = 150, 30, 20
#: Marks that end a sentence, CJK ones included.
SENTENCE_ENDS = ".!?。！？"
GRADES = [(0.95, "A+"), (0.90, "A"), (0.85, "A-"), (0.80, "B+"), (0.75, "B"), (0.70, "B-"), (0.65, "C+"), (0.60, "C")]


def fixed_chunks(docs: DataFrame, size: int = SIZE, overlap: int = OVERLAP) -> DataFrame:
    """doc_id, n (from 1), text: windows of `size` words that share `overlap`; the last may be short."""
    step = max(1, size - overlap)
    rows = docs.select("doc_id", X.words(F.col("text")).alias("w")).filter(F.size("w") > 0)
    last = F.greatest(F.lit(0), F.ceil((F.size("w") - size) / step).cast("int"))
    each = rows.select("doc_id", "w", F.explode(F.sequence(F.lit(0), last)).alias("i"))
    return each.select("doc_id", (F.col("i") + 1).alias("n"), F.array_join(F.slice("w", F.col("i") * step + 1, size), " ").alias("text"))


def _boundary(text: str, target: int, reach: int = 50) -> int:
    """The end of a sentence nearest to target, its following blanks included; target itself if none is near."""
    if target >= len(text):
        return len(text)

    def after(i: int) -> int:
        i += 1
        while i < len(text) and text[i] in " \n\t":
            i += 1
        return i

    ahead = next((after(i) for i in range(target, min(len(text), target + reach)) if text[i] in SENTENCE_ENDS), target)
    behind = next((after(i) for i in range(target, max(0, target - reach), -1) if text[i] in SENTENCE_ENDS), target)
    if abs(ahead - target) <= abs(behind - target) and abs(ahead - target) <= reach:
        return ahead
    return behind if abs(behind - target) <= reach else target


def sentence_chunks(docs: DataFrame, size: int = SIZE, overlap: int = OVERLAP) -> DataFrame:
    """doc_id, chunk_id, n, text, char_start, char_end: windows whose step follows the last whole sentence; Arrow batches, one document at a time."""
    size = max(size, LEAST)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                words = (text or "").split()
                start = n = at = 0
                while start < len(words):
                    piece = words[start : start + size]
                    joined = " ".join(piece)
                    n += 1
                    out.append((doc_id, f"{doc_id}:p1:c{n}", n, joined, at, at + len(joined)))
                    if start + size >= len(words):
                        break
                    cut = _boundary(joined, len(joined) - 20)
                    whole = len(joined[:cut].split()) if cut < len(joined) - 10 else size
                    step = max(1, whole - overlap)
                    at += sum(len(w) + 1 for w in words[start : start + step])
                    start += step
            columns = list(zip(*out)) if out else [[]] * 6
            types = [pa.int64(), pa.string(), pa.int32(), pa.string(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], ["doc_id", "chunk_id", "n", "text", "char_start", "char_end"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, chunk_id string, n int, text string, char_start long, char_end long")


def best_size(words: Column) -> Column:
    """A chunk size for a text of so many words: all of up to 100, else a fifth between 100 and 200."""
    return F.when(words <= 100, words).otherwise(F.greatest(F.lit(100), F.least(F.lit(200), F.floor(words / 5))))


def top_chunks(queries: DataFrame, chunks: DataFrame, k: int = 5, block: int = 4096) -> DataFrame:
    """query_id, rank, doc_id, n, score: the k nearest chunks of each query by cosine (nine digits), ties by (doc_id, n).

    queries (query_id, q) are the stated query set. They come to the driver in
    blocks of `block` vectors and are met by every chunk with one matrix product a batch;
    each batch gives its k best of a query, so what is shuffled does not grow with a batch.
    """
    spark = queries.sparkSession

    def met(ids: list[int], q: np.ndarray):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if not batch.num_rows:
                    continue
                v = np.array(batch.column("v").to_pylist(), dtype=float)
                norm = np.sqrt((v * v).sum(axis=1))
                with np.errstate(divide="ignore", invalid="ignore"):
                    score = np.round(np.where((norm[:, None] > 0) & (q_norm > 0), (v @ q.T) / (norm[:, None] * q_norm), 0.0), 9)
                doc, n = batch.column("doc_id").to_numpy(), batch.column("n").to_numpy()
                for j, i in enumerate(ids):
                    best = np.lexsort((n, doc, -score[:, j]))[:k]
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(best), i, dtype=np.int64)), pa.array(doc[best].astype(np.int64)), pa.array(n[best].astype(np.int64)), pa.array(score[best, j])], ["query_id", "doc_id", "n", "score"])

        q_norm = np.sqrt((q * q).sum(axis=1))
        return run

    parts, held = [], []

    def flush() -> None:
        if held:
            parts.append(chunks.select("doc_id", "n", "v").mapInArrow(met([r["query_id"] for r in held], np.array([r["q"] for r in held], dtype=float)), "query_id long, doc_id long, n long, score double"))
            held.clear()

    for row in queries.select("query_id", "q").toLocalIterator():
        held.append(row)
        if len(held) == block:
            flush()
    flush()
    if not parts:
        return spark.createDataFrame([], "query_id long, rank int, doc_id long, n long, score double")
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "doc_id", "n")
    every = reduce(DataFrame.unionByName, parts)
    return every.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k).select("query_id", "rank", "doc_id", "n", "score")


def chunk_quality(chunks: DataFrame) -> DataFrame:
    """doc_id, n, quality: short chunks, chunks without a vector and chunks of control characters score less."""
    size = F.length("text")
    odd = size - F.length(F.regexp_replace("text", r"[\x00-\x08\x0b\x0c\x0e-\x1f]", ""))
    short = F.when(size < 50, 0.5).when(size < 100, 0.8).otherwise(1.0)
    return chunks.select("doc_id", "n", (short * F.when(F.col("v").isNull() | (F.size("v") == 0), 0.3).otherwise(1.0) * F.when((size > 0) & (odd / size > 0.1), 0.5).otherwise(1.0)).alias("quality"))


def grade(score: Column) -> Column:
    out = F.lit("F")
    for least, name in reversed(GRADES):
        out = F.when(score >= least, name).otherwise(out)
    return out


def regression(baseline: DataFrame, current: DataFrame, by: str, drift: float = 0.1) -> DataFrame:
    """by, before, now, severity: documents that went (error), came (warning) or whose count drifts (error) or changes (info)."""
    a = baseline.groupBy(by).agg(F.count("*").alias("before"))
    b = current.groupBy(by).agg(F.count("*").alias("now"))
    both = a.join(b, by, "full_outer")
    change = F.abs(F.col("now") - F.col("before")) / F.col("before")
    kind = F.when(F.col("now").isNull(), "error").when(F.col("before").isNull(), "warning").when(change > drift, "error").when(change > 0, "info").otherwise("ok")
    return both.select(by, F.coalesce("before", F.lit(0)).alias("before"), F.coalesce("now", F.lit(0)).alias("now"), kind.alias("severity"))
