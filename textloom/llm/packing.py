"""Mixture-controlled packing by deficit round-robin over source queues.

Documents become ids (plus a closing id 0 each) and wait in one queue per
source. Each window of `length` ids adds to every queue's deficit its share of
the window; the queue with the largest deficit is served, at least `least` ids
at a time, until the window is full, and what is left of a deficit is carried
into the next window. Shards of about `shard_tokens` ids run independently:
what the shards before owe each queue, share * ids - ids served, is a prefix
sum of counts, so deficits are carried across shards without running them in
order. The end of a shard is cut into sequences of powers of two: no padding.
Every source that `targets` names has a queue, and the largest others do; the
rest wait in one more, in which their documents stand in turn: each at the middle
of its place among its source's ids, so that every stretch holds each source's share.

Defined results: a null or empty text is the single id 0; a null source is a
queue of its own; repeated rows are documents of their own; an empty table
gives no piece; a document longer than a window is cut; the ids of one
document are the most that a task must hold beyond its shard; a target that no
document has is served by the others. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from . import bpe
from .common import cut, released, table

LENGTH = 1024
SHARD_TOKENS = 1 << 22
LEAST = 128
#: Queues besides those that targets name.
MAX_QUEUES = 256
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def tokenise(docs: DataFrame, path: str, by: str = "source") -> DataFrame:
    """uid, doc_id, queue, n, ids: little-endian ids of each document with the closing 0, two bytes each where they fit."""
    width = "<u2" if bpe.id_bound(path) <= 1 << 16 else "<u4"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, _, _, ids, at in bpe.encode_batch(batch, path):
                rows = part.num_rows
                closed = np.insert(ids, at[1:], 0).astype(width)
                ends = (at + np.arange(rows + 1)) * closed.itemsize
                blob = pa.Array.from_buffers(pa.large_binary(), rows, [None, pa.py_buffer(np.ascontiguousarray(ends, dtype=np.int64)), pa.py_buffer(closed)])
                yield pa.RecordBatch.from_arrays([part.column("uid"), part.column("doc_id").cast(pa.int64()), part.column("queue"), pa.array(np.diff(at) + 1, pa.int64()), blob.cast(pa.binary())], ["uid", "doc_id", "queue", "n", "ids"])

    rows = docs.select(F.monotonically_increasing_id().alias("uid"), "doc_id", F.col(by).cast("string").alias("queue"), "text")
    return rows.mapInArrow(released(run), "uid long, doc_id long, queue string, n long, ids binary")


def sequence_sizes(total: int, length: int) -> np.ndarray:
    """Full windows, then the powers of two that the rest is made of."""
    rest = [1 << b for b in range(length.bit_length(), -1, -1) if (total % length) >> b & 1]
    return np.array([length] * (total // length) + rest, dtype=np.int64)


def serve(lengths: list[int], deficits: np.ndarray, shares: np.ndarray, sizes: np.ndarray, least: int) -> list[tuple[int, int, int]]:
    """(sequence, queue, ids) in the order served. deficits is changed: what is carried on."""
    left = np.array(lengths, dtype=np.int64)
    out = []
    owed = deficits
    for k, size in enumerate(sizes.tolist()):
        owed += shares * size
        room = size
        while room:
            q = int(np.argmax(np.where(left > 0, owed, -np.inf)))
            take = min(room, int(left[q]), max(least, int(owed[q])))
            if room - take < least:
                take = min(room, int(left[q]))
            out.append((k, q, take))
            left[q] -= take
            owed[q] -= take
            room -= take
    return out


def pack_shard(queues: list[tuple[np.ndarray, np.ndarray, np.ndarray]], deficits: np.ndarray, shares: np.ndarray, length: int, least: int) -> dict[str, np.ndarray]:
    """queues: per queue its documents' ids, lengths and ids one after the other. Columns of the pieces, and the ids of each."""
    totals = [int(n.sum()) for _, n, _ in queues]
    served = serve(totals, deficits, shares, sequence_sizes(sum(totals), length), least)
    at = [0] * len(queues)
    offset, before = 0, -1
    ends = [np.cumsum(n) for _, n, _ in queues]
    rows = []
    for k, q, take in served:
        if k != before:
            offset, before = 0, k
        doc_ids, n, flat = queues[q]
        a, stop = at[q], at[q] + take
        doc = int(np.searchsorted(ends[q], a, side="right"))
        while a < stop:
            b = min(stop, int(ends[q][doc]))
            begin = int(ends[q][doc]) - int(n[doc])
            rows.append((doc_ids[doc], a - begin, b - a, zlib.crc32(np.ascontiguousarray(flat[a:b], dtype="<u4")), int(n[doc]), k, offset))
            offset += b - a
            a, doc = b, doc + 1
        at[q] = stop
    return rows


def in_turn(q: np.ndarray, source: np.ndarray, n: np.ndarray) -> np.ndarray:
    """An order of rows sorted by (q, source): within a queue by the middle of each among its source's ids, as a share of them."""
    if not len(q):
        return np.zeros(0, np.int64)
    new = np.append(True, (q[1:] != q[:-1]) | (source[1:] != source[:-1]))
    run = np.cumsum(new) - 1
    ends = np.cumsum(n)
    before = (ends - n)[new][run]
    total = np.bincount(run, weights=n)[run]
    return np.lexsort((source, (ends - n / 2 - before) / total, q))


def pack(docs: DataFrame, path: str | None = None, by: str = "source", targets: dict[str, float] | None = None, length: int = LENGTH, shard_tokens: int = SHARD_TOKENS, least: int = LEAST, max_queues: int = MAX_QUEUES) -> DataFrame:
    """One row per piece (PIECES). targets: shares by queue; by default those of all ids."""
    spark = docs.sparkSession
    ids = cut(tokenise(docs, path or bpe.vocabulary_path(), by), "ids")
    totals = ids.groupBy("queue").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), F.asc_nulls_first("queue"))
    # at most max_queues rows and those that targets name: each of the largest, and the sum of all others
    ranked = totals.limit(max_queues - 1).collect()
    if targets:
        ranked += [r for r in totals.filter(F.col("queue").isin(list(targets))).collect() if r not in ranked]
    everything = ids.agg(F.sum("n")).first()[0] or 0
    names = [r["queue"] for r in ranked]
    sums = [r["n"] for r in ranked]
    # the last queue, of all other sources, has no name that a source could have
    wanted = np.array([*(float((targets or {}).get(name, 0)) for name in names), 0.0]) if targets else np.array([*sums, everything - sum(sums)], dtype=float)
    names.append(None)
    shares = wanted / wanted.sum() if wanted.sum() > 0 else np.full(len(names), 1 / len(names))
    known = spark.createDataFrame([(name, k) for k, name in enumerate(names[:-1])] or [("", -1)], "name string, q int")
    shards = max(1, -(-everything // shard_tokens))
    rows = ids.join(F.broadcast(known), F.col("queue").eqNullSafe(F.col("name")), "left").select(
        "uid", "doc_id", F.coalesce("q", F.lit(len(names) - 1)).alias("q"), F.when(F.col("q").isNull(), F.xxhash64("queue")).otherwise(0).alias("source"), "n", "ids", F.pmod(F.xxhash64("uid"), F.lit(shards)).alias("shard"))
    counts = rows.groupBy("shard", "q").agg(F.sum("n").alias("n"))
    grid = counts.groupBy("shard").agg(F.sum("n").alias("total"), F.map_from_entries(F.collect_list(F.struct("q", "n"))).alias("by_queue"))
    grid = grid.select("shard", "total", "by_queue", F.explode(F.sequence(F.lit(0), F.lit(len(names) - 1))).alias("q")).select("shard", "total", "q", F.coalesce(F.expr("by_queue[q]"), F.lit(0)).alias("n"))
    before = Window.partitionBy("q").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    carried = grid.select(F.col("shard").alias("home"), F.col("q"), F.coalesce(F.sum("total").over(before), F.lit(0)).alias("total"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("served"))

    def run(key: tuple, shard: pa.Table, owed: pa.Table) -> pa.Table:
        if not shard.num_rows:
            return pa.Table.from_pylist([], schema=schema)
        deficits = np.zeros(len(shares))
        q = owed.column("q").to_numpy()
        deficits[q] = shares[q] * owed.column("total").to_numpy() - owed.column("served").to_numpy()
        shard = shard.sort_by([("q", "ascending"), ("source", "ascending"), ("uid", "ascending")])
        shard = shard.take(in_turn(*(shard.column(c).to_numpy() for c in ("q", "source", "n"))))
        which, n = shard.column("q").to_numpy(), shard.column("n").to_numpy()
        doc_ids = shard.column("doc_id").to_pylist()
        data = b"".join(shard.column("ids").to_pylist())
        flat = np.frombuffer(data, dtype="<u2" if len(data) == 2 * int(n.sum()) else "<u4")
        first = np.append(0, np.cumsum(n))
        queues = []
        for k in range(len(shares)):
            a, b = np.searchsorted(which, [k, k + 1])
            queues.append((doc_ids[a:b], n[a:b], flat[first[a] : first[b]]))
        found = pack_shard(queues, deficits, shares, length, least)
        base = key[0].as_py() << 32
        columns = list(zip(*found))
        columns[5] = [base + k for k in columns[5]]
        return pa.Table.from_arrays([pa.array(c, pa.int64()) for c in columns], schema=schema)

    schema = pa.schema([(x.split()[0], pa.int64()) for x in PIECES.split(", ")])
    return rows.groupBy("shard").cogroup(carried.groupBy("home")).applyInArrow(run, PIECES)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))
