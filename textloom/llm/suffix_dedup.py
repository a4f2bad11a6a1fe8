"""Suffix-array deduplication of byte strings, keeping the first copy.

A byte goes if a string of LENGTH bytes that covers it also starts earlier in the
corpus (smaller doc_id, or same document and earlier start). Strings never cross
documents.

Every string of LENGTH bytes has one anchor: of its GRAM-byte grams the one first
by (is common, hash, place). Equal strings have equal anchors at equal places, so
strings are dealt out by their anchor: the consecutive starts of a document with
one anchor form a run, shipped as two hashes and a place. Runs of equal text are
alike in all their strings, so only the first of them is looked at further. For
anchors with several run texts, the texts are gathered, and a suffix array with
longest-previous-factor values (the longer common prefix with the previous and
the next smaller position in suffix order) tells which strings start earlier.

Common grams (the `COMMON` most frequent anchors of a first pass, as a bit table of
fixed size) are anchors only where a string has no other gram, so a line in a third
of all documents does not gather its surroundings in one task; copies of whole
passages meet as runs of equal hashes, rows of a sorted stream. The driver holds the two bit tables, nothing else.

Defined results: a null text is empty; rows come in order of doc_id, nulls first,
and rows of one doc_id in order of their SHA-256; an empty table gives no row;
texts are read whole, as UTF-8 bytes, and what is kept need not be valid UTF-8
(the text operator drops broken characters at the cuts); other columns are
ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from . import vec
from .common import cut, released, table

LENGTH = 100
GRAM = 48
COMMON = 1 << 15
COMMON_LEAST = 8
#: The bit table of common grams has 2**COMMON_BITS bits.
COMMON_BITS = 20
#: Bytes that one call of the kernels looks at; small enough for a core's cache.
BLOCK_BYTES = 1 << 17
#: A place in a block, in the lowest bits of what is compared.
PLACE_BITS = 20
#: Runs among which a task looks for equal texts before it ships them.
CHUNK_ROWS = 300_000
#: Bytes of run texts that one suffix array is built of, if no single anchor has more.
ARRAY_BYTES = 1 << 18
#: Bits of the table of runs whose texts are needed: at least (as a power of two), for each run, at most (as a power of two).
FILTER_BITS = (20, 32, 27)


def block_slices(batch: pa.RecordBatch, length: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(bytes, offsets, row, place of the first byte in its text): runs of short texts, and long texts in overlapping blocks."""
    for part in vec.slices(batch, "text", BLOCK_BYTES):
        data, offsets = vec.buffers(part.column("text"))
        ids = part.column("id").to_numpy()
        if len(data) <= 2 * BLOCK_BYTES:
            yield data, offsets, ids, np.zeros(len(ids), np.int64)
            continue
        # slices() leaves a text of this size alone; a start belongs to the block that it lies in
        for a in range(0, len(data), BLOCK_BYTES):
            block = data[a : a + BLOCK_BYTES + length - 1]
            yield block, np.array([0, len(block)]), ids, np.array([a])


class Hashes:
    """Prefix sums of a polynomial over the mixed eight bytes from each byte (single bytes for shorter grams), for the hash of any part of data."""

    def __init__(self, data: np.ndarray, width: int = 8):
        n = max(0, len(data) - width + 1)
        self.width, self.size = width, len(data)
        self.sums = np.zeros(n + 1, dtype=np.uint64)
        values = vec.mix(vec.lanes(data)[:n]) if width == 8 else vec.byte_values(data)
        np.cumsum(values * vec.powers(max(n, 1))[:n], out=self.sums[1:])
        self.inverse = vec.powers(n + 1, vec._INVERSE)

    def grams(self, size: int) -> np.ndarray:
        """Of the `size` bytes from each byte that has so many."""
        n, words = self.size - size + 1, size - self.width + 1
        return vec.mix((self.sums[words : words + n] - self.sums[:n]) * self.inverse[:n]) if n > 0 else np.zeros(0, np.uint64)

    def spans(self, start: np.ndarray, size: np.ndarray) -> np.ndarray:
        h = (self.sums[start + size - (self.width - 1)] - self.sums[start]) * self.inverse[start]
        return vec.mix(h ^ (size.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)))


def leftmost_minimum(values: np.ndarray, width: int) -> np.ndarray:
    """For each window of `width` values, the place of the leftmost one smallest in all but its lowest PLACE_BITS bits."""
    if len(values) < width:
        return np.zeros(0, np.int64)
    low = np.uint64((1 << PLACE_BITS) - 1)
    best = (values & ~low) | np.arange(len(values), dtype=np.uint64)
    span = 1
    while 2 * span <= width:
        best = np.minimum(best[span:], best[:-span])
        span *= 2
    if span < width:
        best = np.minimum(best[width - span :], best[: span - width])
    return (best & low).astype(np.int64)


def runs(data: np.ndarray, offsets: np.ndarray, common: np.ndarray | None, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, Hashes]:
    """doc, start (byte in data), count of starts, key (anchor's hash) of each run. common: bit table."""
    sums = Hashes(data, 8 if gram >= 8 else 1)
    h = sums.grams(gram) >> np.uint64(1)
    if len(data) < length:
        return (*(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.uint64)), sums)
    if common is not None:
        at = (h >> np.uint64(63 - COMMON_BITS)).astype(np.int64)
        h |= ((common[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1)) << np.uint64(63)
    place = leftmost_minimum(h, length - gram + 1)
    n = len(place)
    size = np.diff(offsets)
    # starts whose string stays inside its document
    inside = np.zeros(n + 1, dtype=np.int32)
    long = np.flatnonzero(size >= length)
    np.add.at(inside, offsets[long], 1)
    np.add.at(inside, np.minimum(offsets[long + 1] - length + 1, n), -1)
    valid = np.cumsum(inside[:n]) > 0
    new = valid.copy()
    new[1:] &= (place[1:] != place[:-1]) | ~valid[:-1]
    # strings of two documents never follow without a gap: length - 1 starts between them are invalid
    start = np.flatnonzero(new)
    end = np.flatnonzero(valid & np.append(new[1:] | ~valid[1:], True)) + 1
    return np.searchsorted(offsets, start, side="right") - 1, start, end - start, h[place[start]], sums


# --- suffix array and longest previous factors ------------------------------


def _ranks(parts: list[np.ndarray], most: int) -> dict[int, np.ndarray]:
    """rank[w][i]: order of the w bytes from i, for powers of two w up to `most`; a place past a text's end is a letter of its own."""
    total = sum(map(len, parts)) + len(parts)
    letters = np.zeros(total, dtype=np.int64)
    at = 0
    for k, p in enumerate(parts):
        letters[at : at + len(p)] = p.astype(np.int64) + len(parts)
        letters[at + len(p)] = k  # ends: all different, before every byte
        at += len(p) + 1
    rank = {1: letters}
    width = 1
    while width < most:
        r = rank[width]
        pair = r * (int(r.max()) + 2)
        pair[:-width] += r[width:] + 1
        order = np.argsort(pair)
        step = np.ones(total, dtype=np.int64)
        step[1:] = pair[order[1:]] != pair[order[:-1]]
        step[0] = 0
        out = np.empty(total, dtype=np.int64)
        out[order] = np.cumsum(step)
        width *= 2
        rank[width] = out
        if out.max() == total - 1:
            break
    return rank


def longest_previous_factors(parts: list[np.ndarray], most: int = 128, counts: list[int] | None = None) -> list[np.ndarray]:
    """For each byte of each text (or of its first counts[k], the others left 0), the length (up to `most`) of the longest string from it that also starts at an earlier place of the texts, read in order.

    Suffix order comes from prefix doubling up to `most` bytes, equal ones by place;
    of the smaller places nearest in suffix order on either side, one has the longest
    common prefix.
    """
    if not parts:
        return []
    rank = _ranks(parts, most)
    top = max(rank)
    n = len(rank[1])
    order = np.argsort(rank[top] * n + np.arange(n))  # place of the k-th suffix; equal ones by place

    def nearest_smaller(seq: np.ndarray) -> np.ndarray:
        """Index of the nearest earlier entry that is smaller, or -1; by jumping over what is larger."""
        before = np.arange(-1, len(seq) - 1)
        live = np.flatnonzero((before >= 0) & (seq[before] > seq))
        while len(live):
            before[live] = before[before[live]]
            live = live[before[live] >= 0]
            live = live[seq[before[live]] > seq[live]]
        return before

    found = np.zeros(n, dtype=np.int64)
    wanted = np.ones(n, dtype=bool)
    if counts is not None:
        edge = np.zeros(n + 1, dtype=np.int32)
        ends = np.cumsum([len(p) + 1 for p in parts])
        begin = np.append(0, ends[:-1])
        np.add.at(edge, begin, 1)
        np.add.at(edge, begin + np.array(counts), -1)
        wanted = np.cumsum(edge[:n]) > 0
    for seq in (order, order[::-1]):
        near = nearest_smaller(seq)
        has = np.flatnonzero((near >= 0) & wanted[seq])
        a, b = seq[has], seq[near[has]]
        same = np.zeros(len(a), dtype=np.int64)
        for width in sorted(rank, reverse=True):
            i, j = a + same, b + same
            fits = (i < n) & (j < n)
            equal = fits.copy()
            equal[fits] = rank[width][i[fits]] == rank[width][j[fits]]
            same[equal] += width
        found[a] = np.maximum(found[a], same)
    out, at = [], 0
    for p in parts:
        out.append(found[at : at + len(p)])
        at += len(p) + 1
    return out


# --- the corpus ----------------------------------------------------------------


def numbered(docs: DataFrame, carry: tuple[str, ...] = ()) -> tuple[DataFrame, bool]:
    """id, doc_id, text, rest (a struct of the columns `carry`) in order of id; whether id is doc_id itself (never null, never twice)."""
    rest = F.struct(*(F.col(f"`{c}`") for c in carry)) if carry else F.lit(None).cast("boolean")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"), rest.alias("rest"))
    if docs.groupBy("doc_id").agg(F.count("*").alias("c")).filter("c > 1 or doc_id is null").isEmpty():
        return docs.select(F.col("doc_id").alias("id"), "doc_id", "text", "rest"), True
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keyed = docs.withColumn("tie", F.sha2("text", 256)).repartitionByRange(parts, F.asc_nulls_first("doc_id"), "tie").withColumn("part", F.spark_partition_id())
    keyed = cut(keyed, "ordered")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    firsts = keyed.groupBy("part").agg(F.count("*").alias("c")).select("part", F.coalesce(F.sum("c").over(before), F.lit(0)).alias("before"))
    place = F.row_number().over(Window.partitionBy("part").orderBy(F.asc_nulls_first("doc_id"), "tie"))
    return cut(keyed.withColumn("place", place).join(F.broadcast(firsts), "part").select((F.col("before") + F.col("place")).cast("long").alias("id"), "doc_id", "text", "rest"), "numbered"), False


def _bit_table(hashes: DataFrame, bits: int, column: str) -> np.ndarray:
    """Bits set at the top `bits` bits of a column of 63-bit hashes; of fixed size."""
    at = F.shiftright(column, 63 - bits)
    rows = hashes.groupBy(F.shiftright(at, 6).alias("w")).agg(F.bit_or(F.expr(f"shiftleft(1L, cast(shiftright({column}, {63 - bits}) % 64 as int))")).alias("b")).toPandas()
    out = np.zeros(max(1, (1 << bits) >> 6), dtype=np.int64)
    out[rows["w"].to_numpy(dtype=np.int64)] = rows["b"].to_numpy(dtype=np.int64)
    return out.view(np.uint64)


def _common(docs: DataFrame, length: int, gram: int) -> np.ndarray:
    """Bit table of the anchors that are most frequent under the plain order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        held: list[np.ndarray] = []

        def merge() -> None:
            nonlocal seen, counts, held
            new, c = np.unique(np.concatenate([np.zeros(0, np.uint64), *held]), return_counts=True)
            both, at = np.unique(np.concatenate([seen, new]), return_inverse=True)
            total = np.bincount(at, weights=np.concatenate([counts, c]), minlength=len(both)).astype(np.int64)
            # a count too low only means an anchor that could have been avoided
            keep = total >= (2 if len(both) > 1_000_000 else 1)
            seen, counts, held = both[keep], total[keep], []

        for batch in batches:
            for data, offsets, _, _ in block_slices(batch, length):
                held.append(runs(data, offsets, None, length, gram)[3])
                if sum(map(len, held)) > 1_000_000:
                    merge()
        merge()
        keep = counts >= COMMON_LEAST
        yield pa.RecordBatch.from_arrays([pa.array(seen[keep].view(np.int64)), pa.array(counts[keep])], ["key", "c"])

    best = docs.select("id", "text").mapInArrow(released(run), "key long, c long").groupBy("key").agg(F.sum("c").alias("c")).orderBy(F.desc("c"), "key").limit(COMMON)
    return _bit_table(best, COMMON_BITS, "key")


def _run_hashes(ids: np.ndarray, start: np.ndarray) -> np.ndarray:
    """63-bit hashes of runs' places."""
    return vec.mix(vec.mix(ids.astype(np.uint64)) ^ start.astype(np.uint64)) >> np.uint64(1)


def _run_rows(docs: DataFrame, common, length: int, gram: int) -> DataFrame:
    """key, text_hash, id, start, count, again of every run.

    Of runs of one text that a task meets within CHUNK_ROWS runs only the first
    stays with its key; the others are again, whatever comes elsewhere, and get
    keys of their own, so that copies do not gather in one task later.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []

        def flush() -> pa.RecordBatch:
            key, text, ids, start, count = (np.concatenate(x) for x in zip(*held))
            held.clear()
            order = np.lexsort((start, ids))
            _, first = np.unique((key ^ vec.mix(text))[order], return_index=True)
            again = np.ones(len(key), dtype=bool)
            again[order[first]] = False
            place = _run_hashes(ids, start)
            key, text = np.where(again, place, key), np.where(again, place, text)
            return pa.RecordBatch.from_arrays([pa.array(x) for x in (key.view(np.int64), text.view(np.int64), ids, start, count, again)], ["key", "text_hash", "id", "start", "count", "again"])

        for batch in batches:
            for data, offsets, ids, base in block_slices(batch, length):
                doc, start, count, key, sums = runs(data, offsets, common.value, length, gram)
                held.append((key, sums.spans(start, count + (length - 1)), ids[doc], start - offsets[doc] + base[doc], count))
                if sum(len(h[0]) for h in held) >= CHUNK_ROWS:
                    yield flush()
        if held:
            yield flush()

    return docs.select("id", "text").mapInArrow(released(run), "key long, text_hash long, id long, start long, count long, again boolean")


def _sorted_runs(rows: DataFrame) -> DataFrame:
    """id, start, count, again, place (a hash) of the runs whose key has others: again (an equal text came earlier in the corpus), or else the first of its text, where its key has several."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["key", "text_hash", "id", "start", "count"]
        last: tuple | None = None  # key, text_hash of the row before
        waiting: list | None = None  # the only text of the last key so far
        for batch in batches:
            known = batch.column("again").to_numpy(zero_copy_only=False)
            if known.any():
                out = batch.filter(pa.array(known))
                place = _run_hashes(out.column("id").to_numpy(), out.column("start").to_numpy()).view(np.int64)
                yield pa.RecordBatch.from_arrays([*(out.column(c) for c in ("id", "start", "count", "again")), pa.array(place)], ["id", "start", "count", "again", "place"])
                batch = batch.filter(pa.array(~known))
            key, text, ids, start, count = (batch.column(c).to_numpy() for c in names)
            n = len(key)
            if not n:
                continue
            new_key = np.ones(n, dtype=bool)
            new_key[1:] = key[1:] != key[:-1]
            new_key[0] = last is None or key[0] != last[0]
            new_text = new_key.copy()
            new_text[1:] |= text[1:] != text[:-1]
            new_text[0] |= last is None or text[0] != last[1]
            group = np.cumsum(new_key)  # 0: the key that goes on from the batch before
            firsts = np.bincount(group[new_text], minlength=int(group[-1]) + 1)
            several = firsts[group] > 1
            extra = []
            if not new_key[0]:
                on = group == 0
                if waiting is None:
                    several |= on  # it had several already
                elif firsts[0] >= 1:
                    several |= on
                    extra, waiting = [waiting], None
            lone = firsts[int(group[-1])] == 1 and int(group[-1]) > 0
            if lone:
                k = int(np.flatnonzero(new_text & (group == group[-1]))[0])
                waiting = [int(x[k]) for x in (key, text, ids, start, count)]
                several &= ~(group == group[-1])
            elif int(group[-1]) > 0:
                waiting = None
            keep = ~new_text | several
            last = (key[-1], text[-1])
            columns = [np.concatenate([np.array([e[c] for e in extra], dtype=np.int64), x[keep]]) for c, x in enumerate((key, text, ids, start, count))]
            again = np.concatenate([np.zeros(len(extra), bool), ~new_text[keep]])
            place = _run_hashes(columns[2], columns[3]).view(np.int64)
            yield pa.RecordBatch.from_arrays([*(pa.array(x) for x in columns[2:]), pa.array(again), pa.array(place)], ["id", "start", "count", "again", "place"])

    ordered = rows.repartition("key").sortWithinPartitions("key", "text_hash", "id", "start")
    return ordered.mapInArrow(released(run), "id long, start long, count long, again boolean, place long")


def _run_texts(docs: DataFrame, common, wanted, bits: int, length: int, gram: int) -> DataFrame:
    """key, id, start, count, bytes of the runs that may be wanted."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table_ = wanted.value
        for batch in batches:
            for data, offsets, ids, base in block_slices(batch, length):
                doc, start, count, key, _ = runs(data, offsets, common.value, length, gram)
                at = (_run_hashes(ids[doc], start - offsets[doc] + base[doc]) >> np.uint64(63 - bits)).astype(np.int64)
                keep = np.flatnonzero((table_[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1))
                texts = [data[a : a + c + length - 1].tobytes() for a, c in zip(start[keep].tolist(), count[keep].tolist())]
                doc = doc[keep]
                yield pa.RecordBatch.from_arrays([pa.array(key[keep].view(np.int64)), pa.array(ids[doc]), pa.array(start[keep] - offsets[doc] + base[doc]), pa.array(count[keep]), pa.array(texts, pa.binary())], ["key", "id", "start", "count", "bytes"])

    return docs.select("id", "text").mapInArrow(released(run), "key long, id long, start long, count long, bytes binary")


def _earlier(texts: DataFrame, length: int) -> DataFrame:
    """id, start, count of strings that start earlier, from runs' texts: a suffix array for every few anchors."""

    def flush(rows: list[tuple]) -> pa.RecordBatch:
        rows.sort(key=lambda r: (r[1], r[2]))  # an earlier place of the corpus is an earlier place of the array
        factors = longest_previous_factors([np.frombuffer(r[4], dtype=np.uint8) for r in rows], 128 if length <= 128 else 1 << (length - 1).bit_length(), [r[3] for r in rows])
        out: list[tuple[int, int, int]] = []
        for (_, i, start, count, _), f in zip(rows, factors):
            hit = np.flatnonzero(f[:count] >= length)
            if len(hit):
                edge = np.flatnonzero(np.diff(hit) > 1)
                first, last = np.append(hit[0], hit[edge + 1]), np.append(hit[edge], hit[-1])
                out += [(i, start + a, b - a + 1) for a, b in zip(first.tolist(), last.tolist())]
        columns = list(zip(*out)) if out else [[]] * 3
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["id", "start", "count"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        group: list[tuple] = []  # of the last anchor
        held = 0
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("key", "id", "start", "count", "bytes"))):
                if group and group[-1][0] != row[0]:
                    if len(group) > 1:  # an anchor with one run has nothing earlier
                        rows += group
                        held += sum(len(r[4]) for r in group)
                    group = []
                    if held >= ARRAY_BYTES:
                        yield flush(rows)
                        rows, held = [], 0
                group.append(row)
        if len(group) > 1:
            rows += group
        if rows:
            yield flush(rows)

    return texts.repartition("key").sortWithinPartitions("key", "id", "start").mapInArrow(released(run), "id long, start long, count long")


def repeated(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """id, start, count: places from which `length` bytes also start earlier. docs: id (order of the corpus), text."""
    spark = docs.sparkSession
    common = spark.sparkContext.broadcast(_common(docs, length, gram))
    known = cut(_sorted_runs(_run_rows(docs, common, length, gram)), "runs")
    firsts = known.filter("not again")
    n = firsts.count()
    whole = known.filter("again").select("id", "start", "count")
    if not n:
        return whole
    bits = min(FILTER_BITS[2], max(FILTER_BITS[0], (FILTER_BITS[1] * n).bit_length()))
    wanted = spark.sparkContext.broadcast(_bit_table(firsts.select("place"), bits, "place"))
    texts = _run_texts(docs, common, wanted, bits, length, gram)
    return whole.union(_earlier(texts, length))


def covered(size: int, starts: np.ndarray, counts: np.ndarray, length: int) -> np.ndarray:
    """Which bytes the strings from these places cover."""
    edge = np.zeros(size + 1, dtype=np.int32)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + counts + length - 1, -1)
    return np.cumsum(edge[:size]) > 0


def _kept(docs: DataFrame, length: int, gram: int, columns: str, finish, carry: tuple[str, ...] = ()) -> DataFrame:
    """finish(doc_id, bytes, what to remove) for every row, as `columns`, and rest."""
    rows, _ = numbered(docs, carry)
    places = repeated(rows, length, gram).groupBy("id").agg(F.collect_list(F.struct("start", "count")).alias("places")).select("id", "places.start", "places.count")
    names = [c.split()[0] for c in columns.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for doc_id, text, start, count in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "start", "count"))):
                data = np.frombuffer(text.encode(), dtype=np.uint8)
                gone = covered(len(data), np.array(start, dtype=np.int64), np.array(count, dtype=np.int64), length) if start else np.zeros(len(data), bool)
                out.append(finish(doc_id, data, gone))
            types = [{"long": pa.int64(), "string": pa.string()}[c.split()[1]] for c in columns.split(", ")]
            yield pa.RecordBatch.from_arrays([*(pa.array(c, t) for c, t in zip(zip(*out) if out else [[]] * len(names), types)), batch.column("rest")], [*names, "rest"])

    joined = rows.join(places.hint("shuffle_hash"), "id", "left")
    return joined.select("doc_id", "text", "start", "count", "rest").mapInArrow(released(run), f"{columns}, rest {rows.schema['rest'].dataType.simpleString()}")


def dedup(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every row."""

    def finish(doc_id, data: np.ndarray, gone: np.ndarray) -> tuple:
        spans_ = int(np.count_nonzero(gone[1:] & ~gone[:-1])) + int(len(gone) > 0 and gone[0])
        return doc_id, len(data), int(gone.sum()), spans_, hashlib.sha256(data[~gone].tobytes()).hexdigest()

    return _kept(docs, length, gram, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string", finish).drop("rest")


def kept_texts(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """docs with each text cut down to what no earlier place has; a character that a cut broke is dropped. n_chars, where there is one, follows."""

    def finish(doc_id, data: np.ndarray, gone: np.ndarray) -> tuple:
        return doc_id, data[~gone].tobytes().decode("utf-8", "ignore")

    others = tuple(c for c in docs.columns if c not in ("doc_id", "text"))
    found = _kept(docs, length, gram, "doc_id long, text string", finish, others)
    own = {c: F.length("text").cast(docs.schema[c].dataType) if c == "n_chars" else F.col("rest")[c] for c in others}
    return found.select(*(own[c].alias(c) if c in own else F.col(c).cast(docs.schema[c].dataType).alias(c) for c in docs.columns))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup(table(spark, sf_dir, "documents"))
