"""N-gram Jaccard join by vertical partitioning.

A document is its set of 5-word shingles (64-bit hashes). All shingles have one
global order: the `HEAVY` commonest come last, commonest at the very end, all
others by hash. Two sets of Jaccard similarity t share one of their first
n - ceil(t n) + 1 shingles, so those prefixes, shuffled by shingle, bring
candidates together. Pairs whose parity bit tables (four to eight bits for each
shingle) differ in more bits than similar sets differ in shingles go. What is left is
counted by vertical partitioning: the
order is cut into FRAGMENTS ranges, each document's set into segments, the
overlap of a pair is counted in each fragment on its own, and partial counts are
summed per pair, a few fragments (STEPS) at a time: pairs that the shingles not
yet looked at cannot make similar go before the next.

Copies and hot groups: equal sets are one node, kept by its smallest doc_id.
Within a shingle's rows (by set size) each node is paired with a centre, the
smallest set whose size still allows the similarity, and (for a quarter of the
shingles) with the node before it, which is linear in the rows. First each node meets the one centre that most
of its shingles name, then, across the components so far, the others. While a shingle's
components still make many pairs, each node meets a few neighbours of another
component in further orders. The last round pairs all nodes of one shingle that lie
in different components and that size, position and parity filters allow. Links
inside a component cannot change it, so no link between different texts is lost
for the components, and a group of near copies is not expanded into its pairs.

Defined results: null and empty texts and texts without a word have no shingles
and are their own component; texts of fewer than five words are one shingle of
all words; equal texts are linked; null or repeated doc_ids are told apart by a
row number, and a component's id is its smallest non-null doc_id (null if it has
none); an empty table gives no row; other columns are ignored, whatever their
names; texts and words of any length are read whole. Shingles equal by a
64-bit hash count as equal. The driver collects the commonest shingles and a bit
table for candidates, both of bounded size; nothing else. Tables that grow with the
corpus are joined by sorting, never broadcast, at every size.
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
from .components import components

WORDS = 5
#: Similarity as a fraction: TOP / BOTTOM.
TOP, BOTTOM = 75, 100
FRAGMENTS = 8
HEAVY = 1 << 18
#: A shingle that no partition has so often cannot be heavy; this only orders shingles, it drops none.
HEAVY_LEAST = 3
#: The fragments of the order (FRAGMENTS is the heavy range) that are counted before pairs are looked at again.
STEPS = (tuple(range(FRAGMENTS // 2)), tuple(range(FRAGMENTS // 2, FRAGMENTS + 1)))
#: Bits of the table of candidates: at least (as a power of two), for each candidate, at most (as a power of two; beyond it, a join by id).
FILTER_BITS = (20, 32, 27)
#: Bits of a parity table for each shingle: with four, few pairs below 0.73 of 0.75 pass.
PARITY = 4
#: Rounds of neighbours before all pairs across components are looked at, while those are more than so many a row and
#: the round before found links in this share of its pairs.
ROUNDS, PAIRS_PER_ROW, NEIGHBOURS, WORTH = 4, 8, 2, 0.02


def shingle_sets(part: pa.RecordBatch, words: int = WORDS, column: str = "text") -> Iterator[np.ndarray]:
    """Per row its sorted distinct shingle hashes."""
    data, offsets = vec.buffers(part.column(column))
    data = vec.ascii_lower(data)
    start, end, doc = vec.word_spans(data, offsets)
    hashes = vec.span_hashes(data, start, end)
    at = np.searchsorted(doc, np.arange(len(offsets)))
    n = len(hashes)
    windows = np.full(max(0, n - words + 1), np.uint64(words), dtype=np.uint64)
    for j in range(words if len(windows) else 0):
        windows = vec.mix(windows ^ hashes[j : j + len(windows)]) + np.uint64(0x9E3779B97F4A7C15)
    for a, b in zip(at[:-1].tolist(), at[1:].tolist()):
        if b - a >= words:
            yield np.unique(windows[a : b - words + 1])
        else:
            yield vec.shingle_hashes(hashes[a:b], words)


def prefix_length(n: int, top: int = TOP, bottom: int = BOTTOM) -> int:
    """How many first shingles must hold one that a similar set shares."""
    return n - -(-top * n // bottom) + 1 if n else 0


def _in_order(found: np.ndarray, heavy: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """A set in the global order."""
    if not len(heavy):
        return found
    at = np.minimum(np.searchsorted(heavy, found), len(heavy) - 1)
    common = heavy[at] == found
    return np.concatenate([found[~common], found[common][np.argsort(rank[at[common]], kind="stable")]])


def fragment_of(found: np.ndarray, heavy: np.ndarray) -> np.ndarray:
    """The range of the global order that each shingle lies in; the heavy ones are the last range."""
    out = (found >> np.uint64(61)).astype(np.int64)  # FRAGMENTS ranges of the hash
    if len(heavy):
        at = np.minimum(np.searchsorted(heavy, found), len(heavy) - 1)
        out[heavy[at] == found] = FRAGMENTS
    return out


def parity_bits(found: np.ndarray) -> np.ndarray:
    """Bit i tells whether an odd number of shingles fall on i; 2**k bits, PARITY times as many as shingles or more, as 64-bit words.

    Two such tables differ in no more bits than their sets differ in shingles. The
    exclusive or of its halves is a table's half-size form.
    """
    k = max(6, int(PARITY * max(1, len(found)) - 1).bit_length())
    odd = np.bincount((found & np.uint64((1 << k) - 1)).astype(np.int64), minlength=1 << k) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.int64)


def _signatures(docs: DataFrame, words: int) -> DataFrame:
    """id, n, sig, bits of every document, and token, c: shingles that are common in one partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        once: list[np.ndarray] = []
        held = 0

        def merge() -> None:
            nonlocal seen, counts, once, held
            new, c = np.unique(np.concatenate(once), return_counts=True) if once else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
            both, at = np.unique(np.concatenate([seen, new]), return_inverse=True)
            total = np.bincount(at, weights=np.concatenate([counts, c]), minlength=len(both)).astype(np.int64)
            # rare ones may be forgotten: a count too low only places a shingle earlier in the order
            keep = total >= (2 if len(both) > 2_000_000 else 1)
            seen, counts, once, held = both[keep], total[keep], [], 0

        for batch in batches:
            for part in vec.slices(batch):
                n, sig, bits = [], [], []
                for found in shingle_sets(part, words):
                    n.append(len(found))
                    sig.append(hashlib.blake2b(found.tobytes(), digest_size=16).digest())
                    bits.append(parity_bits(found))
                    once.append(found)
                    held += len(found)
                if held > 2_000_000:
                    merge()
                ends = np.cumsum([0, *map(len, bits)])
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(bits)))
                yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(n, pa.int64()), pa.array(sig, pa.binary()), lists, pa.nulls(len(n), pa.int64()), pa.nulls(len(n), pa.int64())], names)
        merge()
        keep = counts >= HEAVY_LEAST
        tokens, c = seen[keep].view(np.int64), counts[keep]
        for a in range(0, len(tokens), 50_000):
            t = tokens[a : a + 50_000]
            yield pa.RecordBatch.from_arrays([pa.nulls(len(t), pa.int64()), pa.nulls(len(t), pa.int64()), pa.nulls(len(t), pa.binary()), pa.nulls(len(t), pa.list_(pa.int64())), pa.array(t), pa.array(c[a : a + 50_000], pa.int64())], names)

    names = ["id", "n", "sig", "bits", "token", "c"]
    return docs.select("id", "text").mapInArrow(released(run), "id long, n long, sig binary, bits array<long>, token long, c long")


def _prefixes(docs: DataFrame, heavy, words: int, top: int, bottom: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, rank = heavy.value
        for batch in batches:
            for part in vec.slices(batch):
                n, first = [], []
                for found in shingle_sets(part, words):
                    n.append(len(found))
                    first.append(_in_order(found, tokens, rank)[: prefix_length(len(found), top, bottom)].view(np.int64))
                ends = np.cumsum([0, *map(len, first)])
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(first) if first else np.zeros(0, np.int64)))
                yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(n, pa.int64()), lists], ["id", "n", "prefix"])

    return docs.select("id", "text").mapInArrow(released(run), "id long, n long, prefix array<long>")


def _groups(rows: DataFrame, top: int, bottom: int) -> DataFrame:
    """Of (token, node, n, place), those whose token another node has, with a centre of their size (centre, cn) and the node before (prev, pn)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last_token, first, shared, centre, before = None, None, False, None, None  # of the run that goes on

        for batch in batches:
            token = batch.column("token").to_numpy()
            node, n, place = (batch.column(c).to_numpy() for c in ("node", "n", "place"))
            size = len(token)
            if not size:
                continue
            new = np.ones(size, dtype=bool)
            new[1:] = token[1:] != token[:-1]
            new[0] = last_token is None or token[0] != last_token
            again = ~new
            wanted = again.copy()  # rows of runs of two or more
            wanted[:-1] |= again[1:]
            out: list[tuple] = []
            for k in np.flatnonzero(wanted).tolist():
                row = (int(token[k]), int(node[k]), int(n[k]), int(place[k]))
                if new[k]:
                    first, shared, centre, before = row, False, row, row
                    continue
                if not shared:
                    if first is None or first[0] != row[0]:
                        raise AssertionError("a run lost its first row")
                    out.append((*first, *first[1:3], *first[1:3]))
                    shared = True
                if centre[2] * bottom < row[2] * top:
                    centre = row
                out.append((*row, *centre[1:3], *before[1:3]))
                before = row
            k = size - 1
            last_token = int(token[k])
            if new[k]:
                first = (int(token[k]), int(node[k]), int(n[k]), int(place[k]))
                shared, centre, before = False, first, first
            columns = list(zip(*out)) if out else [[]] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names)

    names = ["token", "node", "n", "place", "centre", "cn", "prev", "pn"]
    return rows.repartition("token").sortWithinPartitions("token", "n", "node").mapInArrow(released(run), ", ".join(f"{c} long" for c in names))


def _bits(ids: DataFrame, size: int):
    """A bit table of fixed size over hashes of the ids, for leaving out documents that no pair asks for."""
    h = F.pmod(F.xxhash64("node"), F.lit(size))
    rows = ids.select(h.alias("h")).groupBy(F.shiftright("h", 6).alias("w")).agg(F.bit_or(F.expr("shiftleft(1L, cast(h % 64 as int))")).alias("b")).toPandas()
    out = np.zeros(size >> 6, dtype=np.int64)
    out[rows["w"].to_numpy(dtype=np.int64)] = rows["b"].to_numpy(dtype=np.int64)
    return out


def _segments(docs: DataFrame, ids: DataFrame, heavy, words: int) -> DataFrame:
    """node, fragment, tokens of the documents `ids` (node, distinct), by a bit table perhaps of a few more."""
    size = 1 << max(FILTER_BITS[0], (FILTER_BITS[1] * ids.count()).bit_length())
    if size > 1 << FILTER_BITS[2]:
        docs = docs.join(ids.select(F.col("node").alias("id")).hint("merge"), "id", "left_semi")
        size, filled = 64, np.array([-1], dtype=np.int64)
    else:
        filled = _bits(ids, size)
    bits = docs.sparkSession.sparkContext.broadcast(filled)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table_, (common, _) = bits.value, heavy.value
        for batch in batches:
            h = batch.column("h").to_numpy()
            batch = batch.filter(pa.array((table_[h >> 6] >> (h & 63)) & 1 == 1))
            for part in vec.slices(batch):
                node, fragment, tokens = [], [], []
                for i, found in zip(part.column("id").to_pylist(), shingle_sets(part, words)):
                    place = fragment_of(found, common)
                    for f in np.unique(place).tolist():
                        node.append(i)
                        fragment.append(f)
                        tokens.append(found[place == f].view(np.int64))
                ends = np.cumsum([0, *map(len, tokens)])
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(tokens) if tokens else np.zeros(0, np.int64)))
                yield pa.RecordBatch.from_arrays([pa.array(node, pa.int64()), pa.array(fragment, pa.int32()), lists], ["node", "fragment", "tokens"])

    return docs.select("id", "text", F.pmod(F.xxhash64("id"), F.lit(size)).alias("h")).mapInArrow(released(run), "node long, fragment int, tokens array<long>")


def _alike(pairs: DataFrame, bits: DataFrame, top: int, bottom: int) -> DataFrame:
    """The pairs (a, b, an, bn) whose parity tables do not rule them out. bits: node, bits."""
    half = lambda x: F.zip_with(F.slice(x, 1, (F.size(x) / 2).cast("int")), F.slice(x, (F.size(x) / 2).cast("int") + 1, (F.size(x) / 2).cast("int")), lambda p, q: p.bitwiseXOR(q))
    rows = pairs.join(bits.select(F.col("node").alias("a"), F.col("bits").alias("x")).hint("merge"), "a").join(bits.select(F.col("node").alias("b"), F.col("bits").alias("y")).hint("merge"), "b")
    # similar sets' tables are of one size, or one of twice the other's
    rows = rows.withColumns({"x": F.when(F.size("x") > F.size("y"), half(F.col("x"))).otherwise(F.col("x")), "y": F.when(F.size("y") > F.size("x"), half(F.col("y"))).otherwise(F.col("y"))})
    differ = F.aggregate(F.zip_with("x", "y", lambda p, q: F.bit_count(p.bitwiseXOR(q)).cast("long")), F.lit(0).cast("long"), lambda s, d: s + d)
    return rows.filter(differ * (bottom + top) <= (F.col("an") + F.col("bn")) * (bottom - top)).select("a", "b", "an", "bn")


def _links(pairs: DataFrame, segments: DataFrame, top: int, bottom: int) -> DataFrame:
    """u, v of the pairs (a, b, an, bn) that are similar: overlaps by fragment, summed per pair, step by step."""
    keys = ["a", "b", "an", "bn"]
    # common: shared so far; ra, rb: shingles not looked at, or more
    left = pairs.select(*keys, F.lit(0).cast("long").alias("common"), F.col("an").alias("ra"), F.col("bn").alias("rb"))
    for number, step in enumerate(STEPS):
        # both sides of a pair meet the segments by (node, fragment), so these are dealt out once
        each = left.select(*keys, F.explode(F.array(*map(F.lit, step))).alias("f"))
        part = segments.filter(F.col("fragment").isin(*step))
        one = each.join(part.alias("l").hint("merge"), (F.col("a") == F.col("l.node")) & (F.col("f") == F.col("l.fragment"))).select(*keys, "f", F.col("l.tokens").alias("x"))
        both = one.join(part.alias("r").hint("merge"), (F.col("b") == F.col("r.node")) & (F.col("f") == F.col("r.fragment")))
        partial = both.select(*keys, F.size(F.array_intersect("x", F.col("r.tokens"))).cast("long").alias("common"), (-F.size("x")).cast("long").alias("ra"), (-F.size("r.tokens")).cast("long").alias("rb"))
        left = left.union(partial).groupBy(*keys).agg(*(F.sum(c).alias(c) for c in ("common", "ra", "rb")))
        rest = F.lit(0) if number == len(STEPS) - 1 else F.least("ra", "rb")
        left = left.filter((bottom + top) * (F.col("common") + rest) >= top * (F.col("an") + F.col("bn")))
        if number < len(STEPS) - 1:
            left = cut(left, "counted")
    return left.select(F.col("a").alias("u"), F.col("b").alias("v"))


def _numbered(docs: DataFrame) -> tuple[DataFrame, bool]:
    """docs (doc_id, text) with a unique id: doc_id itself, or where it is null or repeats, a number written next to the text."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    odd = docs.groupBy("doc_id").agg(F.count("*").alias("c")).filter("c > 1 or doc_id is null")
    if odd.isEmpty():
        return docs.select(F.col("doc_id").alias("id"), "doc_id", "text"), True
    return cut(docs.select(F.monotonically_increasing_id().alias("id"), "doc_id", "text"), "numbered"), False


def join(docs: DataFrame, words: int = WORDS, top: int = TOP, bottom: int = BOTTOM, heavy_size: int = HEAVY) -> DataFrame:
    """doc_id, n_shingles, component_id, copies (rows with the same set) of every row; row_id where doc_ids do not tell rows apart."""
    spark = docs.sparkSession
    docs, unique = _numbered(docs)
    stats = cut(_signatures(docs, words), "signatures")
    common = stats.filter("token is not null").groupBy("token").agg(F.sum("c").alias("c")).orderBy(F.desc("c"), "token").limit(heavy_size).select("token").toPandas()
    tokens = common["token"].to_numpy(dtype=np.int64).view(np.uint64)
    order = np.argsort(tokens)
    # rank: the commonest is last
    heavy = spark.sparkContext.broadcast((tokens[order], (len(tokens) - order).astype(np.int64)))
    base = stats.filter("token is null").select("id", "n", "sig", "bits")
    classes = cut(base.groupBy("sig", "n").agg(F.min("id").alias("node"), F.count("*").alias("copies")), "classes")
    firsts = classes.filter("n > 0").select(F.col("node").alias("id"))
    prefixes = _prefixes(docs, heavy, words, top, bottom).join(firsts.hint("merge"), "id", "left_semi")
    rows = prefixes.select(F.col("id").alias("node"), "n", F.posexplode("prefix").alias("place", "token")).select("token", "node", "n", F.col("place").cast("long"))
    groups = cut(_groups(rows, top, bottom), "groups")

    def reach(n: str, i: str, m: str, j: str) -> F.Column:
        small_enough = (F.col(n) * bottom >= F.col(m) * top) & (F.col(m) * bottom >= F.col(n) * top)
        return small_enough & (F.least(F.col(n) - F.col(i), F.col(m) - F.col(j)) * (bottom + top) >= top * (F.col(n) + F.col(m)))

    def couples(rows: DataFrame, a: str, an: str) -> DataFrame:
        """Pairs of (node, n) and another whose sizes allow it; place says nothing here, as a pair need not meet at its first common shingle."""
        near = rows.filter(F.col(a) != F.col("node")).filter((F.col(an) * bottom >= F.col("n") * top) & (F.col("n") * bottom >= F.col(an) * top))
        one = F.col(a) < F.col("node")
        return near.select(F.least(a, "node").alias("a"), F.greatest(a, "node").alias("b"), F.when(one, F.col(an)).otherwise(F.col("n")).alias("an"), F.when(one, F.col("n")).otherwise(F.col(an)).alias("bn"))

    bits_of = base.join(firsts.hint("merge"), "id", "left_semi").select(F.col("id").alias("node"), "bits")

    def verified(pairs: DataFrame) -> DataFrame:
        pairs = cut(_alike(pairs, bits_of, top, bottom), "pairs")
        ids = cut(pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct(), "candidates")
        return _links(pairs, cut(_segments(docs, ids, heavy, words), "segments"), top, bottom)

    def across(pairs: DataFrame, component: DataFrame) -> DataFrame:
        """Pairs whose nodes are not in one component."""
        for c in "ab":
            pairs = pairs.join(component.select(F.col("node").alias(c), F.col("component").alias(f"{c}_in")).hint("merge"), c, "left")
        apart = F.coalesce("a_in", "a") != F.coalesce("b_in", "b")
        return pairs.filter(apart).select("a", "b", "an", "bn")

    # how many shingles name each centre of a node; first the pair of each node with its likeliest
    named = cut(groups.filter("centre <> node").groupBy("node", "n", "centre", "cn").agg(F.count("*").alias("c")), "centres")
    likeliest = named.groupBy("node", "n").agg(F.max(F.struct("c", (-F.col("centre")).alias("least"), "centre", "cn")).alias("o")).select("node", "n", "o.centre", "o.cn")
    tested = cut(couples(likeliest, "centre", "cn").distinct(), "stars")
    links = cut(verified(tested), "links")
    first = cut(components(links), "components")
    others = couples(named, "centre", "cn").union(couples(groups.filter("token % 4 = 0"), "prev", "pn")).distinct()
    others = cut(across(others.join(tested.hint("merge"), ["a", "b"], "left_anti"), first), "stars")
    more = cut(verified(others), "links")
    if not more.isEmpty():
        first = cut(components(cut(more.union(first.select("node", "component")), "links")), "components")
    tested = tested.union(others.select(*tested.columns))
    links = links.union(more)
    worth = links.count() >= WORTH * tested.count()
    for number in range(ROUNDS + 1):
        # shingles whose nodes lie in more than one component, and the pairs across that they have
        in_component = groups.select("token", "node").join(first.hint("merge"), "node", "left").select("token", F.coalesce("component", "node").alias("component"))
        open_ = in_component.groupBy("token").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).filter("lo < hi").select("token")
        placed = groups.select("token", "node", "n", "place").join(open_.hint("merge"), "token", "left_semi").join(first.hint("merge"), "node", "left")
        placed = cut(placed.withColumn("component", F.coalesce("component", "node")), "placed")
        sizes = placed.groupBy("token", "component").agg(F.count("*").alias("c")).groupBy("token").agg(F.sum("c").alias("c"), F.sum(F.col("c") * F.col("c")).alias("q"), F.count("*").alias("k"))
        load = sizes.agg(F.sum((F.col("c") * F.col("c") - F.col("q")) / 2).alias("pairs"), F.sum("c").alias("rows")).first()
        if not load["rows"]:
            break
        last = number == ROUNDS or not worth or load["pairs"] <= PAIRS_PER_ROW * load["rows"]
        if last:
            x = placed.select("token", *(F.col(c).alias(f"x_{c}") for c in ("node", "n", "place", "component")))
            y = placed.select("token", *(F.col(c).alias(f"y_{c}") for c in ("node", "n", "place", "component")))
            rest = x.join(y.hint("merge"), "token").filter("x_component <> y_component and x_node < y_node").filter(reach("x_n", "x_place", "y_n", "y_place"))
            rest = rest.select(F.col("x_node").alias("a"), F.col("y_node").alias("b"), F.col("x_n").alias("an"), F.col("y_n").alias("bn"))
        else:
            # a few neighbours of each node in an order of this round's own
            w = Window.partitionBy("token").orderBy(F.xxhash64("node", F.lit(number)), "node")
            others = {f"o{k}": F.lag(F.struct(F.col("node").alias("other"), F.col("n").alias("on"), F.col("component").alias("oc")), k).over(w) for k in range(1, NEIGHBOURS + 1)}
            near = placed.withColumns(others).select("node", "n", "component", F.explode(F.array_compact(F.array(*others))).alias("o"))
            rest = couples(near.select("node", "n", "component", "o.*").filter("oc <> component"), "other", "on")
        rest = cut(rest.distinct().join(tested.hint("merge"), ["a", "b"], "left_anti"), "rest")
        more = cut(verified(rest), "links")
        worth = more.count() >= WORTH * rest.count()
        tested = tested.union(rest.select(*tested.columns))
        if not more.isEmpty():
            first = cut(components(cut(more.union(first.select("node", "component")), "links")), "components")
        if last:
            break
    members = base.drop("bits").join(classes.select("sig", "node", "copies", F.col("n").alias("cn")).hint("merge"), "sig").join(first.hint("merge"), "node", "left").select("id", "n", "copies", F.when(F.col("n") > 0, F.coalesce("component", "node")).otherwise(F.col("id")).alias("component"))
    if unique:
        return members.select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), F.col("component").alias("component_id"), "copies")
    named = members.join(docs.select("id", "doc_id").hint("merge"), "id")
    names = named.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    return named.join(names.hint("merge"), "component").select("doc_id", F.col("n").alias("n_shingles"), "component_id", "copies", F.col("id").alias("row_id"), F.col("component").alias("component_row"))


def representatives(docs: DataFrame) -> DataFrame:
    """The rows of docs, all columns, of one document for each component: that of the smallest doc_id."""
    if _numbered(docs)[1]:
        kept = join(docs).filter("doc_id = component_id").select(F.col("doc_id").alias("kept_id"))
        return docs.join(kept.hint("merge"), F.col("doc_id").cast("long") == F.col("kept_id"), "left_semi")
    known = cut(docs.select("*", F.monotonically_increasing_id().alias("row number")), "numbered")
    kept = join(known.select(F.col("row number").alias("doc_id"), "text")).filter("doc_id = component_id").select(F.col("doc_id").alias("kept_id"))
    return known.join(kept.hint("merge"), F.col("row number") == F.col("kept_id"), "left_semi").drop("row number")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return join(table(spark, sf_dir, "documents"))
