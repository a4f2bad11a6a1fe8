"""Quality classifier: random Fourier features, ridge regression, isotonic calibration.

Each document becomes a vector of statistics (lengths, character shares,
repetition). Random Fourier features approximate a Gaussian kernel over the
standardised vectors; each partition of the labelled sample sums its part of
the normal equations, the ridge solution scores documents, and isotonic
regression on labelled documents left out of the fit turns scores into
probabilities.

Defined results: a null or empty text has the vector of an empty document;
repeated rows are scored alike, up to the rounding of sums; ties take the same step;
without labelled rows of both kinds every score is the share of good labels (0.5
without any); an empty table gives no row; columns beside doc_id and text are
ignored, whatever their names. 0.96 of a score is the calibrated step, the rest a
sigmoid of the raw score, which keeps the order inside a step. Texts are read whole. labels,
lang, source and doc_id are no inputs of a score. No shuffle of texts: the
labelled sample (at most `rows`) is broadcast by id, everything else is a map.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import vec
from .common import cut, released, table
from .training import SAMPLE_ROWS, held_out, sample

FEATURES = 384
RIDGE = 3.0
#: Of the kernel, in units of the median distance's scale: exp(-GAMMA * squared distance / dimensions).
GAMMA = 0.5
SEED = 20240611
CALIBRATION_PARTS = 4
THRESHOLD = 0.7
#: The statistics of a document, in order.
STATISTICS = ("log_bytes", "log_words", "word_bytes", "word_spread", "upper", "digit", "symbol", "mark", "wide", "bare_words", "marked_words", "shout", "again_next", "again_second", "distinct", "top_word", "pairs_again", "fives_again", "log_lines", "line_words", "lines_again")


def _sums(values: np.ndarray, doc: np.ndarray, docs: int) -> np.ndarray:
    return np.bincount(doc, weights=values, minlength=docs)


def _again(hashes: np.ndarray, doc: np.ndarray, docs: int) -> tuple[np.ndarray, np.ndarray]:
    """Per document: how many of its hashes came before, and how often its commonest one comes."""
    if not len(hashes):
        return np.zeros(docs), np.zeros(docs)
    mixed = vec.mix(hashes ^ vec.mix(doc.astype(np.uint64) + np.uint64(1)))
    _, first, counts = np.unique(mixed, return_index=True, return_counts=True)
    n = np.bincount(doc, minlength=docs)
    top = np.zeros(docs)
    np.maximum.at(top, doc[first], counts)
    return n - np.bincount(doc[first], minlength=docs), top


def statistics(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """[document, STATISTICS]."""
    docs = len(offsets) - 1
    size = np.diff(offsets)
    doc_of = np.repeat(np.arange(docs), size)
    kind = np.zeros(256, dtype=np.int64)
    for k, chars in enumerate(("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", "#*$%&|<>", ".,;:!?'\"()-")):
        kind[[ord(c) for c in chars]] = k + 1
    kind[128:] = 5
    shares = np.bincount(doc_of * 6 + kind[data], minlength=6 * docs).reshape(docs, 6)[:, 1:] / np.maximum(size, 1)[:, None]
    start, end, doc = vec.word_spans(data, offsets)
    n = np.bincount(doc, minlength=docs)
    some = np.maximum(n, 1)
    length = end - start
    mean = _sums(length, doc, docs) / some
    spread = np.sqrt(np.maximum(_sums(length**2, doc, docs) / some - mean**2, 0))
    letters = np.append(0, np.cumsum((kind[data] == 0) | (kind[data] == 1) | (kind[data] == 5)))
    capitals = np.append(0, np.cumsum(kind[data] == 1))
    symbols = np.append(0, np.cumsum(kind[data] == 3))
    lettered = letters[end] - letters[start]
    bare = _sums(lettered == 0, doc, docs) / some
    marked = _sums((symbols[end] > symbols[start]) & (lettered > 0), doc, docs) / some
    shout = _sums((capitals[end] - capitals[start] == lettered) & (lettered > 1), doc, docs) / some
    hashes = vec.span_hashes(vec.ascii_lower(data), start, end)
    same = lambda k: _sums((hashes[k:] == hashes[:-k]) & (doc[k:] == doc[:-k]), doc[k:], docs) / some if len(hashes) > k else np.zeros(docs)
    again, top = _again(hashes, doc, docs)

    def windows(k: int) -> np.ndarray:
        if len(hashes) < k:
            return np.zeros(docs)
        h = np.zeros(len(hashes) - k + 1, dtype=np.uint64)
        for j in range(k):
            h = vec.mix(h ^ hashes[j : len(hashes) - k + 1 + j])
        keep = doc[k - 1 :] == doc[: len(doc) - k + 1]
        return _again(h[keep], doc[: len(doc) - k + 1][keep], docs)[0] / some

    # lines with a byte, by their hash
    newline = data == 10
    inside = ~newline
    begin = inside.copy()
    begin[1:] &= newline[:-1] | (doc_of[1:] != doc_of[:-1])
    stop = inside.copy()
    stop[:-1] &= newline[1:] | (doc_of[1:] != doc_of[:-1])
    a, b = np.flatnonzero(begin), np.flatnonzero(stop) + 1
    line_doc = doc_of[a] if len(a) else np.zeros(0, np.int64)
    lines = np.bincount(line_doc, minlength=docs)
    lines_again = _again(vec.span_hashes(data, a, b), line_doc, docs)[0] / np.maximum(lines, 1)
    return np.stack([
        np.log1p(size), np.log1p(n), np.log1p(mean), np.log1p(spread), *shares.T, bare, marked, shout, same(1), same(2),
        (n - again) / some, top / some, windows(2), windows(5), np.log1p(lines), np.log1p(n / np.maximum(lines, 1)), lines_again,
    ], axis=1).astype(np.float64)


def isotonic(scores: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Steps (score from which, mean label) of the best non-decreasing fit: pool adjacent violators."""
    order = np.argsort(scores, kind="stable")
    blocks: list[list[float]] = []  # first score, sum, count
    for s, v in zip(scores[order].tolist(), y[order].tolist()):
        blocks.append([s, v, 1.0])
        while len(blocks) > 1 and (blocks[-2][1] * blocks[-1][2] >= blocks[-1][1] * blocks[-2][2] or blocks[-2][0] == blocks[-1][0]):
            _, total, count = blocks.pop()
            blocks[-1][1] += total
            blocks[-1][2] += count
    return np.array([b[0] for b in blocks]), np.array([b[1] / b[2] for b in blocks])


class Model:
    """Standardisation, Fourier frequencies, ridge weights and calibration steps."""

    def __init__(self, mean: np.ndarray, scale: np.ndarray, constant: float | None = None):
        rng = np.random.default_rng(SEED)
        d = len(mean)
        self.mean, self.scale, self.constant = mean, scale, constant
        self.w = rng.normal(size=(d, FEATURES)) * np.sqrt(2 * GAMMA / d)
        self.phase = rng.uniform(0, 2 * np.pi, FEATURES)
        self.beta = np.zeros(FEATURES + d + 1)
        self.steps, self.values = np.zeros(1), np.zeros(1)

    def lift(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -6, 6)
        return np.hstack([np.sqrt(2 / FEATURES) * np.cos(z @ self.w + self.phase), z / 4, np.ones((len(z), 1))])

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.lift(x) @ self.beta

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(x), self.constant)
        r = self.raw(x)
        step = np.clip(np.searchsorted(self.steps, r, side="right") - 1, 0, len(self.steps) - 1)
        # a small part of the uncalibrated score keeps the order inside a step
        return np.clip(0.96 * self.values[step] + 0.04 / (1 + np.exp(-4 * np.clip(r - 0.5, -5, 5))), 0, 1)


def _table(docs: DataFrame, extra: list[str]) -> DataFrame:
    """extra and x, the statistics of each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in vec.slices(batch):
                x = statistics(*vec.buffers(part.column("text")))
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in extra), pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), x.shape[1]).cast(pa.list_(pa.float64()))], [*extra, "x"])

    types = {f.name: f.dataType.simpleString() for f in docs.schema}
    return docs.select(*extra, "text").mapInArrow(released(run), ", ".join([*(f"`{c}` {types[c]}" for c in extra), "x array<double>"]))


def _matrix(column: pa.Array) -> np.ndarray:
    return np.asarray(column.flatten()).reshape(len(column), len(STATISTICS))


def fit(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> Model:
    """Learn from at most `rows` labelled documents that are not held out; one part in CALIBRATION_PARTS calibrates."""
    train = cut(_table(sample(docs, labels, "quality", 4, 2, rows), ["doc_id", "y"]), "statistics")
    d = len(STATISTICS)
    part = F.pmod(F.xxhash64("doc_id", F.lit("part")), F.lit(CALIBRATION_PARTS)) == 0
    sums = train.select(F.count("*").alias("n"), F.sum("y").alias("y")).first()
    n, good = sums["n"], sums["y"] or 0
    if not n or not 0 < good < n:
        return Model(np.zeros(d), np.ones(d), good / n if n else 0.5)
    m = train.select(*(F.avg(F.col("x")[k]).alias(f"m{k}") for k in range(d)), *(F.stddev_pop(F.col("x")[k]).alias(f"s{k}") for k in range(d))).first()
    model = Model(np.array([m[f"m{k}"] for k in range(d)]), np.array([max(m[f"s{k}"], 1e-6) for k in range(d)]))

    def normal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = len(model.beta)
        a = np.zeros((size, size + 1))
        for batch in batches:
            z = model.lift(_matrix(batch.column("x")))
            a[:, :size] += z.T @ z
            a[:, size] += z.T @ batch.column("y").to_numpy().astype(float)
        yield pa.RecordBatch.from_arrays([pa.array(range(size), pa.int32()), pa.array(list(a), pa.list_(pa.float64()))], ["row", "a"])

    # the sample has at most `rows` rows, so a few partitions sum it; their sums are as large as the equations
    parts = train.filter(~part).select("x", "y").coalesce(8).mapInArrow(normal, "row int, a array<double>").collect()
    a = np.zeros((len(model.beta), len(model.beta) + 1))
    for r in parts:
        a[r["row"]] += np.array(r["a"])
    model.beta = np.linalg.solve(a[:, :-1] + RIDGE * np.eye(len(a)), a[:, -1])

    def raw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("y"), pa.array(model.raw(_matrix(batch.column("x"))))], ["y", "r"])

    got = train.filter(part).select("x", "y").mapInArrow(raw, "y int, r double").toPandas()
    model.steps, model.values = isotonic(got["r"].to_numpy(), got["y"].to_numpy(dtype=float)) if len(got) else (np.zeros(1), np.full(1, good / n))
    return model


def score(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """doc_id, held_out, score, predicted of every row."""
    model = fit(docs, labels, rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in vec.slices(batch):
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(model.score(statistics(*vec.buffers(part.column("text")))))], ["doc_id", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    scored = docs.select("doc_id", "text").mapInArrow(released(run), f"doc_id {kind}, score double")
    return scored.select("doc_id", held_out(4, 2).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
