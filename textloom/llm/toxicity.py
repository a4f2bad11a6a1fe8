"""Toxicity by Levenshtein automata over a lexicon trie, with context windows.

Lexicon: words and word beginnings of labelled documents (never held-out ones)
whose presence speaks for the label, chosen greedily so that each new term
explains toxic documents that none before explains. Matching: the product of a
Levenshtein automaton (one edit from `FUZZY[0]` letters on, two from
`FUZZY[1]`) and the trie of the lexicon, made deterministic as words call for
its states, runs over a slice's distinct words in lockstep. Each hit looks at
`WINDOW` words on either side: between an opening and a closing quotation mark of
one family it counts as quoted. A mark opens before a word and closes after one;
between two letters it is an apostrophe.
A logistic regression over counts of exact, misspelled and quoted hits and
their density gives the score.

Defined results: a null or empty text has no hits and the lowest score; repeated
rows are scored alike; without labelled rows of both kinds every score is the
share of toxic labels (0 without any); an empty table gives no row; equal texts
have equal scores, whatever stands beside them; columns beside doc_id and text are
ignored, whatever their names. Texts and words of any length are read whole. labels, lang,
source and doc_id are no inputs of a score. Memory: a slice of texts and the
automaton; the fit reads at most `rows` labelled documents.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import vec
from .bpe import code_points
from .common import cut, released, table
from .training import SAMPLE_ROWS, held_out, sample

FUZZY = (5, 9)
WINDOW = 8
LEAST_SUPPORT, LEAST_PRECISION, LEAST_GAIN = 3, 0.6, 8.0
#: A pure term of this share of the toxic documents needs no further reason.
STRONG_SHARE = 0.05
PREFIX_LETTERS = (3, 10)
MAX_CANDIDATES, MAX_TERMS = 4000, 400
THRESHOLD = 0.7
#: What is no part of a word at its ends: ASCII marks, general punctuation, CJK punctuation but for its letters, and a few of Latin-1.
_ASCII_MARKS = '!"#$%&\'()*+,-./:;<=>?@[\\]^_`{|}~'
_MARKS = _ASCII_MARKS + "¡«·»¿" + "".join(map(chr, range(0x2000, 0x2040))) + "".join(chr(c) for c in range(0x3000, 0x3040) if not 0x3005 <= c <= 0x3007)
#: Quotation marks by family; a passage ends with a mark of the family that opened it.
_FAMILY = {m: k for k, ms in enumerate(['"“”„‟', "«»", "‹›", "'‘’‚‛", "「」", "『』"]) for m in ms}
_OPENS, _CLOSES = frozenset("“„‟«‹‘‚‛「『"), frozenset("”»›’」』")


class Matcher:
    """Least edits between a word and the lexicon, as a deterministic automaton built on demand.

    terms: (letters, is_beginning); a beginning matches any word that starts with it.
    """

    def __init__(self, terms: list[tuple[str, bool]]):
        self.children: list[dict[int, int]] = [{}]
        self.allowed, self.ends, self.begins = [0], [False], [False]  # most edits of any term below; a term ends here
        for letters, beginning in terms:
            k = sum(len(letters) >= n for n in FUZZY)
            s = 0
            self.allowed[0] = max(self.allowed[0], k)
            for c in map(ord, letters):
                t = self.children[s].get(c)
                if t is None:
                    t = self.children[s][c] = len(self.children)
                    self.children.append({})
                    self.allowed.append(0)
                    self.ends.append(-1)
                    self.begins.append(-1)
                s = t
                self.allowed[s] = max(self.allowed[s], k)
            marks = self.begins if beginning else self.ends
            marks[s] = max(marks[s] if marks[s] is not False else -1, k)
        self.ends[0] = self.begins[0] = -1
        letters = sorted({c for node in self.children for c in node})
        self.letters = np.array(letters, dtype=np.uint32)
        self.width = len(letters) + 1  # the last class is any other letter
        self.ids: dict[tuple, int] = {}
        self.states: list[tuple] = []
        self.go = np.full((256, self.width), -1, dtype=np.int32)
        self.cost = np.full(256, 9, dtype=np.int8)
        # a state: (edits of the best beginning matched so far, frozenset of (node, edits))
        self.start = self._state(9, {0: 0})

    def _state(self, best: int, reach: dict[int, int]) -> int:
        """The state of these nodes and edits, letters of terms left out allowed for."""
        todo = list(reach)
        while todo:
            s = todo.pop()
            for t in self.children[s].values():
                e = reach[s] + 1
                if e <= self.allowed[t] and e < reach.get(t, 9):
                    reach[t] = e
                    todo.append(t)
        for s, e in reach.items():
            if e <= self.begins[s]:
                best = min(best, e)
        reach = {s: e for s, e in reach.items() if e < best}
        key = (best, frozenset(reach.items()))
        if key not in self.ids:
            i = self.ids[key] = len(self.states)
            self.states.append((best, reach))
            if i == len(self.cost):
                self.go = np.concatenate([self.go, np.full_like(self.go, -1)])
                self.cost = np.concatenate([self.cost, np.full_like(self.cost, 9)])
            self.cost[i] = min([best, *(e for s, e in reach.items() if e <= self.ends[s])])
        return self.ids[key]

    def _step(self, state: int, cls: int) -> int:
        best, reach = self.states[state]
        c = int(self.letters[cls]) if cls < len(self.letters) else -1
        out: dict[int, int] = {}

        def put(t: int, e: int) -> None:
            if e <= self.allowed[t] and e < out.get(t, 9):
                out[t] = e

        for s, e in reach.items():
            put(s, e + 1)  # a letter too many
            for d, t in self.children[s].items():
                put(t, e + (d != c))
        return self._state(best, out)

    def costs(self, points: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Least edits (9: no match) for each word points[start:end]."""
        at = np.minimum(np.searchsorted(self.letters, points), max(0, len(self.letters) - 1))
        cls = np.where(self.letters[at] == points, at, self.width - 1) if len(self.letters) else np.zeros(len(points), np.int64)
        order = np.argsort(starts - ends, kind="stable")  # longest first
        s, size = starts[order], (ends - starts)[order]
        state = np.full(len(s), self.start, dtype=np.int64)
        for i in range(int(size[0]) if len(s) else 0):
            live = int(np.searchsorted(-size, -i, side="left"))
            here = state[:live]
            c = cls[s[:live] + i]
            to = self.go[here, c]
            missing = np.flatnonzero(to < 0)
            if len(missing):
                for key in np.unique(here[missing] * self.width + c[missing]).tolist():
                    a, b = divmod(key, self.width)
                    t = self._step(a, b)
                    self.go[a, b] = t
                to = self.go[here, c]
            state[:live] = to
        out = np.empty(len(s), dtype=np.int8)
        out[order] = self.cost[state]
        return out


def _marked(data: np.ndarray) -> np.ndarray:
    """Which bytes are of marks (`_MARKS`)."""
    out = np.zeros(256, dtype=bool)
    out[list(_ASCII_MARKS.encode())] = True
    out = out[data]
    two = np.flatnonzero((data[:-1] == 0xC2) & np.isin(data[1:], [0xA1, 0xAB, 0xB7, 0xBB, 0xBF]))
    out[two] = out[two + 1] = True
    if len(data) > 2:
        third = data[2:]
        three = np.flatnonzero(((data[:-2] == 0xE2) & (data[1:-1] == 0x80)) | ((data[:-2] == 0xE3) & (data[1:-1] == 0x80) & ~((third >= 0x85) & (third <= 0x87))))
        for k in range(3):
            out[three + k] = True
    return out


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Per word: start and end without marks at its ends, document, raw start, raw end."""
    raw_start, raw_end, doc = vec.word_spans(data, offsets)
    mark = _marked(data)
    start, end = raw_start.copy(), raw_end.copy()
    # runs of marks are left in one step: the next byte that is none, the last that is none
    at = np.arange(len(data))
    after = np.minimum.accumulate(np.where(mark, len(data), at)[::-1])[::-1]
    before = np.maximum.accumulate(np.where(mark, -1, at))
    if len(start):
        start = np.minimum(after[start], end)
        end = np.where(start < end, before[end - 1] + 1, end)
    return start, end, doc, raw_start, raw_end


def _turns(text: str, before: str, after: str) -> list[tuple[int, bool]]:
    """(family, opens) of the quotation marks of a text, by what stands on either side; before, after: the letters around it."""
    out = []
    for i, c in enumerate(text):
        if c not in _FAMILY:
            continue
        left, right = text[i - 1] if i else before, text[i + 1] if i + 1 < len(text) else after
        family = _FAMILY[c]
        if family >= 4:  # no blanks in such texts: the mark itself tells
            out.append((family, c in _OPENS))
        elif left.isalnum() and right.isalnum():
            if family != 3 and c in _OPENS | _CLOSES:
                out.append((family, c in _OPENS))
        elif right.isalnum() or (left.isspace() and not right.isspace()):
            out.append((family, True))
        elif left.isalnum() or (right.isspace() and not left.isspace()):
            out.append((family, False))
        elif c in _OPENS | _CLOSES:
            out.append((family, c in _OPENS))
    return out


def enclosed(before: str, after: str) -> bool:
    """Whether a word with these texts before and after it stands in a quotation."""
    last = dict(_turns(before, " ", "x"))
    seen = set()
    for family, opens in _turns(after, "x", " "):
        if family not in seen and not opens and last.get(family):
            return True
        seen.add(family)
    return False


def _quoted(data: np.ndarray, start: np.ndarray, end: np.ndarray, raw_start: np.ndarray, raw_end: np.ndarray, doc: np.ndarray, hits: np.ndarray) -> np.ndarray:
    """Whether each hit stands in a quotation that opens and closes within its window."""
    out = np.zeros(len(hits), dtype=bool)
    if not len(hits):
        return out
    first = np.searchsorted(doc, doc[hits], side="left")
    last = np.searchsorted(doc, doc[hits], side="right") - 1
    a, b = raw_start[np.maximum(hits - WINDOW, first)], raw_end[np.minimum(hits + WINDOW, last)]
    # marks by their last byte; only windows with two of them are read as text
    lead = np.isin(data, [0x22, 0x27])
    third = data[2:]
    lead[2:] |= (data[:-2] == 0xE2) & (data[1:-1] == 0x80) & (((third >= 0x98) & (third <= 0x9F)) | (third == 0xB9) | (third == 0xBA))
    lead[2:] |= (data[:-2] == 0xE3) & (data[1:-1] == 0x80) & (third >= 0x8C) & (third <= 0x8F)
    lead[1:] |= (data[:-1] == 0xC2) & ((data[1:] == 0xAB) | (data[1:] == 0xBB))
    total = np.append(0, np.cumsum(lead))
    some = np.flatnonzero((total[start[hits]] > total[a]) & (total[b] > total[end[hits]]))
    for k in some.tolist():
        h = hits[k]
        out[k] = enclosed(data[a[k] : start[h]].tobytes().decode("utf-8", "replace"), data[end[h] : b[k]].tobytes().decode("utf-8", "replace"))
    return out


#: What the regression sees of a document.
FEATURES = ("exact", "misspelt", "quoted", "doubtful", "rate", "size")


def features(data: np.ndarray, offsets: np.ndarray, pure: Matcher, doubtful: Matcher) -> np.ndarray:
    """[document, FEATURES]: log counts of exact, misspelt and quoted hits, of hits of doubtful terms, hits for a hundred words, log words. data: lower case."""
    docs = len(offsets) - 1
    start, end, doc, raw_start, raw_end = words(data, offsets)
    per_doc = np.bincount(doc, minlength=docs)
    full = np.flatnonzero(end > start)
    cost = np.full((2, len(start)), 9, dtype=np.int8)
    if len(full):
        hashes = vec.span_hashes(data, start[full], end[full])
        _, first, word = np.unique(hashes, return_index=True, return_inverse=True)
        a, b = start[full][first], end[full][first]
        # only the distinct words are read as code points
        size = b - a
        at = np.cumsum(size) - size
        flat = data[np.arange(int(size.sum())) + np.repeat(a - at, size)]
        points, byte_at = code_points(flat)
        spans = np.searchsorted(byte_at, at), np.searchsorted(byte_at, at + size)
        for k, matcher in enumerate((pure, doubtful)):
            if len(matcher.children) > 1:
                cost[k, full] = matcher.costs(points, *spans)[word]
    hits = np.flatnonzero((cost < 9).any(axis=0))
    quoted = _quoted(data, start, end, raw_start, raw_end, doc, hits)
    count = lambda keep: np.bincount(doc[hits[keep]], minlength=docs)
    p, d = cost[0, hits], cost[1, hits]
    exact, near, said, unsure = count(~quoted & (p == 0)), count(~quoted & (p > 0) & (p < 9)), count(quoted), count(~quoted & (p > 0) & (d == 0))
    rate = 100 * (exact + unsure) / np.maximum(per_doc, 1)
    return np.stack([np.log1p(exact), np.log1p(near), np.log1p(said), np.log1p(unsure), np.minimum(rate, 20) / 4, np.log1p(per_doc)], axis=1)


def lower_column(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return vec.buffers(pc.utf8_lower(pc.fill_null(column.cast(pa.large_string()), "")))


def _terms_of(text: str) -> set[str]:
    """Words (closed by a blank) and beginnings of words in a lower-case text."""
    out = set()
    for w in set(text.split()):
        w = w.strip(_MARKS)
        if w:
            out.add(w + " ")
            out.update(w[:k] for k in range(PREFIX_LETTERS[0], min(len(w), PREFIX_LETTERS[1] + 1)))
    return out


def _gain(t: np.ndarray, c: np.ndarray, share: float) -> np.ndarray:
    """Log-likelihood ratio of a term's toxic and clean documents against the general share."""
    n = np.maximum(t + c, 1)
    with np.errstate(divide="ignore", invalid="ignore"):
        g = np.where(t > 0, t * np.log(t / (n * share)), 0) + np.where(c > 0, c * np.log(c / (n * (1 - share))), 0)
    return np.where(t / n > share, g, 0)


def lexicon(rows: DataFrame) -> list[tuple[str, bool, bool]]:
    """(letters, is_beginning, is_pure) from labelled rows (text, y); at most MAX_TERMS. Pure: hardly any clean document has it."""
    totals = {r["y"]: r["n"] for r in rows.groupBy("y").agg(F.count("*").alias("n")).collect()}
    toxic, clean = totals.get(1, 0), totals.get(0, 0)
    if not toxic or not clean:
        return []
    share = toxic / (toxic + clean)

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            t: dict[str, int] = {}
            c: dict[str, int] = {}
            for text, y in zip(batch.column("text").to_pylist(), batch.column("y").to_pylist()):
                into = t if y == 1 else c
                for x in _terms_of(text.lower()):
                    into[x] = into.get(x, 0) + 1
            yield pa.RecordBatch.from_arrays([pa.array(list(t)), pa.array(list(t.values()), pa.int64()), pa.array([c.get(x, 0) for x in t], pa.int64())], ["term", "t", "c"])
            rest = [x for x in c if x not in t]
            yield pa.RecordBatch.from_arrays([pa.array(rest, pa.string()), pa.array([0] * len(rest), pa.int64()), pa.array([c[x] for x in rest], pa.int64())], ["term", "t", "c"])

    counts = rows.select("text", "y").mapInArrow(spread, "term string, t long, c long").groupBy("term").agg(F.sum("t").alias("t"), F.sum("c").alias("c"))
    n = F.col("t") + F.col("c")
    gain = F.col("t") * F.log(F.col("t") / (n * share)) + F.when(F.col("c") > 0, F.col("c") * F.log(F.col("c") / (n * (1 - share)))).otherwise(0.0)
    best = counts.filter((F.col("t") >= LEAST_SUPPORT) & (F.col("t") >= LEAST_PRECISION * n)).withColumn("gain", gain).filter(F.col("gain") >= LEAST_GAIN / 2)
    names = [r["term"] for r in best.orderBy(F.desc("gain"), F.desc(F.length("term")), "term").limit(MAX_CANDIDATES).collect()]
    if not names:
        return []
    index = {x: i for i, x in enumerate(names)}

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hits = [sorted(index[x] for x in _terms_of(text.lower()) if x in index) for text in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("y"), pa.array(hits, pa.list_(pa.int32()))], ["y", "hits"])

    # at most SAMPLE_ROWS rows of at most MAX_CANDIDATES small numbers; documents without any count only in the totals
    got = rows.select("text", "y").mapInArrow(found, "y int, hits array<int>").filter(F.size("hits") > 0).collect()
    has = np.zeros((len(got), len(names)), dtype=bool)
    y = np.array([r["y"] == 1 for r in got])
    for k, r in enumerate(got):
        has[k, r["hits"]] = True
    against = has[~y].sum(axis=0)
    all_toxic = has[y].sum(axis=0)
    general = _gain(all_toxic, against, share)
    chosen: list[int] = []
    related = lambda k: any(names[k].startswith(names[j]) or names[j].startswith(names[k]) for j in chosen)
    # terms of many toxic documents and hardly any clean one, the strongest of each family of beginnings
    strong = np.flatnonzero((all_toxic >= max(LEAST_SUPPORT + 1, STRONG_SHARE * toxic)) & (against <= 0.02 * all_toxic))
    length = np.array([len(x) for x in names])
    for k in strong[np.lexsort((length[strong], np.round(general[strong], 6)))][::-1].tolist():
        if len(chosen) < MAX_TERMS and not related(k):
            chosen.append(k)
    # then, one by one, the term that explains most of what is not explained
    left = np.ones(len(names), dtype=bool)
    left[chosen] = False
    open_ = has[y][~has[y][:, chosen].any(axis=1)]
    while len(chosen) < MAX_TERMS and len(open_):
        t = open_.sum(axis=0)
        g = np.where(left & (t >= LEAST_SUPPORT) & (t >= LEAST_PRECISION * (t + against)), _gain(t, against, share), 0)
        k = int(np.lexsort((length, np.round(g, 6)))[-1])
        if g[k] < LEAST_GAIN:
            break
        chosen.append(k)
        left[k] = False
        open_ = open_[~open_[:, k]]
    return [(names[k].rstrip(" "), not names[k].endswith(" "), bool(against[k] <= 0.02 * all_toxic[k])) for k in chosen]


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Weights and, last, the intercept, by Newton's method."""
    a = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(a.shape[1])
    penalty = ridge * np.eye(len(w))
    penalty[-1, -1] = 1e-3
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        step = np.linalg.solve(a.T @ (a * (p * (1 - p))[:, None]) + penalty, a.T @ (p - y) + penalty @ w)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def _feature_rows(terms: list[tuple[str, bool, bool]], extra: list[str], out: list[tuple[str, pa.DataType]], finish):
    """A mapInArrow function that yields `extra` and what finish(features) gives."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pure, doubtful = (Matcher([(x, b) for x, b, p in terms if p == kind]) for kind in (True, False))
        for batch in batches:
            for part in vec.slices(batch):
                x = features(*lower_column(part.column("text")), pure, doubtful)
                columns = [part.column(c) for c in extra] + [pa.array(v, t) for v, (_, t) in zip(finish(x), out)]
                yield pa.RecordBatch.from_arrays(columns, [*extra, *(c for c, _ in out)])

    return run


class Model:
    """A lexicon and the weights over its hits."""

    def __init__(self, terms: list[tuple[str, bool, bool]], weights: np.ndarray):
        self.terms, self.weights = terms, weights

    def score(self, docs: DataFrame, keep: list[str], name: str = "score") -> DataFrame:
        """The columns `keep` and, as `name`, the score of every row."""
        weights = self.weights
        types = {f.name: f.dataType.simpleString() for f in docs.schema}
        run = _feature_rows(self.terms, keep, [(name, pa.float64())], lambda x: [1 / (1 + np.exp(-np.clip(x @ weights[:-1] + weights[-1], -30, 30)))])
        return docs.select(*dict.fromkeys([*keep, "text"])).mapInArrow(released(run), ", ".join([*(f"`{c}` {types[c]}" for c in keep), f"`{name}` double"]))


def fit(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> Model:
    """Learn from at most `rows` labelled documents that are not held out."""
    train = cut(sample(docs, labels, "toxic", 3, 1, rows), "labelled")
    terms = lexicon(train)
    # the same text learned many times would weigh as often; each distinct text counts once in the regression
    got = train.dropDuplicates(["text", "y"]).mapInArrow(_feature_rows(terms, ["y"], [(k, pa.float64()) for k in FEATURES], lambda x: list(x.T)), "y int, " + ", ".join(f"{k} double" for k in FEATURES)).toPandas()
    x, y = got[list(FEATURES)].to_numpy(), got["y"].to_numpy(dtype=float)
    if not len(y) or y.min() == y.max():
        share = float(y.mean()) if len(y) else 0.0
        w = np.zeros(len(FEATURES) + 1)
        w[-1] = np.log((share + 1e-9) / (1 - share + 1e-9))
        return Model(terms, w)
    w = fit_logistic(x, y)
    w[:2] = np.maximum(w[:2], 0)  # more hits never speak against the label
    return Model(terms, w)


def score(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """doc_id, held_out, score, predicted of every row."""
    scored = fit(docs, labels, rows).score(docs, ["doc_id"])
    return scored.select("doc_id", held_out(3, 1).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
