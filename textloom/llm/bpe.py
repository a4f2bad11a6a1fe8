"""Byte-level BPE encoding by per-prefix dynamic programming, and decoding.

A text is cut by the vocabulary's pattern (computed on code-point classes, not
by a regular-expression engine). For each distinct word of a slice, every
prefix has exactly one last token: the one that ends there in the automaton of
vocabulary suffixes and forms a valid pair with the last token of the prefix
before it. Following back-pointers from the whole word gives the exact ids.
Words are solved in lockstep, one array step per byte position. The automaton is
a trie in a hash table with links to the longest proper suffix (about 3 MB).

Defined results: a null text is empty (no ids); special tokens' strings in a
text become their ids, as the tokenizers library does; texts of any length are
processed whole; a word longer than `LOCKSTEP_BYTES` is solved alone by the same
recurrence, so memory follows the longest document; repeated rows and doc_ids are
encoded each, null doc_ids too; an empty table gives no row; columns beside doc_id
and text are ignored, whatever their names. Only map tasks: no shuffle.
"""

from __future__ import annotations

import functools
import hashlib
import json
import sys
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from . import vec
from .common import released, table

VOCABULARY = "byte_bpe_50k.json"
LOCKSTEP_BYTES = 64
#: Prefixes of words that are solved at once, and bytes of text that one call looks at (a longer text goes alone).
CELLS = 1_000_000
SLICE_BYTES = 1_000_000
_LETTER, _NUMBER, _SPACE, _OTHER = 0, 1, 2, 3


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@functools.cache
def _classes() -> np.ndarray:
    """Class of each code point: letter, number, white space, other."""
    out = np.full(sys.maxunicode + 1, _OTHER, dtype=np.uint8)
    for c in range(sys.maxunicode + 1):
        kind = unicodedata.category(chr(c))[0]
        if kind == "L":
            out[c] = _LETTER
        elif kind == "N":
            out[c] = _NUMBER
    # the characters of \s: Unicode's White_Space property
    out[[*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]] = _SPACE
    return out


def code_points(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code points of valid UTF-8 and the byte at which each starts (plus the end)."""
    points = np.frombuffer(data.tobytes().decode("utf-8", "surrogatepass").encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    return points, np.append(np.flatnonzero((data & 0xC0) != 0x80), len(data))


def word_starts(points: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """Where the pattern's matches start; no match crosses an index in cuts (starts of documents)."""
    n = len(points)
    if not n:
        return np.zeros(0, np.int64)
    kind = _classes()[points]
    edge = np.ones(n + 1, dtype=bool)  # a run of one class starts here
    edge[1:n] = kind[1:] != kind[:-1]
    border = np.zeros(n + 1, dtype=bool)
    border[cuts] = True
    border[n] = True
    edge |= border
    start = edge[:n].copy()
    space = kind == _SPACE
    # a run of white space gives its last character to what follows (unless the text ends there)
    gives = space.copy()
    gives[: n - 1] &= edge[1:n] & ~border[1:n]
    gives[n - 1] = False
    given = np.flatnonzero(gives)
    start[given] = True
    plain = given[points[given] == 0x20]  # a blank joins the next run, any other character stands alone
    start[plain + 1] = False
    joined = np.zeros(n, dtype=bool)
    joined[plain + 1] = True
    # 's 't 're 've 'm 'll 'd after a run that does not end in a blank
    quote = np.flatnonzero((points == 0x27) & edge[:n] & edge[1:] & ~joined)
    quote = quote[quote + 1 < n]
    quote = quote[~border[quote + 1]]
    if len(quote):
        a, b = points[quote + 1], points[np.minimum(quote + 2, n - 1)]
        two_ok = (quote + 2 < n) & ~border[np.minimum(quote + 2, n)]
        one = np.isin(a, [ord(c) for c in "stmd"])
        two = two_ok & (((a == ord("r")) & (b == ord("e"))) | ((a == ord("v")) & (b == ord("e"))) | ((a == ord("l")) & (b == ord("l"))))
        hit = np.concatenate([quote[one] + 2, quote[two] + 3])
        start[np.concatenate([quote[one], quote[two]]) + 1] = False
        start[hit[hit < n]] = True
    return np.flatnonzero(start)


class Vocabulary:
    """Token bytes, merges and the automaton of suffixes of a byte-level BPE file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
        to_byte = self._byte_letters()
        tokens: dict[int, bytes] = {i: bytes(to_byte[c] for c in t) for t, i in vocab.items() if t not in self.special}
        ids = {b: i for i, b in tokens.items()}
        size = max([*tokens, *self.special.values()]) + 1
        self.byte_id = np.array([ids[bytes([b])] for b in range(256)], dtype=np.int64)
        rank = {}
        left, right = np.arange(size), np.arange(size)
        pairs, made, ranks = [], [], []
        for r, m in enumerate(merges):
            x, y = m.split(" ") if isinstance(m, str) else m
            c = vocab[x + y]
            if c not in rank:
                rank[c] = r
                left[c], right[c] = vocab[x], vocab[y]
            pairs.append(vocab[x] * size + vocab[y])
            made.append(c)
            ranks.append(r)
        self.size, self.left, self.right = size, left, right
        #: Order of merging; a single byte comes before every merge.
        self.rank = np.full(size, -1, dtype=np.int64)
        for c, r in rank.items():
            self.rank[c] = r
        order = np.argsort(pairs)
        self.pairs, self.made = np.array(pairs)[order], np.array(made)[order]
        self.pair_rank = np.array(ranks)[order]
        self.length = np.zeros(size, dtype=np.int64)
        for i, b in tokens.items():
            self.length[i] = len(b)
        names = [tokens.get(i, b"") for i in range(size)]
        for text, i in self.special.items():
            names[i] = text.encode()
        #: All token bytes in id order and where each starts.
        self.flat = np.frombuffer(b"".join(names), dtype=np.uint8), np.append(0, np.cumsum([len(x) for x in names]))
        del spec, vocab, merges, rank, pairs, made, ranks, names, tokens
        self._automaton(ids)
        self.cache_key = np.full(1 << 20, -1, dtype=np.int64)
        self.cache_ok = np.zeros(1 << 20, dtype=bool)

    @staticmethod
    def _byte_letters() -> dict[str, int]:
        """The letters that stand for bytes in the file: printable Latin-1 for itself, the rest from U+0100 on."""
        own = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or 0xAE <= b <= 0xFF]
        rest = [b for b in range(256) if b not in set(own)]
        return {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(rest)}

    def _automaton(self, ids: dict[bytes, int]) -> None:
        """States are prefixes of tokens: edges of their trie in a hash table, the state of the longest proper suffix, the longest token that ends a state, each token's next shorter one."""
        known: dict[bytes, int] = {b"": 0}
        parent, letter, token_at = [0], [0], [-1]
        for b, i in ids.items():
            for k in range(1, len(b) + 1):
                if b[:k] not in known:
                    known[b[:k]] = len(token_at)
                    parent.append(known[b[: k - 1]])
                    letter.append(b[k - 1])
                    token_at.append(-1)
            token_at[known[b]] = i
        known.clear()
        up, by, token = (np.array(x, dtype=np.int32) for x in (parent, letter, token_at))
        n = len(up)
        self.edge_key, self.edge_to = self._hashed((up[1:] << 8) | by[1:], np.arange(1, n, dtype=np.int32))
        depth = np.zeros(n, dtype=np.int32)
        for s in range(1, n):  # a parent comes before its children
            depth[s] = depth[parent[s]] + 1
        self.fail = np.zeros(n, dtype=np.int32)
        longest = np.full(n, -1, dtype=np.int32)
        shorter = np.full(self.size, -1, dtype=np.int32)
        for d in range(1, int(depth.max()) + 1):
            at = np.flatnonzero(depth == d)
            if d > 1:
                self.fail[at] = self.step(self.fail[up[at]], by[at])
            below = longest[self.fail[at]]
            ends = token[at] >= 0
            longest[at] = np.where(ends, token[at], below)
            shorter[token[at[ends]]] = below[ends]
        self.longest, self.shorter = longest, shorter

    @staticmethod
    def _slots(key: np.ndarray, size: int) -> np.ndarray:
        return (vec.mix(key.astype(np.uint64)) & np.uint64(size - 1)).astype(np.int64)

    def _hashed(self, key: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """A table with open addressing, a third full at most."""
        size = 1 << (3 * len(key)).bit_length()
        keys, values = np.full(size, -1, dtype=np.int32), np.full(size, -1, dtype=np.int32)
        at, left = self._slots(key, size), np.arange(len(key))
        while len(left):
            free = left[keys[at[left]] < 0]
            keys[at[free]] = key[free]  # of several, the last one stays
            values[at[free]] = value[free]
            left = left[keys[at[left]] != key[left]]
            at[left] = (at[left] + 1) & (size - 1)
        return keys, values

    def step(self, state: np.ndarray, letter: np.ndarray) -> np.ndarray:
        """The states after one more byte: the longest suffix that goes on."""
        out = np.zeros(len(state), dtype=np.int32)
        here, live = state.astype(np.int32), np.arange(len(state))
        letter = letter.astype(np.int32)
        size = len(self.edge_key)
        while len(live):
            key = (here[live] << 8) | letter[live]
            at = self._slots(key, size)
            found = self.edge_key[at]
            probe = np.flatnonzero((found != key) & (found >= 0))
            while len(probe):
                at[probe] = (at[probe] + 1) & (size - 1)
                found[probe] = self.edge_key[at[probe]]
                probe = probe[(found[probe] != key[probe]) & (found[probe] >= 0)]
            hit = found == key
            out[live[hit]] = self.edge_to[at[hit]]
            live = live[~hit & (here[live] > 0)]
            here[live] = self.fail[here[live]]
        return out

    def valid(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether tokens a and b side by side stay as they are; a < 0 (nothing before) is valid."""
        key = a.astype(np.int64) * self.size + b
        slot = (vec.mix(key.astype(np.uint64)) >> np.uint64(44)).astype(np.int64)
        ok = np.where(a < 0, True, self.cache_ok[slot])
        miss = np.flatnonzero((a >= 0) & (self.cache_key[slot] != key))
        if len(miss):
            new, at = np.unique(key[miss], return_inverse=True)
            fresh = self._test(new // self.size, new % self.size)
            ok[miss] = fresh[at]
            self.cache_key[slot[miss]], self.cache_ok[slot[miss]] = key[miss], ok[miss]
        return ok

    def _test(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """No merge across the border comes before the merges that built its two sides.

        Undo merges of the two sides, latest first, along the border; a pair there
        that could merge before the limit set by what was undone breaks the pair.
        """
        n = len(a)
        a, b = a.astype(np.int64), b.astype(np.int64)
        ok, open_ = np.ones(n, dtype=bool), np.arange(n)
        # a merge across the border must precede `limit`, a merge of the same rank counts by position
        limit = np.full(n, np.iinfo(np.int64).max)
        while len(open_):
            x, y = a[open_], b[open_]
            key = x * self.size + y
            at = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
            # twice the rank, plus one after a right side was undone: a merge further left goes first on equal ranks
            bad = (self.pairs[at] == key) & (2 * self.pair_rank[at] < limit[open_])
            ok[open_[bad]] = False
            rx, ry = self.rank[x], self.rank[y]
            done = bad | ((rx < 0) & (ry < 0))
            left_first = rx > ry  # on equal ranks the right token was built later
            step = ~done & left_first
            i = open_[step]
            a[i], limit[i] = self.right[x[step]], 2 * rx[step]
            step = ~done & ~left_first
            i = open_[step]
            b[i], limit[i] = self.left[y[step]], 2 * ry[step] + 1
            open_ = open_[~done]
        return ok

    def solve(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words data[start:end] one after the other, and how many each has."""
        size = ends - starts
        order = np.argsort(size, kind="stable")
        counts = np.zeros(len(starts), dtype=np.int64)
        parts: list[tuple[np.ndarray, np.ndarray]] = []  # (word, ids by position) per group
        a = 0
        while a < len(order):
            width = int(size[order[a]])
            b = int(np.searchsorted(size[order], max(width, min(2 * width, LOCKSTEP_BYTES)), side="right"))
            b = min(b, a + max(1, CELLS // max(1, int(size[order[b - 1]]))))
            group = order[a:b]
            parts.append((group, self._lockstep(data, starts[group], size[group])))
            counts[group] = (parts[-1][1] >= 0).sum(axis=1)
            a = b
        ids = np.zeros(int(counts.sum()), dtype=np.int64)
        first = np.cumsum(counts) - counts
        for group, found in parts:
            keep = found >= 0
            rank = np.cumsum(keep, axis=1, dtype=np.int32) - 1
            ids[(first[group][:, None] + rank)[keep]] = found[keep]
        return ids, counts

    def _lockstep(self, data: np.ndarray, starts: np.ndarray, size: np.ndarray) -> np.ndarray:
        """[word, position]: the token that starts there, or -1."""
        n, width = len(starts), int(size.max(initial=0))
        last = np.full((width + 1, n), -1, dtype=np.int32)
        state = np.zeros(n, dtype=np.int32)
        for i in range(1, width + 1):
            live = np.flatnonzero(size >= i)
            state[live] = self.step(state[live], data[starts[live] + i - 1])
            token = self.longest[state[live]]
            while len(live):
                before = i - self.length[token]
                ok = self.valid(last[before, live], token)
                last[i, live[ok]] = token[ok]
                live, token = live[~ok], self.shorter[token[~ok]]
        out = np.full((n, width), -1, dtype=np.int32)
        at, live = size.copy(), np.arange(n)
        while len(live):
            token = last[at[live], live]
            at[live] -= self.length[token]
            out[live, at[live]] = token
            live = live[at[live] > 0]
        return out

    def decode_bytes(self, ids: np.ndarray) -> np.ndarray:
        """The bytes of the ids."""
        flat, at = self.flat
        size = at[ids + 1] - at[ids]
        total = int(size.sum())
        return flat[np.arange(total) + np.repeat(at[ids] - (np.cumsum(size) - size), size)]

    def decode(self, ids: np.ndarray) -> str:
        return self.decode_bytes(np.asarray(ids, dtype=np.int64)).tobytes().decode("utf-8", "replace")

    def encode_column(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the texts one after the other, and the offsets of each text's ids."""
        raw = data.tobytes()
        marks: list[tuple[int, int, int]] = []  # start, end, id of special tokens, within one document each
        for text, i in self.special.items():
            mark, at = text.encode(), -1
            while (at := raw.find(mark, at + 1)) >= 0:
                doc = int(np.searchsorted(offsets, at, side="right")) - 1
                if at + len(mark) <= offsets[doc + 1] and not any(s < at + len(mark) and at < e for s, e, _ in marks):
                    marks.append((at, at + len(mark), i))
        points, byte_at = code_points(data)
        cuts = np.unique(np.concatenate([offsets[:-1], *([s, e] for s, e, _ in marks)])).astype(np.int64) if marks else np.unique(offsets[:-1])
        starts = byte_at[word_starts(points, np.searchsorted(byte_at, cuts[cuts < len(data)]))]
        ends = np.append(starts[1:], len(data))
        if not len(starts):
            return np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
        special = np.full(len(starts), -1, dtype=np.int64)
        drop = np.zeros(len(starts), dtype=bool)
        for s, e, i in marks:
            a, b = np.searchsorted(starts, [s, e])
            drop[a:b] = True
            drop[a], special[a] = False, i
        hashes = vec.span_hashes(data, starts, ends)
        _, first, word = np.unique(hashes, return_index=True, return_inverse=True)
        # words of one hash are one word only if their bytes are: any other is solved on its own
        other = np.flatnonzero(~vec.equal_spans(data, starts, ends, first[word]))
        if len(other):
            word[other] = len(first) + np.arange(len(other))
            first = np.concatenate([first, other])
        ids, counts = self.solve(data, starts[first], ends[first])
        begin = np.cumsum(counts) - counts
        n = counts[word]
        n[special >= 0], n[drop] = 1, 0
        where = np.cumsum(n) - n
        total = int(n.sum())
        out = ids[np.minimum(np.arange(total) + np.repeat(begin[word] - where, n), max(0, len(ids) - 1))]
        out[where[special >= 0]] = special[special >= 0]
        at = np.append(where, total)[np.searchsorted(starts, offsets)]
        return out, at


@functools.cache
def id_bound(path: str) -> int:
    """One more than the largest id of a vocabulary file; for the driver, which needs no automaton."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    return max([*spec["model"]["vocab"].values(), *(t["id"] for t in spec["added_tokens"])]) + 1


@functools.lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def encode_batch(batch: pa.RecordBatch, path: str, column: str = "text") -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(rows, bytes, byte offsets, ids, id offsets) of the batch's slices."""
    for part in vec.slices(batch, column, SLICE_BYTES):
        data, offsets = vec.buffers(part.column(column))
        yield part, data, offsets, *vocabulary(path).encode_column(data, offsets)


def round_trip(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256."""
    path = path or vocabulary_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, _, _, ids, at in encode_batch(batch, path):
                flat = np.ascontiguousarray(ids, dtype="<u4")
                digests = [hashlib.sha256(flat[a:b]).hexdigest() for a, b in zip(at[:-1], at[1:])]
                decoded = [hashlib.sha256(vocabulary(path).decode(ids[a:b]).encode()).hexdigest() for a, b in zip(at[:-1], at[1:])]
                yield pa.RecordBatch.from_arrays([part.column("doc_id").cast(pa.int64()), pa.array(np.diff(at), pa.int64()), pa.array(digests, pa.string()), pa.array(decoded, pa.string())], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select("doc_id", "text").mapInArrow(released(run), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(table(spark, sf_dir, "documents"))
