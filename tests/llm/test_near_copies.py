import hashlib
import random
import re

import numpy as np
import pytest

from textloom.llm import components, ngram_join, suffix_dedup


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return set()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))}


def by_brute_force(rows):
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= 75 * len(sets[i] | sets[j]):
                parent[root(i)] = root(j)
    comps = {}
    for i in range(len(rows)):
        comps.setdefault(root(i), []).append(i)
    out = []
    for members in comps.values():
        ids = [rows[i][0] for i in members if rows[i][0] is not None]
        out += [(rows[i][0], len(sets[i]), min(ids) if ids else None) for i in members]
    return sorted(out, key=str)


def corpus(seed, families=6, copies=14):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    common = rng.choices(vocabulary, k=12)
    rows = []
    for _ in range(families):
        base = rng.choices(vocabulary, k=rng.randint(20, 60))
        for _ in range(copies):
            words = list(base)
            for _ in range(rng.randint(0, 4)):
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
            if rng.random() < 0.3:
                words = words[: rng.randint(15, len(words))]
            if rng.random() < 0.5:
                words += common
            rows.append(" ".join(words))
    rows += ["", None, "   ", "one", "ONE", "two words", "two  WORDS", "a b c d e", "a b c d e f"]
    return [(i, t) for i, t in enumerate(rows)]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_components_equal_brute_force(spark, seed):
    rows = corpus(seed)
    got = ngram_join.join(spark.createDataFrame(rows, "doc_id long, text string"), heavy_size=50).select("doc_id", "n_shingles", "component_id").collect()
    assert sorted(map(tuple, got), key=str) == by_brute_force(rows)


def test_rounds_of_neighbours_change_nothing(spark, monkeypatch):
    rows = corpus(5)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for per_row, worth in ((0, 0.0), (1000, 1.0)):
        monkeypatch.setattr(ngram_join, "PAIRS_PER_ROW", per_row)
        monkeypatch.setattr(ngram_join, "WORTH", worth)
        got = ngram_join.join(docs).select("doc_id", "n_shingles", "component_id").collect()
        assert sorted(map(tuple, got), key=str) == by_brute_force(rows)


@pytest.mark.parametrize("most", [0, 1000])
def test_components_of_paths_stars_and_cycles(spark, monkeypatch, most):
    monkeypatch.setattr(components, "LOCAL_LINKS", most)
    rng = random.Random(7)
    links = [(i, i + 1) for i in range(100, 140)] + [(200, i) for i in range(201, 230)] + [(300, 301), (301, 302), (302, 300)] + [(5, 400)]
    links += [(rng.randrange(500, 560), rng.randrange(500, 560)) for _ in range(30)]
    parent = {x: x for e in links for x in e}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        x, y = sorted((root(a), root(b)))
        parent[y] = x
    rng.shuffle(links)
    got = {r["node"]: r["component"] for r in components.components(spark.createDataFrame(links, "u long, v long")).collect()}
    linked = {x for a, b in links if a != b for x in (a, b)}
    assert {x: c for x, c in got.items() if x in linked} == {x: root(x) for x in linked}


def test_long_words_and_texts(spark):
    word = "a"
    while len(word) < 2048:
        word += word.translate(str.maketrans("ab", "ba"))
    other = word.translate(str.maketrans("ab", "ba"))  # equal to word for every polynomial modulo 2**64
    long = " ".join(f"w{i * i % 7919}" for i in range(30_000))
    rows = [(1, word), (2, other), (3, long), (4, long + " end"), (5, "x" * 500_000), (6, "x" * 500_000)]
    got = ngram_join.join(spark.createDataFrame(rows, "doc_id long, text string")).select("doc_id", "n_shingles", "component_id").collect()
    assert sorted(map(tuple, got), key=str) == by_brute_force(rows)


def test_a_shingle_in_every_document(spark):
    rng = random.Random(11)
    line = "the same five words everywhere"
    base = [f"v{i}" for i in range(40)]
    rows = []
    for i in range(150):  # one group of near copies, and others that share the line only
        words = list(base) if i % 3 == 0 else [f"u{rng.randrange(9000)}" for _ in range(40)]
        words[rng.randrange(40)] = f"x{i}"
        rows.append((i, line + " " + " ".join(words)))
    got = ngram_join.join(spark.createDataFrame(rows, "doc_id long, text string"), heavy_size=10).select("doc_id", "n_shingles", "component_id").collect()
    assert sorted(map(tuple, got), key=str) == by_brute_force(rows)


def test_null_and_repeated_ids(spark):
    rows = [(None, "a b c d e f"), (3, "a b c d e f"), (3, "x y z"), (None, None), (7, "x y z")]
    docs = spark.createDataFrame([(*r, "clash") for r in rows], "doc_id long, text string, token string")
    got = ngram_join.join(docs).select("doc_id", "n_shingles", "component_id").collect()
    assert sorted(map(tuple, got), key=str) == by_brute_force(rows)
    assert ngram_join.representatives(docs).count() == 3


def test_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert ngram_join.join(empty).count() == 0
    assert suffix_dedup.dedup(empty).count() == 0


def test_parity_tables_never_exceed_the_difference():
    rng = np.random.default_rng(0)
    for _ in range(100):
        base = rng.integers(0, 1 << 63, size=int(rng.integers(1, 300)), dtype=np.uint64)
        other = np.unique(np.concatenate([base[: int(len(base) * 0.9)], rng.integers(0, 1 << 63, size=5, dtype=np.uint64)]))
        a, b = ngram_join.parity_bits(np.unique(base)), ngram_join.parity_bits(other)
        if len(a) == len(b):
            differ = sum(int(x).bit_count() for x in (a.view(np.uint64) ^ b.view(np.uint64)))
            assert differ <= len(np.setxor1d(base, other))


# --- repeats of bytes ------------------------------------------------------------


def cut_by_brute_force(rows, length):
    seen, out = set(), []
    for doc_id, text in rows:
        b = (text or "").encode()
        gone = bytearray(len(b))
        for p in range(len(b) - length + 1):
            w = b[p : p + length]
            if w in seen:
                gone[p : p + length] = b"\x01" * length
            seen.add(w)
        kept = bytes(c for c, g in zip(b, gone) if not g)
        spans = sum(1 for i in range(len(gone)) if gone[i] and (i == 0 or not gone[i - 1]))
        out.append((doc_id, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def passages(seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choices("abcdeé ", k=rng.randint(1, 9)))
    shared = ["".join(word() for _ in range(rng.randint(5, 60))) for _ in range(5)]
    rows = []
    for i in range(40):
        parts = [rng.choice(shared) if rng.random() < 0.4 else "".join(word() for _ in range(rng.randint(0, 30))) for _ in range(rng.randint(0, 6))]
        rows.append((i, "".join(parts)))
    rows += [(100, None), (101, ""), (102, "ab" * 400), (103, "ab" * 400), (104, "x" * 99), (105, "x" * 99), (106, "y" * 100), (107, "y" * 100), (108, "z" * 3000)]
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_removed_bytes_equal_brute_force(spark, seed):
    rows = passages(seed)
    got = suffix_dedup.dedup(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    assert sorted(map(tuple, got), key=str) == cut_by_brute_force(rows, 100)


def test_long_texts_in_blocks(spark, monkeypatch):
    rng = random.Random(3)
    long = "".join(rng.choices("abcdefgh", k=5000))
    rows = [(1, long), (2, long[1200:3900] + "x" + long[:700])]
    monkeypatch.setattr(suffix_dedup, "BLOCK_BYTES", 512)
    data = spark.createDataFrame(rows, "doc_id long, text string")
    got = suffix_dedup.dedup(data).collect()
    assert sorted(map(tuple, got), key=str) == cut_by_brute_force(rows, 100)


def test_null_and_repeated_ids_follow_the_hash(spark):
    text = "abc" * 50
    rows = [(None, text), (2, "q" + text), (2, text + "r")]
    got = suffix_dedup.dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    tie = sorted(rows[1:], key=lambda r: hashlib.sha256(r[1].encode()).hexdigest())
    assert sorted(map(tuple, got), key=str) == cut_by_brute_force([rows[0], *tie], 100)


def test_columns_of_any_name_are_left_alone(spark):
    text = "0123456789" * 12
    rows = [(1, text, 7, "a", 3, "k"), (2, text + "end", 8, "b", 4, "k")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, id long, rest string, start int, key string")
    assert sorted(map(tuple, suffix_dedup.dedup(docs).collect()), key=str) == cut_by_brute_force([r[:2] for r in rows], 100)
    kept = suffix_dedup.kept_texts(docs).orderBy("doc_id").collect()
    assert [(r["id"], r["rest"], r["start"], r["key"]) for r in kept] == [(7, "a", 3, "k"), (8, "b", 4, "k")]
    assert kept[1]["text"] == "end"


def test_kept_texts_keep_columns(spark):
    rows = [(1, "a" * 10 + "0123456789" * 12, "s", 130), (2, "0123456789" * 12 + "end", "t", 123)]
    out = suffix_dedup.kept_texts(spark.createDataFrame(rows, "doc_id long, text string, source string, n_chars long")).orderBy("doc_id").collect()
    assert out[0].asDict()["source"] == "s"
    assert [r["n_chars"] for r in out] == [len(r["text"]) for r in out]


def test_longest_previous_factors_equal_brute_force():
    rng = random.Random(1)
    for _ in range(120):
        parts = [np.array(rng.choices([97, 98], k=rng.randint(0, 50)), dtype=np.uint8) for _ in range(rng.randint(1, 4))]
        got = suffix_dedup.longest_previous_factors(parts, 128)
        flat = [(k, i) for k, p in enumerate(parts) for i in range(len(p))]
        for a, (k, i) in enumerate(flat):
            best = 0
            for q, j in flat[:a]:
                x = 0
                while i + x < len(parts[k]) and j + x < len(parts[q]) and parts[k][i + x] == parts[q][j + x]:
                    x += 1
                best = max(best, x)
            assert got[k][i] == best
