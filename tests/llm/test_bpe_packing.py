import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

tokenizers = pytest.importorskip("tokenizers")

from textloom.llm import bpe, packing, vec

EDGES = ["", " ", "\n", "a", "don't we'll", "'s's", "x  y\n\n z", "\t\t", "é中文 123²", "<|endoftext|>", "a<|endoftext|>b", "😀" * 3, "a" * 3000, "aa b" * 500, " " * 400, "\x00\x01", "ſ K"]


@pytest.fixture(scope="module")
def reference():
    return tokenizers.Tokenizer.from_file(bpe.vocabulary_path())


def texts():
    rng = random.Random(4)
    parts = ["a", "the", "ing", "'s", "'ll", "'", " ", "  ", "\n", "é", "ß", "中", "1", "23", "²", "!", "..", "😀", "<|endoftext|>", "don't", "\r\n", "\xa0"]
    return EDGES + ["".join(rng.choices(parts, k=rng.randint(0, 30))) for _ in range(1500)]


def test_ids_equal_the_tokenizers_library(reference):
    given = texts()
    got = []
    for _, _, _, ids, at in bpe.encode_batch(pa.record_batch({"text": pa.array(given, pa.string())}), bpe.vocabulary_path()):
        got += [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:])]
    assert got == [x.ids for x in reference.encode_batch(given, add_special_tokens=False)]
    v = bpe.vocabulary(bpe.vocabulary_path())
    assert [v.decode(np.array(x, dtype=np.int64)) for x in got] == given


def thue_morse(letters):
    """Two different words of `letters` letters that every polynomial hash modulo 2**64 takes for one."""
    word = "a"
    while len(word) < letters:
        word += word.translate(str.maketrans("ab", "ba"))
    return word, word.translate(str.maketrans("ab", "ba"))


@pytest.mark.parametrize("letters", [512, 1024, 2048])
def test_words_that_polynomials_confuse(reference, letters):
    a, b = thue_morse(letters)
    given = [a, b, f"{a} {b}", b]
    got = [ids[x:y].tolist() for _, _, _, ids, at in bpe.encode_batch(pa.record_batch({"text": pa.array(given)}), bpe.vocabulary_path()) for x, y in zip(at[:-1], at[1:])]
    assert got == [x.ids for x in reference.encode_batch(given, add_special_tokens=False)]


def test_words_of_one_hash_are_told_apart_by_their_bytes(reference, monkeypatch):
    monkeypatch.setattr(vec, "span_hashes", lambda data, starts, ends: np.zeros(len(starts), np.uint64))
    given = ["some words of one hash", "", "words again of some"]
    got = [ids[x:y].tolist() for _, _, _, ids, at in bpe.encode_batch(pa.record_batch({"text": pa.array(given)}), bpe.vocabulary_path()) for x, y in zip(at[:-1], at[1:])]
    assert got == [x.ids for x in reference.encode_batch(given, add_special_tokens=False)]


def test_hashes_of_spans():
    data = np.frombuffer(b"abcdefgh abcdefgh abcdefghi abcdefghi" + bytes(20), dtype=np.uint8)
    starts, ends = np.array([0, 9, 18, 28, 37, 38]), np.array([8, 17, 27, 37, 38, 40])
    h = vec.span_hashes(data, starts, ends)
    assert h[0] == h[1] and h[2] == h[3] and len(set(h.tolist())) == 4
    assert vec.equal_spans(data, starts, ends, np.array([1, 0, 3, 3, 4, 4])).tolist() == [True, True, True, True, True, False]


def test_decoding_of_cut_characters(reference):
    v = bpe.vocabulary(bpe.vocabulary_path())
    rng = random.Random(1)
    for _ in range(200):
        ids = [rng.randrange(v.size) for _ in range(rng.randint(0, 8))]
        assert v.decode(np.array(ids, dtype=np.int64)) == reference.decode(ids, skip_special_tokens=False)


def documents(spark):
    rng = random.Random(9)
    rows = [(i, t, rng.choice(["a", "a", "a", "b", None])) for i, t in enumerate(EDGES)] + [(100 + i, "word " * rng.randint(0, 400), "a") for i in range(40)]
    return spark.createDataFrame([*rows, (5, None, "b"), (5, None, "b")], "doc_id long, text string, source string")


def test_round_trip_of_nulls_and_repeats(spark):
    rows = bpe.round_trip(documents(spark)).collect()
    assert len(rows) == len(EDGES) + 42
    assert sum(r["n_tokens"] == 0 for r in rows) == 3
    empty = documents(spark).limit(0)
    assert bpe.round_trip(empty).count() == 0


@pytest.mark.parametrize(("shard", "length"), [(1 << 22, 1024), (500, 64)])
def test_every_id_lies_in_one_piece(spark, reference, shard, length):
    docs = documents(spark).filter("doc_id <> 5")
    rows = packing.pack(docs, length=length, shard_tokens=shard, least=16).collect()
    ids = {r["doc_id"]: [*reference.encode(r["text"], add_special_tokens=False).ids, 0] for r in docs.collect()}
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_sequence.setdefault(r["sequence_id"], []).append(r)
        part = ids[r["doc_id"]][r["start"] : r["start"] + r["length"]]
        assert zlib.crc32(np.array(part, dtype="<u4").tobytes()) == r["ids_crc32"]
        assert r["doc_tokens"] == len(ids[r["doc_id"]])
    assert set(by_doc) == set(ids)
    for d, found in by_doc.items():
        at = 0
        for r in sorted(found, key=lambda r: r["start"]):
            assert r["start"] == at
            at += r["length"]
        assert at == len(ids[d])
    for found in by_sequence.values():
        at = 0
        for r in sorted(found, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= length and at & (at - 1) == 0 or at == length


def test_repeated_rows_are_packed_each(spark):
    rows = packing.pack(documents(spark)).filter("doc_id = 5 and doc_tokens = 1").collect()
    assert len(rows) == 2
    assert packing.pack(documents(spark).limit(0)).count() == 0


def test_targets_hold_while_queues_last():
    served = packing.serve([10_000, 10_000], np.zeros(2), np.array([0.75, 0.25]), packing.sequence_sizes(8192, 1024), 64)
    per = np.zeros((8, 2))
    for k, q, n in served:
        per[k, q] += n
    assert (per.sum(axis=1) == 1024).all()
    assert np.abs(per.cumsum(axis=0) - np.outer(np.arange(1, 9) * 1024, [0.75, 0.25])).max() <= 64


def test_a_carried_deficit_is_paid_first():
    served = packing.serve([2000, 2000], np.array([-500.0, 500.0]), np.array([0.5, 0.5]), np.array([1024]), 64)
    # 1012 are owed; the twelve left are less than a piece and go to the same queue
    assert sum(n for _, q, n in served if q == 1) == 1024


def test_many_small_sources_and_a_named_one(spark):
    rows = [(1000 * k + i, "some words of a text " * 5, f"s{k:03d}") for k in range(300) for i in range(6)]
    docs = spark.createDataFrame([(*r, 1, "x", 2) for r in rows], "doc_id long, text string, source string, n int, ids string, uid int")
    found = packing.pack(docs, max_queues=8, length=4096, least=16).collect()
    assert sum(r["length"] for r in found) == sum({r["doc_id"]: r["doc_tokens"] for r in found}.values())
    order = sorted(found, key=lambda r: (r["sequence_id"], r["offset"]))
    small = [r["doc_id"] // 1000 for r in order if r["start"] == 0 and r["doc_id"] // 1000 >= 10]
    # in each sixth of the stream nearly every small source is met
    step = len(small) // 6
    assert all(len(set(small[k * step : (k + 1) * step])) > 0.8 * 290 for k in range(6))
    share = packing.pack(docs, targets={"s299": 0.5, "s000": 0.5}, max_queues=3, length=256, least=16).filter("sequence_id = 0").collect()
    assert {r["doc_id"] // 1000 for r in share} == {0, 299}
