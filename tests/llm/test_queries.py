
import pytest
from oracle import assert_same

import corpus_pipeline
from textloom.llm import bpe, ngram_join, quality_rules
from textloom.llm import queries as llm


@pytest.mark.parametrize("name", sorted(llm.oracle_sql()))
def test_query_equals_its_sql(spark, sf_dir, name):
    assert_same(spark, sf_dir, llm.queries()[name], llm.oracle_sql()[name])


def test_every_operator_has_one_query():
    assert sorted(int(n[2:].split("_")[0]) for n in llm.queries()) == list(range(1, 11))


def test_pipeline_equals_its_stages_by_hand(spark, tmp_path):
    base = [("fine words about rivers and houses in the green land of hills " + str(i) + " ") * 2 for i in range(6)]
    texts = base + [base[0], "junk"] + [f"only {i} some more unlike text of its own kind number {i} here now" for i in range(5)]
    rows = [(i, t, "en", f"s{i % 2}", len(t)) for i, t in enumerate(texts)]
    columns = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(rows, columns).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    got = {(r["doc_id"], r["start"], r["length"], r["ids_crc32"]) for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    kept = [r["doc_id"] for r in quality_rules.judge(docs).collect() if r["kept"]]
    assert 7 not in kept
    docs = docs.filter(docs.doc_id.isin(kept))
    comps = {r["doc_id"]: r["component_id"] for r in ngram_join.join(docs).collect()}
    docs = docs.filter(docs.doc_id.isin([d for d, c in comps.items() if d == c]))
    assert docs.filter("doc_id = 6").count() == 0
    seen, cut = set(), {}
    for r in sorted(docs.collect(), key=lambda r: r["doc_id"]):
        b, gone = r["text"].encode(), [False] * len(r["text"].encode())
        for p in range(len(b) - 99):
            if b[p : p + 100] in seen:
                gone[p : p + 100] = [True] * 100
            seen.add(b[p : p + 100])
        cut[r["doc_id"]] = bytes(c for c, g in zip(b, gone) if not g).decode()
    # every id of every kept text is packed once
    assert {d for d, *_ in got} == set(cut)
    import pyarrow as pa

    for d, text in cut.items():
        n = sum(len(ids) for *_, ids, _ in bpe.encode_batch(pa.record_batch({"text": pa.array([text])}), bpe.vocabulary_path())) + 1
        assert sum(length for i, _, length, _ in got if i == d) == n


def test_stages_return_the_columns_of_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        before = docs
        docs = corpus_pipeline.cut(stage(spark, docs, sf_dir))
        assert docs.columns == before.columns
        assert 0 < docs.count() <= before.count()
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "quality_rules", "ngram_jaccard_join", "suffix_array_dedup", "packing"]


ODD = "doc_id long, text string, lang string, source string, n_chars long, id long, uid string, tie string, rest string, token long, queue string"


def _run(spark, path, rows):
    spark.createDataFrame(rows, ODD).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return corpus_pipeline.run(spark, str(path))


def test_pipeline_of_an_empty_table(spark, tmp_path):
    assert _run(spark, tmp_path, []).count() == 0


def test_pipeline_with_nulls_repeats_and_other_columns(spark, tmp_path):
    other = (1, "u", "t", "r", 2, "q")
    texts = [f"number {i} of some words on rivers and houses that are unlike all others here {i * i} {i + 7} end" for i in range(14)]
    rows = [(i, t, "en", "s", len(t), *other) for i, t in enumerate(texts)]
    rows += [(3, texts[3], "en", "s", 0, *other), (None, texts[4], "en", "s", 0, *other), (None, None, None, None, None, *other), (40, "", "en", None, 0, *other), (41, "unlike " * 3000, "en", "s", 0, *other)]
    found = _run(spark, tmp_path, rows).collect()
    # every text stays once: copies, empty texts and the one of a single word go
    assert len({(r["doc_id"], r["doc_tokens"]) for r in found}) == len(texts)
    assert {r["doc_id"] for r in found} - {None} <= set(range(14))
