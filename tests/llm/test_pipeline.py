"""The pipeline's stages one by one and in a row, against brute force."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as cp
from tests.llm.conftest import corpus
from tests.llm.test_dedup import brute_bytes, brute_links

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture
def docs(spark, frame):
    rows = corpus(50, 80, 5)
    made = frame([*rows, rows[2]])
    return made.withColumn("lang", F.when(F.col("doc_id") % 2 == 0, "it").otherwise("es"))


def test_language_rejects_texts_without_words(spark, docs):
    kept = cp.language(spark, docs, "")
    assert kept.columns == docs.columns
    ids = {r.doc_id for r in kept.collect()}
    assert not ids & {50, 51, 52} and {r.doc_id for r in docs.collect() if r.text and r.text.strip()} == ids


def test_near_duplicates_keep_the_first_of_each_group(spark, docs):
    kept = cp.near_duplicates(spark, docs, "")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    want = {i for i, _, c in brute_links(rows) if i is not None and i == c}
    got = [r.doc_id for r in kept.collect()]
    assert kept.columns == docs.columns and len(got) == len(set(got)) and {i for i in got if i is not None} == want and None in got


def test_every_stage_keeps_columns_of_any_name(spark, docs):
    names = ["_", "_x", "_id", "_of", "_n", "_k", "_kept", "_times", "_t", "_turn", "_lang", "_score", "_spans", "_lang_pred", "_ids", "_decoded", "x", "s1", "s2", "low", "rep", "class_id", "component", "node", "spans", "kept_text", "taken", "size", "pattern", "__ids", "a.b"]
    wide = docs.drop("key", "score").select("*", *(F.concat(F.lit(n), F.col("doc_id").cast("string")).alias(n) for n in names))
    for name, stage in cp.STAGES:
        out = stage(spark, wide, "")
        assert out.columns[: len(wide.columns)] == wide.columns, name
        rows = out.collect()
        assert rows
        for r in rows:
            got = dict(zip(out.columns, r, strict=True))
            assert all(got[n] == (None if got["doc_id"] is None else f"{n}{got['doc_id']}") for n in names), name


def test_near_duplicates_with_one_id_for_several_texts(spark):
    a, b = " ".join(f"alpha{i}" for i in range(20)), " ".join(f"beta{i}" for i in range(20))
    docs = spark.createDataFrame([(1, a, "en", "s", 1), (2, a, "en", "s", 1), (2, b, "en", "s", 1), (2, b, "en", "s", 1)], "doc_id long, text string, lang string, source string, n_chars long")
    assert sorted((r.doc_id, r.text) for r in cp.near_duplicates(spark, docs, "").collect()) == [(1, a), (2, b)]


def test_passages_go_and_texts_stay_whole(spark):
    passage = "éàèùçñáíóúâêîôû shared passage that stands in two documents and is longer than a hundred bytes"
    rows = [(1, f"first {passage} end", "en", "s", 5), (2, f"ö{passage}ö second", "en", "s", 5), (3, passage, "en", "s", 5), (4, None, None, None, None), (None, passage, "en", "s", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = {r.doc_id: r for r in cp.repeated_passages(spark, docs, "").collect()}
    want = {i: k.decode("utf-8", "ignore") for i, _, _, k in brute_bytes([(r[0], r[1]) for r in rows], 100)}
    assert set(got) == {1, 2, 4, None} and got[1].text == rows[0][1] and got[4].text is None and got[None].text == passage
    assert got[2].text == want[2] == "öö second" and got[2].n_chars == len(got[2].text)


def test_mixture_takes_whole_documents_up_to_three_times(spark, docs):
    out = cp.mixture(spark, docs.withColumn("source", F.when(F.col("doc_id") < 5, "a").otherwise("b")), "")
    assert out.columns == docs.columns
    assert all(r["count"] <= 6 for r in out.groupBy("doc_id", "text").count().collect())


def test_all_stages(spark, tmp_path, docs):
    docs.coalesce(2).write.parquet(str(tmp_path / "documents.parquet"))
    a, b = (sorted(map(str, cp.run(spark, str(tmp_path)).collect())) for _ in "ab")
    assert a == b and a
    rows = cp.run(spark, str(tmp_path)).collect()
    assert all(r.n_tokens == len(r.ids) and r.round_trips for r in rows)
    docs.limit(0).write.mode("overwrite").parquet(str(tmp_path / "documents.parquet"))
    assert cp.run(spark, str(tmp_path)).count() == 0
    assert len(cp.STAGES) == 5 and all(callable(f) for _, f in cp.STAGES)


def test_on_the_tables(spark):
    rows = cp.run(spark, "/root/testdata/sf0.001").collect()
    assert rows and set(COLUMNS) <= set(rows[0].asDict())
