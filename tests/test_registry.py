"""Every SQL statement stands for a query; a few of them are held against DuckDB here."""

import duckdb
import pytest

import __spark_entry__ as entry
from libretto.plans import registry

SF = "/root/testdata/sf0.001"


def test_sql_names_are_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", ["text_cleanup", "sentence_split", "pack_sentences", "chunk_manifest", "limit_split", "conversation_chunks", "timeline_frames", "chapter_segmentation", "classify_docs", "rule_numbers", "rule_symbols", "rule_notation", "chapter_qualification", "pcm_timeline", "scoped_star", "wer_counts", "ast_blocks", "rule_equation", "engine_requests", "ingest_blocks"])
def test_sql_agrees(spark, name):
    con = duckdb.connect()
    for t in ("documents", "conversations", "labels", "benchmark", "part", "orders"):
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    df = registry.queries()[name](spark, SF)
    got = con.execute(registry.oracle_sql()[name])
    at = [[d[0] for d in got.description].index(c) for c in df.columns]
    want = sorted(repr(tuple(r[i] for i in at)) for r in got.fetchall())
    assert sorted(repr(tuple(r)) for r in df.collect()) == want


def test_entry(spark):
    assert entry.entry(spark).count() > 0
