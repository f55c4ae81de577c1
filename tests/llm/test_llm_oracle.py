"""Queries with SQL against DuckDB, and all queries on the smallest tables."""

import os

import duckdb
import pytest

from gridmart.llm import queries as Q

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables absent")


@pytest.mark.parametrize("name", sorted(Q.oracle_sql()))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    want = con.execute(Q.oracle_sql()[name])
    columns = sorted(d[0] for d in want.description)
    order = [[d[0] for d in want.description].index(c) for c in columns]
    df = Q.queries()[name](spark, SF)
    assert sorted(df.columns) == columns
    got = sorted((tuple(r) for r in df.select(columns).collect()), key=str)
    assert got == sorted((tuple(r[i] for i in order) for r in want.fetchall()), key=str)


COLUMNS = {
    "op2_language": {"doc_id", "held_out", "lang_pred", "score"},
    "op3_quality": {"doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                    "base_failed", "kept"},
    "op5_sharding": {"doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"},
    "op7_mixing": {"doc_id", "size", "source_size", "target", "taken"},
    "op8_toxicity": {"doc_id", "held_out", "score", "predicted"},
    "op9_simhash": {"doc_id", "fingerprint", "component_id"},
    "op10_bpe": {"doc_id", "n_tokens", "ids_sha256", "decoded_sha256"},
    "op12_manifest": {"doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"},
    "op13_pieces": {"doc_id", "n_tokens", "ids_sha256", "decoded_sha256"},
}


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_query_returns_every_document(spark, name):
    df = Q.queries()[name](spark, SF)
    assert COLUMNS[name] <= set(df.columns)
    ids = sorted(r.doc_id for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id").collect())
    assert sorted(r.doc_id for r in df.select("doc_id").collect()) == ids
