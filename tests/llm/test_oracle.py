"""Registered corpus queries: contract columns, and DuckDB where SQL can express them."""

import duckdb
import pytest

from __spark_entry__ import oracle_sql, queries
from adsift.llm.queries import QUERIES
from tests.test_oracle import SF, TABLES, bag

COLUMNS = {
    "op1_toxicity": ["doc_id", "held_out", "score", "predicted"],
    "op2_suffix_dedup": ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
    "op3_pii": ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"],
    "op4_license_scan": ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"],
    "op6_packing": ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"],
    "op9_quality_rules": ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"],
    "op10_line_dedup": ["doc_id", "n_lines", "n_dropped", "kept_sha256"],
    "op11_conversation_repair": ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"],
    "op12_quality_embedding": ["doc_id", "held_out", "score", "predicted"],
    "op13_vector_codes": ["vec_id", "code", "error", "label_error", "codebooks_sha256"],
}


def test_all_are_registered():
    assert set(QUERIES) < set(queries()) and "pipeline" in queries()
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_contract_columns(spark, name):
    df = QUERIES[name](spark, SF)
    assert df.columns[:len(COLUMNS[name])] == COLUMNS[name]
    types = dict(df.dtypes)
    assert types[COLUMNS[name][0]] == "bigint"
    for c in COLUMNS[name]:
        if c.startswith("n_") or c in ("start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "first_word", "last_word", "gaps", "blank",
                                         "duplicate", "truncated", "illegal", "cost", "error", "label_error"):
            assert types[c] == "bigint", c


@pytest.mark.parametrize("name", sorted(n for n in oracle_sql() if n in QUERIES))
def test_matches_duckdb(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    cur = con.execute(oracle_sql()[name])
    want, cols = cur.fetchall(), [d[0] for d in cur.description]
    df = QUERIES[name](spark, SF)
    assert sorted(df.columns) == sorted(cols)
    assert bag([tuple(r) for r in df.collect()], df.columns) == bag(want, cols)
