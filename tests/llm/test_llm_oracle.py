"""The queries that SQL can state equal their DuckDB SQL; the others give the contract's columns."""

import duckdb
import pytest

from conftest import SMALL
from shipcast.llm.queries import ORACLE, QUERIES
from tools.oracle_check import TABLES, rows_of

COLUMNS = {
    "op1_license": "doc_id n_words n_base first_word last_word base_labels labels score",
    "op2_topk": "query_id rank vec_id score",
    "op3_quality_rules": "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept",
    "op4_lm": "doc_id held_out n_tokens n_known train_tokens base_score score",
    "op5_chat": "conv_id n_turns turns_sha256 loss_chars loss_sha256 formatted_chars",
    "op6_mixing": "doc_id size source_size target taken",
    "op7_quality": "doc_id held_out score predicted",
    "op8_near_dedup": "doc_id n_shingles component_id kept",
    "op9_sharding": "doc_id size text_crc32 law shard slot grown_shard",
    "op10_bpe": "doc_id n_tokens ids_sha256 decoded_sha256",
    "op11_hard_negatives": "anchor_id positive_id rank negative_id positive_score negative_score",
    "op12_prefix_trie": "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256",
    "op13_simhash": "doc_id fingerprint component_id",
}


def test_every_operator_has_its_query():
    assert {k: set(v.split()) for k, v in COLUMNS.items()}.keys() == QUERIES.keys()


@pytest.mark.parametrize("key", sorted(ORACLE))
def test_query_equals_sql(spark, key):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    df = QUERIES[key](spark, SMALL)
    assert set(COLUMNS[key].split()) <= set(df.columns)
    cur = con.execute(ORACLE[key])
    cols = [d[0] for d in cur.description]
    assert sorted(cols) == sorted(df.columns)
    got = rows_of([r.asDict(recursive=True) for r in df.collect()], df.columns)
    assert got == rows_of([dict(zip(cols, r)) for r in cur.fetchall()], cols)
