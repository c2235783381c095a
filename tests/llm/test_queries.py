"""The registered queries over the small table: contract columns, and the oracle where there is one."""

import duckdb
import pytest

import __spark_entry__ as entry
from searchlens.llm.queries import ORACLE_SQL, QUERIES

from .edge import SF

COLUMNS = {
    "op1_exact_dedup": ["doc_id", "keep_id", "group_size", "kept", "text_sha256"],
    "op2_token_files": ["doc_id", "start", "n_tokens", "ids_crc32"],
    "op3_best_fit_packing": ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
    "op4_secret_scan": ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
    "op5_sharding": ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"],
    "op7_simhash_dedup": ["doc_id", "fingerprint", "component_id"],
    "op10_quality": ["doc_id", "held_out", "score", "predicted"],
    "op11_hard_negatives": ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"],
    "op12_periodic_runs": ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"],
    "op13_sentence_pieces": ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
}


def test_every_operator_and_the_pipeline_are_registered():
    names = entry.queries()
    assert {n.split("_")[0] for n in QUERIES} == {f"op{k}" for k in range(1, 14)}
    assert set(QUERIES) <= set(names) and "pipeline" in names
    assert set(ORACLE_SQL) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, name):
    df = QUERIES[name](spark, SF)
    if name in COLUMNS:
        assert df.columns[:len(COLUMNS[name])] == COLUMNS[name]
    rows = [tuple(r) for r in df.collect()]
    assert rows
    if name in ORACLE_SQL:
        con = duckdb.connect()
        con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF}/documents.parquet')")
        cursor = con.execute(ORACLE_SQL[name])
        assert [d[0] for d in cursor.description] == df.columns
        assert sorted(map(str, cursor.fetchall())) == sorted(map(str, rows))
