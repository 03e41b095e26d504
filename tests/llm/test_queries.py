import duckdb
from tests.llm.helpers import SF

import __spark_entry__ as entry
from layerworks.llm.queries import QUERIES, SQL


def test_registered():
    names = [f"op{n}_" for n in range(1, 14)]
    assert all(any(q.startswith(n) for q in QUERIES) for n in names) and "pipeline" in QUERIES
    assert QUERIES.keys() <= entry.queries().keys() and SQL.keys() <= entry.oracle_sql().keys()


def test_sql_gives_the_same_rows(spark):
    con = duckdb.connect()
    for table in ("documents", "embeddings", "benchmark"):
        con.execute(f"create view {table} as select * from '{SF}/{table}.parquet'")
    for name, sql in SQL.items():
        df = entry.queries()[name](spark, SF)
        want = con.execute(sql).df()
        assert sorted(df.columns) == sorted(want.columns)
        assert sorted(map(tuple, df.select(*want.columns).collect())) == sorted(want.itertuples(index=False, name=None))


def test_contract_columns(spark):
    wanted = {
        "op1_bpe_encode_decode": {"doc_id", "n_tokens", "ids_sha256", "decoded_sha256"},
        "op3_toxicity": {"doc_id", "held_out", "score", "predicted"},
        "op6_quality_rules": {"doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"},
        "op7_lm_scoring": {"doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"},
        "op10_simhash_near_dedup": {"doc_id", "fingerprint", "component_id"},
        "op13_personal_data": {"doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"},
    }
    n = spark.read.parquet(f"{SF}/documents.parquet").count()
    for name, columns in wanted.items():
        df = QUERIES[name](spark, SF)
        assert columns <= set(df.columns) and df.count() == n
