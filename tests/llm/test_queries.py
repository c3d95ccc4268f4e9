"""The registered queries that SQL can express, against DuckDB; all others run and keep their columns."""

import duckdb
import pytest

import __spark_entry__ as contract
from barwright.llm import queries

TABLES = ["documents", "embeddings", "pages", "benchmark", "labels", "conversations"]
COLUMNS = {
    "op2_language_id": ["doc_id", "held_out", "lang_pred", "score"],
    "op3_bpe_codec": ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
    "op5_html_main_text": ["page_id", "url", "text", "n_chars"],
    "op6_license_scan": ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"],
    "op7_embedding_near_dedup": ["vec_id", "n_links", "component_id", "kept"],
    "op8_lm_pseudo_likelihood": ["doc_id", "n_tokens", "log_prob", "mean_log_prob"],
    "op13_quality_classifier": ["doc_id", "held_out", "score", "predicted"],
    "op10_minhash_near_dedup": ["doc_id", "n_shingles", "component_id", "kept"],
}


def test_all_are_registered():
    assert set(queries.QUERIES) | {"pipeline"} <= set(contract.queries())
    assert {int(n[2:].split("_")[0]) for n in queries.QUERIES} == set(range(1, 14))
    assert set(COLUMNS) | set(queries.ORACLES) == set(queries.QUERIES)


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_sql(spark, sf_dir, name):
    duck = duckdb.connect()
    for t in TABLES:
        duck.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    df = queries.QUERIES[name](spark, sf_dir)
    expected = duck.sql(queries.ORACLES[name])
    assert sorted(df.columns) == sorted(expected.columns)
    got = [tuple(r[c] for c in expected.columns) for r in df.collect()]
    assert sorted(got, key=repr) == sorted(expected.fetchall(), key=repr)


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_columns(spark, sf_dir, name):
    assert queries.QUERIES[name](spark, sf_dir).columns == COLUMNS[name]
