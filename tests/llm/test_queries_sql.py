"""The registered queries: names, SQL where there is any, and the guard of the entry module."""

import duckdb
import pytest
from compare import difference

import __spark_entry__ as entry
from shelfcast.llm.queries import ORACLES, QUERIES


@pytest.fixture(scope="module")
def con(sf_dir):
    con = duckdb.connect()
    for table in ("documents", "embeddings", "pages"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def test_one_query_per_operator():
    numbers = [int(name[2:].split("_")[0]) for name in QUERIES]
    assert numbers == list(range(1, 11))
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_as_sql(spark, con, sf_dir, name):
    assert difference(QUERIES[name](spark, sf_dir), con, ORACLES[name]) is None


COLUMNS = {
    "op1_html_extract": ["page_id", "url", "text", "n_chars"],
    "op3_suffix_dedup": ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
    "op4_mix_sources": ["doc_id", "size", "source_size", "target", "taken"],
    "op6_winnowing": ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
    "op10_toxicity": ["doc_id", "held_out", "score", "predicted"],
}
KINDS = {"doc_id": "bigint", "n_chars": "bigint", "size": "bigint", "taken": "bigint", "target": "double", "score": "double", "predicted": "int"}


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_columns_and_rows(spark, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    kinds = dict(df.dtypes)
    assert set(COLUMNS[name]) <= set(kinds) and all(kinds[c] == k for c, k in KINDS.items() if c in kinds)
    table = "pages" if name.startswith("op1_") else "documents"
    assert df.count() == spark.read.parquet(f"{sf_dir}/{table}.parquet").count()
