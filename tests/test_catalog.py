import duckdb
import pytest

from __spark_entry__ import oracle_sql, queries
from tests.compare_sql import TABLES, plain
from textlens.catalog.entries import ENTRIES
from textlens.catalog.oracles import ORACLES

FOLDER = "/root/testdata/sf0.001"

# no SQL form: fitted models, a caller's encoder, the nested response
ROWS_ONLY = {"pca_project", "kmeans_fit", "classify_fit", "classify_predict", "retrieve_response"}

# quick ones; the rest are compared by tests/compare_sql.py
COMPARED = ["heading_ffill", "split_couplets", "corpus_seq", "normalize_text", "class_weights", "hash_split", "bm25_search"]


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return connection


def test_every_query_has_sql_or_a_reason():
    assert set(ENTRIES) - set(ORACLES) == ROWS_ONLY
    assert not set(ORACLES) - set(ENTRIES)
    assert set(ENTRIES) <= set(queries()) and not set(oracle_sql()) - set(queries())


@pytest.mark.parametrize("key", COMPARED)
def test_query_equals_sql(spark, con, key):
    got = queries()[key](spark, FOLDER).toPandas()
    expected = con.execute(oracle_sql()[key]).df()
    assert sorted(got.columns) == sorted(expected.columns)
    assert len(got) and plain(got) == plain(expected)
