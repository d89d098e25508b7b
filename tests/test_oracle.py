"""Every registered query against its DuckDB statement, on the smallest tables."""

import pytest

import __spark_entry__ as entry
from conftest import SF_SMALL
from oracle_harness import compare, duck_connection
from veracity.plans.oracle import ORACLE
from veracity.plans.registry import QUERIES

SQL = ORACLE
KEYS = sorted(SQL)


@pytest.fixture(scope="module")
def con():
    return duck_connection(SF_SMALL)


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, con, key):
    r = compare(spark, SF_SMALL, key, entry.queries()[key], SQL[key], con)
    assert r["cols_match"], r
    assert not r.get("type_mismatch"), r
    assert r["exact"], r


ROWS_ONLY = {"model_scores", "model_metrics", "feature_importances", "gbt_grid_scores", "hashed_features", "vocab_features"}


def test_every_query_has_an_oracle_or_is_listed():
    rows_only = set(QUERIES) - set(SQL)
    assert rows_only == ROWS_ONLY, rows_only


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "reviewer_fraud_score" in df.columns
