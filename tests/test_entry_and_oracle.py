"""Driver contract and the DuckDB oracle on the smallest data set."""

import pytest

import __spark_entry__ as entry
from conftest import SF001
from oracle_check import compare, duck


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "customer_lifetime_value" in df.columns


def test_every_oracle_key_is_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


SQL_KEYS = sorted(entry.oracle_sql())


@pytest.fixture(scope="module")
def con():
    return duck(SF001)


@pytest.mark.parametrize("key", SQL_KEYS)
def test_matches_oracle(spark, con, key):
    r = compare(spark, con, key, SF001, entry.queries()[key], entry.oracle_sql()[key])
    assert r["status"] == "OK", r.get("detail")


@pytest.mark.parametrize("key", sorted(set(entry.queries()) - set(SQL_KEYS)))
def test_rows_only_keys_run(spark, key):
    assert entry.queries()[key](spark, SF001).count() > 0
