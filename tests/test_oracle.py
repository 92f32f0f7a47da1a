"""Every registered query against its DuckDB oracle text."""

import pytest

import __spark_entry__ as entry
from clickmart.plans import oracle, registry
from tests.oracle_compare import compare, duck

QUERIES = registry.queries()
ORACLE = oracle.oracle_sql()


def test_entry_has_every_query():
    assert set(QUERIES) <= set(entry.queries())
    assert set(ORACLE) <= set(entry.oracle_sql())


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


def test_every_query_has_an_oracle():
    assert set(ORACLE) == set(QUERIES)


@pytest.mark.parametrize("key", sorted(ORACLE))
def test_matches_oracle(spark, sf_dir, con, key):
    ok, msg = compare(spark, sf_dir, key, QUERIES[key], ORACLE[key], con)
    assert ok, msg


def test_entry_smoke(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert "bounce_rate" in df.columns
