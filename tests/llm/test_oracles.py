"""The operators' queries against SQL, and that all are there."""

import pytest

from clickmart.llm import queries as Q
from tests.oracle_compare import compare, duck

NAMES = {int(n[2:].split("_")[0]): n for n in Q.queries()}


def test_one_query_for_each_operator():
    assert sorted(NAMES) == list(range(1, 14)) and len(Q.queries()) == 13
    assert set(Q.oracle_sql()) <= set(Q.queries())


def test_entry_has_all():
    import __spark_entry__ as entry

    assert {*Q.queries(), "pipeline"} <= set(entry.queries())
    assert set(Q.oracle_sql()) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(Q.oracle_sql()))
def test_matches_sql(spark, sf_dir, name):
    ok, said = compare(spark, sf_dir, name, Q.queries()[name], Q.oracle_sql()[name](), duck(sf_dir))
    assert ok, said
