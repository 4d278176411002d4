"""Every registered query against its DuckDB oracle on the smallest scale."""

import pytest

from roadflow.registry import oracle_sql, queries
from roadflow.testing import compare, duck_connect

from .conftest import SMALL_SF

QUERIES = queries()
ORACLE = oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return duck_connect(SMALL_SF)


def test_every_query_has_an_oracle():
    assert sorted(set(QUERIES) - set(ORACLE)) == []


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, duck, name):
    ok, msg = compare(QUERIES[name](spark, SMALL_SF), duck, ORACLE[name])
    assert ok, msg
