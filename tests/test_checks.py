"""Every registered query against its SQL check, on the smallest given tables."""

import pytest

from tests.comparison import compare, duck
from tests.conftest import SMALL
from tidemark.plans import catalog


@pytest.fixture(scope="module")
def con():
    return duck(SMALL)


@pytest.mark.parametrize("name", sorted(catalog.CHECKS))
def test_query_equals_sql(spark, con, name):
    assert compare(catalog.QUERIES[name](spark, SMALL), con, catalog.CHECKS[name]) == []


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(catalog.CHECKS)))
def test_query_without_check_gives_rows(spark, name):
    assert catalog.QUERIES[name](spark, SMALL).count() > 0


def test_entry(spark):
    import __spark_entry__ as contract

    assert contract.entry(spark).columns[0] == "user_id"
    assert set(contract.oracle_sql()) <= set(contract.queries())
