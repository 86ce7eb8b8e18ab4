"""Every named query equals its DuckDB counterpart on whole tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as contract
from tests import compare


@pytest.fixture(scope="module")
def duck(sf):
    return compare.connect(sf)


def test_contract(spark):
    assert contract.entry(spark).columns[0] == "agent"
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(contract.oracle_sql()))
def test_query_equals_oracle(spark, duck, sf, name):
    assert compare.difference(spark, duck, contract.queries()[name], contract.oracle_sql()[name], sf) == ""


@pytest.mark.parametrize("name", sorted(set(contract.queries()) - set(contract.oracle_sql())))
def test_query_without_oracle_has_rows(spark, sf, name):
    assert contract.queries()[name](spark, sf).count() > 0
