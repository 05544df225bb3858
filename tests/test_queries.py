"""Every registered query against its SQL oracle, on the smallest test tables."""

import os
import sys

import pytest

import __spark_entry__ as contract
from catalog.queries import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

duckdb = pytest.importorskip("duckdb")
if not os.path.isdir(SF_DIR):
    pytest.skip(f"no test tables in {SF_DIR}", allow_module_level=True)

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

from check_oracles import compare, database  # noqa: E402


@pytest.fixture(scope="module")
def con():
    return database(SF_DIR)


def test_each_query_has_an_oracle():
    assert set(QUERIES) <= set(contract.queries())
    assert set(QUERIES) <= set(contract.oracle_sql()) <= set(contract.queries())


def test_entry(spark):
    assert contract.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(contract.oracle_sql()))
def test_query(spark, con, name):
    problem = compare(contract.queries()[name](spark, SF_DIR), con, contract.oracle_sql()[name])
    assert problem == ""
