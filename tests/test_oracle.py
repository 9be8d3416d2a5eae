"""Differential tests: every registered query vs its DuckDB oracle (sf0.001).

The driver runs the same comparison at sf0.01; ``python check_oracle.py``
does it by hand at any scale.
"""

import os

import pytest

import __spark_entry__ as entry
from lunchbox.plans import registry
from oracle_compare import compare, duck_connection

SF = os.environ.get("LUNCHBOX_TEST_SF", "/root/testdata/sf0.001")
QUERIES = registry.QUERIES
SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return duck_connection(SF)


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(SQL) and set(QUERIES) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_oracle(spark, duck, name):
    ok, msg = compare(spark, name, SF, QUERIES[name], SQL.get(name), duck)
    assert ok, msg


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["registration", "admission", "union_name", "period_label", "days",
                          "daily_value", "total", "company_cost", "employee_discount", "notes"]
    assert df.count() > 0
