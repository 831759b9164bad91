"""Every registered query against its DuckDB oracle (the driver's check)."""

from __future__ import annotations

import pytest
from conftest import SF_SMALL

import __spark_entry__ as entry
from oracle_check import compare, duck

#: Queries of the optional subpackage have tests of their own.
NAMES = sorted(n for n in entry.queries() if n not in entry.LLM_QUERIES)


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_has_an_oracle():
    assert set(NAMES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, name, SF_SMALL, con)
    assert r["ok"], r


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["store_id", "sales_person_id", "full_name", "sales_month",
                          "total_sales", "incentive"]
    assert df.count() > 0
