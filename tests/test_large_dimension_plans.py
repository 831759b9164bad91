"""Without broadcasts every dimension counts as large and all joins are shuffle
joins.  The results must not change."""

from __future__ import annotations

import pytest
from conftest import SF_SMALL

from oracle_check import compare, duck

NAMES = ["customer_monthly_spend", "customer_spend_shared_key", "salesperson_monthly_sales",
         "top_seller_incentive", "sales_rank_in_store_month", "enrich_full", "daily_store_sales",
         "product_sales", "orphan_sales_of_region"]


@pytest.fixture(scope="module")
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield spark
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("name", NAMES)
def test_large_dimension_plan_matches_oracle(no_broadcast, name):
    r = compare(no_broadcast, name, SF_SMALL, duck(SF_SMALL))
    assert r["ok"], r


def test_aggregate_first_plan_has_no_broadcast(no_broadcast):
    import __spark_entry__ as entry

    df = entry.queries()["customer_monthly_spend"](no_broadcast, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastExchange" not in plan
    assert "SortMergeJoin" in plan
