"""Physical-plan properties: pruned scans, pushed filters, broadcast dimensions,
partial aggregation before the shuffle."""

from __future__ import annotations

from conftest import SF_SMALL

import __spark_entry__ as entry


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_flagship_reads_only_needed_columns(spark):
    plan = _plan(entry.queries()["top_seller_incentive"](spark, SF_SMALL))
    # line items: keys, amount, ship date -- no part key (the mart needs no
    # product lookup), quantity, discount, tax or flags
    assert "ReadSchema: struct<l_orderkey:bigint,l_suppkey:bigint,l_extendedprice:double" in plan
    for unused in ("l_partkey", "p_name", "l_discount", "l_tax", "l_returnflag", "l_quantity",
                   "c_name", "o_totalprice"):
        assert unused not in plan
    # the customer side of the sales-team mart only needs its key
    assert "ReadSchema: struct<c_custkey:bigint>" in plan
    assert "PushedFilters: [IsNotNull(l_orderkey)" in plan


def test_small_dimensions_are_broadcast_and_aggregation_is_partial(spark):
    plan = _plan(entry.queries()["salesperson_monthly_sales"](spark, SF_SMALL))
    assert plan.count("BroadcastHashJoin") >= 6
    assert "SortMergeJoin" not in plan
    assert "partial_sum" in plan


def test_partition_filter_reaches_the_scan(spark, tmp_dir):
    from pyspark.sql import functions as F

    from tillflow.plans import sinks as S

    ext = entry.queries()["sales_team_mart_extract"](spark, SF_SMALL)
    S.write_partitioned(ext, tmp_dir + "/m", ["sales_month", "store_id"])
    back = S.read_partitioned(spark, tmp_dir + "/m", ext.schema)
    plan = _plan(back.where(F.col("sales_month") == "1998-05"))
    assert "PartitionFilters: [isnotnull(sales_month" in plan and "1998-05" in plan
