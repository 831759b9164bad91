"""A customer holding a third of all sales: with the customer table too large to
broadcast, AQE splits the hot partition of the shuffle join, and the
aggregate-first mart reduces the hot key before any shuffle by customer."""

from __future__ import annotations

from pyspark.sql import functions as F

from tillflow.operators import enrich as E
from tillflow.operators import marts as M
from tillflow.schema import MONEY

SKEW_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


def _hot_sales(spark, n=60_000):
    ids = spark.range(n).repartition(8)
    return ids.select(
        F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise(F.col("id") % 997 + 2)
        .cast("long").alias("customer_id"),
        (F.col("id") % 5).cast("int").alias("store_id"),
        F.lit("pen").alias("product_name"),
        F.expr("date_add(date'2001-01-01', cast(id % 90 as int))").alias("sales_date"),
        (F.col("id") % 7).alias("sales_person_id"),
        F.lit(1).cast(MONEY).alias("price"),
        F.lit(1).alias("quantity"),
        (F.col("id") % 100).cast(MONEY).alias("total_cost"),
        F.lit(None).cast("string").alias("additional_column"),
    )


def _dims(spark):
    customer = spark.range(1, 1000).select(
        F.col("id").alias("customer_id"), F.lit("f").alias("first_name"),
        F.col("id").cast("string").alias("last_name"), F.lit("a").alias("address"),
        F.lit("p").alias("pincode"), F.lit("t").alias("phone_number"))
    store = spark.range(5).select(F.col("id").cast("int").alias("id"), F.lit("s").alias("address"),
                                  F.lit("m").alias("store_manager_name"))
    team = spark.range(7).select(F.col("id").alias("id"), F.lit("x").alias("first_name"),
                                 F.lit("y").alias("last_name"), F.lit(0).cast("long").alias("manager_id"),
                                 F.lit("N").alias("is_manager"), F.lit("d").alias("address"),
                                 F.lit("p").alias("pincode"))
    return customer, store, team


def test_hot_customer_join_is_split_and_results_hold(spark):
    old = {k: spark.conf.get(k, None) for k in SKEW_CONF}
    for k, v in SKEW_CONF.items():
        spark.conf.set(k, v)
    try:
        sales = _hot_sales(spark)
        customer, store, team = _dims(spark)
        joined = E.enrich_customer(sales, customer)
        assert len(joined.collect()) == 60_000  # runs this plan; its adaptive form is final
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "isFinalPlan=true" in plan
        assert "skew=true" in plan

        first = M.customer_monthly_spend_from_sales(sales, customer, store, team)
        via_enrich = M.customer_monthly_spend(M.customer_extract(E.enrich(sales, customer, store, team)))
        assert first.exceptAll(via_enrich).count() == 0 and via_enrich.exceptAll(first).count() == 0
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_rank_of_a_hot_group_equals_the_window(spark):
    """A group with a third of all rows, long blocks of equal values and NULLs, over
    many more range partitions than groups."""
    from pyspark.sql import Window

    from tillflow.operators.ranking import rank_desc

    rows = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, F.lit(1)).when(F.col("id") % 50 == 1, F.lit(None))
        .otherwise(F.col("id") % 40).cast("int").alias("g"),
        F.when(F.col("id") % 11 == 0, F.lit(None)).when(F.col("id") % 2 == 0, F.lit(7))
        .otherwise(F.col("id") % 97).cast("long").alias("v"), "id")
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = rank_desc(rows, ["g"], "v", "r")
        want = rows.withColumn("r", F.rank().over(Window.partitionBy("g").orderBy(F.col("v").desc())).cast("int"))
        assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
        one = rows.select(F.lit("x").alias("g"), F.lit(1).alias("v"), "id")  # a single block
        assert {r["r"] for r in rank_desc(one, ["g"], "v", "r").collect()} == {1}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
