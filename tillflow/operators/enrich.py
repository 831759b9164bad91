"""Enrichment of sales with customer, store and sales-person data.

Inner equi-joins, as in the retail job: a sale without a matching dimension row
is dropped from every mart (``orphan_sales`` reports those).  Dimension columns
are renamed before each join, so no name is ever ambiguous and no qualified
``drop`` is needed.  How a dimension is joined is Spark's choice by its size in
bytes (``autoBroadcastJoinThreshold``, statistics, AQE); in a shuffle join AQE
splits skewed fact partitions, so a hot customer does not end up in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# What the marts read of a sale.
FACT_COLUMNS = ["customer_id", "store_id", "sales_date", "sales_person_id", "total_cost"]


def _customer_side(customer: DataFrame) -> DataFrame:
    return customer.select("customer_id", "first_name", "last_name", "address",
                           "pincode", "phone_number")


def _store_side(store: DataFrame) -> DataFrame:
    return store.select(F.col("id").alias("store_id"),
                        F.col("address").alias("store_address"),
                        "store_manager_name")


def _sales_team_side(sales_team: DataFrame) -> DataFrame:
    return sales_team.select(
        F.col("id").alias("sales_person_id"),
        F.col("first_name").alias("sales_person_first_name"),
        F.col("last_name").alias("sales_person_last_name"),
        "manager_id",
        "is_manager",
        F.col("address").alias("sales_person_address"),
        F.col("pincode").alias("sales_person_pincode"),
    )


def enrich_customer(sales: DataFrame, customer: DataFrame) -> DataFrame:
    return sales.select(*FACT_COLUMNS).join(_customer_side(customer), "customer_id")


def enrich_store(sales: DataFrame, customer: DataFrame, store: DataFrame) -> DataFrame:
    return enrich_customer(sales, customer).join(_store_side(store), "store_id")


ENRICHED_COLUMNS = [
    "customer_id", "store_id", "sales_date", "sales_person_id", "total_cost",
    "first_name", "last_name", "address", "pincode", "phone_number",
    "store_address", "store_manager_name",
    "sales_person_first_name", "sales_person_last_name", "manager_id", "is_manager",
    "sales_person_address", "sales_person_pincode",
]


def enrich(sales: DataFrame, customer: DataFrame, store: DataFrame,
           sales_team: DataFrame) -> DataFrame:
    """Sales x customer x store x sales_team (all inner).

    Inner joins commute, so the order is chosen for scale: the sales team
    first -- it joins on the supplier key that the sales facts were last
    partitioned by, so a shuffle join there reuses that partitioning -- then
    the store, and the customer last.
    """
    j = sales.select(*FACT_COLUMNS).join(_sales_team_side(sales_team), "sales_person_id")
    j = j.join(_store_side(store), "store_id").join(_customer_side(customer), "customer_id")
    return j.select(*ENRICHED_COLUMNS)


def enrich_sales_team(sales: DataFrame, customer: DataFrame, store: DataFrame,
                      sales_team: DataFrame) -> DataFrame:
    """The rows of ``enrich`` without the customer's columns.  Only the customers' keys are
    needed, so sales meet them first, while they are narrow: the columns of the sales team
    and the store do not go through that shuffle."""
    j = sales.select(*FACT_COLUMNS).join(customer.select("customer_id"), "customer_id")
    j = j.join(_sales_team_side(sales_team), "sales_person_id").join(_store_side(store), "store_id")
    return j.select(*[c for c in ENRICHED_COLUMNS if c in j.columns])


def orphan_sales(sales: DataFrame, customer: DataFrame, store: DataFrame,
                 sales_team: DataFrame) -> DataFrame:
    """Sales that the inner joins of ``enrich`` drop, with the missing sides marked.

    The keys that sales carry are reduced to distinct ones before they meet a
    dimension; only keys that it lacks (few, or none) are joined back.
    """
    checks = [
        (customer.select(F.col("customer_id").alias("k")), "customer_id", "missing_customer"),
        (store.select(F.col("id").alias("k")), "store_id", "missing_store"),
        (sales_team.select(F.col("id").alias("k")), "sales_person_id", "missing_sales_person"),
    ]
    out = sales
    for dim, key, flag in checks:
        used = sales.select(F.col(key).alias("k")).distinct()
        lacking = used.join(dim, "k", "left_anti").withColumn(flag, F.lit(True))
        out = (out.join(lacking, out[key].eqNullSafe(lacking["k"]), "left").drop("k")
               .withColumn(flag, F.coalesce(flag, F.lit(False))))
    return out.where(F.col("missing_customer") | F.col("missing_store")
                     | F.col("missing_sales_person"))
