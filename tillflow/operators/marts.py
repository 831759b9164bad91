"""Extracts and monthly marts.

The retail job sums over a key with a window and then removes duplicate
(key, attributes, total) rows.  Catalyst keeps that as Sort + Window + two
aggregates over every fact row.  Here the same result is built as

1. ``groupBy(key + attributes).sum`` -- partial aggregation before the
   shuffle, so a hot customer or store costs one row per task, not one row
   per sale;
2. ``sum(part) over (partition by key)`` on the reduced rows, which holds the
   case of a key with several attribute rows (two names for one customer): each
   of them carries the key's whole total, as in the original.

The top-seller incentive compares each total with the maximum of its store and
month (an aggregate joined back) instead of a rank window, so no store-month
group is ever collected into one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillflow.functions.expressions import full_name, incentive, money, month_of
from tillflow.schema import CUSTOMER_EXTRACT_COLUMNS, SALES_TEAM_EXTRACT_COLUMNS


def customer_extract(enriched: DataFrame) -> DataFrame:
    return enriched.select(*CUSTOMER_EXTRACT_COLUMNS)


def sales_team_extract(enriched: DataFrame) -> DataFrame:
    return enriched.withColumn("sales_month", month_of("sales_date")).select(
        *SALES_TEAM_EXTRACT_COLUMNS)


def _total_over_key(df: DataFrame, key: list[str], attrs: list[str],
                    amount: str = "total_cost") -> DataFrame:
    parts = df.groupBy(*key, *attrs).agg(F.sum(amount).alias("_part"))
    w = Window.partitionBy(*key)
    return parts.select(*key, *attrs, money(F.sum("_part").over(w)).alias("total_sales"))


def customer_monthly_spend(extract: DataFrame) -> DataFrame:
    """(customer_id, full_name, address, phone_number, sales_date_month, total_sales)."""
    df = extract.select(
        "customer_id",
        full_name("first_name", "last_name").alias("full_name"),
        "address",
        "phone_number",
        month_of("sales_date").alias("sales_date_month"),
        "total_cost",
    )
    out = _total_over_key(df, ["customer_id", "sales_date_month"],
                          ["full_name", "address", "phone_number"])
    return out.select("customer_id", "full_name", "address", "phone_number",
                      "sales_date_month", "total_sales")


def salesperson_monthly_sales(extract: DataFrame) -> DataFrame:
    """(store_id, sales_person_id, full_name, sales_month, total_sales)."""
    df = extract.select(
        "store_id",
        "sales_person_id",
        full_name("sales_person_first_name", "sales_person_last_name").alias("full_name"),
        F.col("sales_month"),
        "total_cost",
    )
    out = _total_over_key(df, ["store_id", "sales_person_id", "sales_month"], ["full_name"])
    return out.select("store_id", "sales_person_id", "full_name", "sales_month", "total_sales")


def sales_rank(monthly: DataFrame) -> DataFrame:
    """Rank by total within store and month: ties share a rank and leave a gap,
    NULL totals come last.  A group has a row for each person of the store, so a
    window holds the staff of one store; groups of any size are ranked by
    ``operators.ranking``."""
    order = Window.partitionBy("store_id", "sales_month").orderBy(F.col("total_sales").desc_nulls_last())
    return monthly.withColumn("sales_rank", F.rank().over(order))


def top_seller_incentive(monthly: DataFrame) -> DataFrame:
    """Adds ``incentive``: 1% of the total, in cents rounded half up, for every
    person whose total is the highest of the store and month (all of them on a
    tie); 0 for the others.  If every total of a store-month is NULL, all its
    rows are top and their incentive is NULL -- exactly what ``rank() == 1``
    gives."""
    tops = monthly.groupBy("store_id", "sales_month").agg(
        F.max("total_sales").alias("_top"),
    ).withColumnRenamed("store_id", "_store").withColumnRenamed("sales_month", "_month")
    j = monthly.join(
        tops,
        monthly["store_id"].eqNullSafe(F.col("_store"))
        & monthly["sales_month"].eqNullSafe(F.col("_month")),
    )
    is_top = (F.col("total_sales") == F.col("_top")) | F.col("_top").isNull()
    return j.select("store_id", "sales_person_id", "full_name", "sales_month",
                    "total_sales", incentive("total_sales", is_top).alias("incentive"))


def daily_store_sales(enriched: DataFrame) -> DataFrame:
    """Daily totals per store (the daily dataset next to the monthly ones)."""
    return enriched.groupBy("store_id", "sales_date").agg(
        money(F.sum("total_cost")).alias("total_sales"),
        F.count(F.lit(1)).alias("sales_count"),
    )


def product_monthly_sales(sales: DataFrame, product: DataFrame,
                          key: str = "product_id") -> DataFrame:
    """Units and revenue per product name and month, with the product's list
    price.  Sales are summed per product key and month before they meet the
    product table, so a sale is never shuffled towards it; several products can
    share a name, whose list price is the highest of theirs."""
    monthly = sales.groupBy(F.col(key).alias("id"), month_of("sales_date").alias("sales_month")).agg(
        F.sum("quantity").alias("_units"), F.sum("total_cost").alias("_revenue"))
    by_name = product.groupBy(F.col("name").alias("_name")).agg(
        F.max("current_price").alias("list_price"))
    named = monthly.join(product.select("id", F.col("name").alias("product_name")), "id")
    sums = named.groupBy("product_name", "sales_month").agg(
        F.sum("_units").alias("units"), money(F.sum("_revenue")).alias("revenue"))
    return sums.join(by_name, F.col("product_name") == F.col("_name")).drop("_name")


# --- marts straight from sales ---------------------------------------------------
#
# The inner joins of ``enrich`` enter as weights -- each sale counts once per
# matching row of every dimension (0 drops it, 2 doubles it) -- so the totals
# equal the sums over the enriched rows, duplicate dimension keys included, and a
# join carries a key and a count instead of a dimension's columns.  The customer
# mart is summed per customer and month before it meets the customer table.  The
# other marts meet the customers' counts first, in one exchange by customer, and
# are then summed to (store, person, month) or (store, day): sums per customer as
# well would keep nearly every sale, so they are not made.  A customer holding a
# third of all sales is split by AQE's skew join.  The same plan serves every
# size; how each join runs is left to statistics and AQE.

def _key_counts(dim: DataFrame, key: str, as_name: str, count_name: str) -> DataFrame:
    return dim.groupBy(F.col(key).alias(as_name)).agg(F.count(F.lit(1)).alias(count_name))


def _attribute_rows(dim: DataFrame, key: str, as_name: str, attrs: list) -> DataFrame:
    """Distinct attribute rows per key, each with the key's row count."""
    counts = _key_counts(dim, key, as_name, "_rows")
    variants = dim.select(F.col(key).alias(as_name), *attrs).distinct()
    return variants.join(counts, as_name)


def customer_month_sums(sales: DataFrame, store: DataFrame, sales_team: DataFrame) -> DataFrame:
    """(customer_id, sales_date_month, amount) of sales with a store and a sales person."""
    facts = sales.select("customer_id", "store_id", "sales_person_id",
                         month_of("sales_date").alias("sales_date_month"), "total_cost")
    facts = facts.join(_key_counts(store, "id", "store_id", "_ns"), "store_id")
    facts = facts.join(_key_counts(sales_team, "id", "sales_person_id", "_nt"), "sales_person_id")
    return facts.groupBy("customer_id", "sales_date_month").agg(
        F.sum(F.col("total_cost") * (F.col("_ns") * F.col("_nt"))).alias("amount"))


def customer_spend_of_sums(sums: DataFrame, customer: DataFrame) -> DataFrame:
    people = _attribute_rows(customer, "customer_id", "customer_id", [
        full_name("first_name", "last_name").alias("full_name"), "address", "phone_number"])
    j = sums.join(people, "customer_id")
    return j.select("customer_id", "full_name", "address", "phone_number", "sales_date_month",
                    money(F.col("amount") * F.col("_rows")).alias("total_sales"))


def customer_monthly_spend_from_sales(sales: DataFrame, customer: DataFrame, store: DataFrame,
                                      sales_team: DataFrame) -> DataFrame:
    """Same rows as ``customer_monthly_spend(customer_extract(enrich(...)))``."""
    return customer_spend_of_sums(customer_month_sums(sales, store, sales_team), customer)


def salesperson_month_sums(sales: DataFrame, customer: DataFrame, store: DataFrame) -> DataFrame:
    """(store_id, sales_person_id, sales_month, amount) of sales with a customer and a store."""
    facts = sales.select("customer_id", "store_id", "sales_person_id",
                         month_of("sales_date").alias("sales_month"), "total_cost")
    facts = facts.join(_key_counts(store, "id", "store_id", "_ns"), "store_id")
    facts = facts.join(_key_counts(customer, "customer_id", "customer_id", "_nc"), "customer_id")
    return facts.groupBy("store_id", "sales_person_id", "sales_month").agg(
        F.sum(F.col("total_cost") * (F.col("_nc") * F.col("_ns"))).alias("amount"))


def salesperson_sales_of_sums(sums: DataFrame, sales_team: DataFrame) -> DataFrame:
    people = _attribute_rows(sales_team, "id", "sales_person_id", [
        full_name("first_name", "last_name").alias("full_name")])
    j = sums.join(people, "sales_person_id")
    return j.select("store_id", "sales_person_id", "full_name", "sales_month",
                    money(F.col("amount") * F.col("_rows")).alias("total_sales"))


def salesperson_monthly_sales_from_sales(sales: DataFrame, customer: DataFrame, store: DataFrame,
                                         sales_team: DataFrame) -> DataFrame:
    """Same rows as ``salesperson_monthly_sales(sales_team_extract(enrich(...)))``."""
    return salesperson_sales_of_sums(salesperson_month_sums(sales, customer, store), sales_team)


def daily_store_sales_from_sales(sales: DataFrame, customer: DataFrame, store: DataFrame,
                                 sales_team: DataFrame) -> DataFrame:
    """Same rows as ``daily_store_sales(enrich(...))``; the count is weighted the same way."""
    facts = sales.select("customer_id", "store_id", "sales_person_id", "sales_date", "total_cost")
    facts = facts.join(_key_counts(store, "id", "store_id", "_ns"), "store_id")
    facts = facts.join(_key_counts(sales_team, "id", "sales_person_id", "_nt"), "sales_person_id")
    facts = facts.join(_key_counts(customer, "customer_id", "customer_id", "_nc"), "customer_id")
    weight = F.col("_nc") * F.col("_ns") * F.col("_nt")
    return facts.groupBy("store_id", "sales_date").agg(
        money(F.sum(F.col("total_cost") * weight)).alias("total_sales"),
        F.sum(weight).alias("sales_count"),
    )
