"""The driver's TPC-H-like tables seen as the retail model.

* sales       one row per line item: the order's customer, the supplier's nation
              as the store, the part as the product, the supplier as the sales person
* customer    from ``customer``;  first/last name are the two halves of ``c_name``
* store       from ``nation``
* sales_team  from ``supplier``; the smallest supplier key of a nation is its manager
* product     from ``part``

Every reader selects only the columns it needs, so the Parquet scans are pruned
(``ReadSchema``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillflow.functions.expressions import money


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _name_part(c: str, part: int):
    return F.split_part(F.col(c), F.lit("#"), F.lit(part))


def sales(spark: SparkSession, sf_dir: str, extra: tuple[str, ...] = (),
          with_product: bool = True, of_orders: tuple[Column, ...] = (),
          of_lines: tuple[Column, ...] = ()) -> DataFrame:
    """Sales facts in the mandatory-column layout.

    The product name and price are looked up in the part catalog (a left join:
    the lookup never adds or drops a sale).  With ``with_product=False`` the
    lookup is skipped and the layout lacks both columns -- the marts never read
    them, and at scale the lookup would cost a shuffle of every sale.

    ``extra`` names driver columns to carry along (used to derive the drop
    files); they are not part of the retail model.  ``of_orders`` and ``of_lines`` are
    named columns made of one order's or one line's columns, before the joins.
    """
    line_cols = ["l_orderkey", "l_partkey", "l_suppkey", "l_quantity",
                 "l_extendedprice", "l_shipdate"]
    line_cols += [c for c in extra if c.startswith("l_") and c not in line_cols]
    lineitem = table(spark, sf_dir, "lineitem").select(*line_cols, *of_lines)
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", *[c for c in extra if c.startswith("o_")], *of_orders)
    derived = [*orders.columns[len(orders.columns) - len(of_orders):], *lineitem.columns[len(line_cols):]]
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")

    j = lineitem.join(orders, lineitem.l_orderkey == orders.o_orderkey)
    product_name = price = []
    if with_product:
        part = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_retailprice")
        j = j.join(part, j.l_partkey == part.p_partkey, "left")
        product_name = [F.col("p_name").alias("product_name")]
        price = [money("p_retailprice").alias("price")]
    j = j.join(supplier, j.l_suppkey == supplier.s_suppkey)
    return j.select(
        F.col("o_custkey").alias("customer_id"),
        F.col("s_nationkey").alias("store_id"),
        *product_name,
        F.col("l_shipdate").cast("date").alias("sales_date"),
        F.col("l_suppkey").alias("sales_person_id"),
        *price,
        F.col("l_quantity").cast("int").alias("quantity"),
        money("l_extendedprice").alias("total_cost"),
        *[F.col(c) for c in (*extra, *derived)],
    )


def customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("customer_id"),
        _name_part("c_name", 1).alias("first_name"),
        _name_part("c_name", 2).alias("last_name"),
        F.col("c_mktsegment").alias("address"),
        F.col("c_nationkey").cast("string").alias("pincode"),
        F.col("c_custkey").cast("string").alias("phone_number"),
    )


def customer_with_renames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer dimension where each BUILDING-segment customer has a second row
    under an upper-cased last name (a renamed customer kept twice): two names
    for one key, at most two rows per key."""
    base = customer(spark, sf_dir)
    renamed = base.where(F.col("address") == "BUILDING").withColumn(
        "last_name", F.upper(F.concat(F.lit("x"), F.col("last_name"))))
    return base.unionByName(renamed)


def store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("id"),
        F.col("n_name").alias("address"),
        F.concat(F.lit("Manager "), F.col("n_name")).alias("store_manager_name"),
    )


def store_in_region(spark: SparkSession, sf_dir: str, region_name: str) -> DataFrame:
    """Store list of one business region (the stores one regional system knows)."""
    region = table(spark, sf_dir, "region").where(F.col("r_name") == region_name)
    nation = table(spark, sf_dir, "nation")
    keys = nation.join(region, nation.n_regionkey == region.r_regionkey,
                       "left_semi").select(F.col("n_nationkey").alias("id"))
    return store(spark, sf_dir).join(keys, "id", "left_semi")


def sales_team(spark: SparkSession, sf_dir: str) -> DataFrame:
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    # One manager per nation: an aggregate (partial per task, one row per nation),
    # not a window that would hold a whole nation in one task.
    managers = supplier.groupBy("s_nationkey").agg(F.min("s_suppkey").alias("manager_id"))
    j = supplier.join(managers, "s_nationkey")
    return j.select(
        F.col("s_suppkey").alias("id"),
        _name_part("s_name", 1).alias("first_name"),
        _name_part("s_name", 2).alias("last_name"),
        F.col("manager_id"),
        F.when(F.col("s_suppkey") == F.col("manager_id"), F.lit("Y"))
        .otherwise(F.lit("N")).alias("is_manager"),
        F.concat(F.lit("Desk "), F.col("s_suppkey").cast("string")).alias("address"),
        F.col("s_nationkey").cast("string").alias("pincode"),
    )


def product(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("id"),
        F.col("p_name").alias("name"),
        money("p_retailprice").alias("current_price"),
    )


def daily_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One sales file per order date: (file_name, file_location, day, has_partial,
    has_open) -- whether the day has partly shipped / still open orders."""
    orders = table(spark, sf_dir, "orders").select("o_orderdate", "o_orderstatus")
    days = orders.groupBy(F.col("o_orderdate").cast("date").alias("day")).agg(
        F.max((F.col("o_orderstatus") == "P").cast("int")).alias("has_partial"),
        F.max((F.col("o_orderstatus") == "O").cast("int")).alias("has_open"),
    )
    return days.select(
        F.concat(F.lit("sales_"), F.date_format("day", "yyyyMMdd"), F.lit(".csv")).alias("file_name"),
        F.concat(F.lit("landing/"), F.date_format("day", "yyyy-MM")).alias("file_location"),
        "day", "has_partial", "has_open",
    )


def daily_file_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ledger events of the daily files: every file is opened the next day; a
    day with partly shipped orders is opened again the day after (a retry); a
    day without open orders is closed on the third day."""
    from tillflow.operators.ledger import close_events, open_events

    files = daily_files(spark, sf_dir)

    def at(days: int):
        return F.date_add("day", days).cast("timestamp_ntz")

    return (open_events(files, at(1), "daily", seq=1)
            .unionByName(open_events(files.where("has_partial = 1"), at(2), "retry", seq=2))
            .unionByName(close_events(files.where("has_open = 0"), at(3), "close", seq=3)))


def files_in_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files present in the landing folder at the start of a run: the days with
    partly shipped orders (re-delivered)."""
    return daily_files(spark, sf_dir).where("has_partial = 1").select("file_name")
