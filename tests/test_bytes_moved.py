"""What jobs over landed files shuffle and write, seen in their plans and folders."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from tillflow.operators import ledger as L
from tillflow.operators import monthly_sums as MS
from tillflow.plans import batch_run as B
from tillflow.plans import catalog as C
from tillflow.plans import sinks as S
from tillflow.plans.scratch import kept
from tillflow.schema import CUSTOMER_SCHEMA, SALES_TEAM_SCHEMA, STORE_SCHEMA
from tillflow.sources import files as FS


@pytest.fixture()
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield spark
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_rows_of_published_runs_are_read_without_a_shuffle(no_broadcast, tmp_dir):
    spark = no_broadcast
    for run in ("r1", "r2"):
        rows = spark.createDataFrame([(7, 3, "2001-01")], "store_id int, sales_person_id long, sales_month string")
        rows.write.partitionBy("sales_month", "store_id").parquet(f"{tmp_dir}/sales_team_extract/run_id={run}")
    files = spark.createDataFrame([("a.csv", "in/a.csv")], "file_name string, file_location string")
    L.write_events(L.close_events(files, F.current_timestamp(), "r1"), f"{tmp_dir}/ledger")
    extract = B.sales_team_extract(spark, tmp_dir)
    assert "Exchange" not in _plan(extract) and extract.count() == 1
    L.write_events(L.close_events(files, F.current_timestamp(), "r2"), f"{tmp_dir}/ledger")
    assert B.sales_team_extract(spark, tmp_dir).count() == 2


def test_headers_are_found_without_sorting_lines(spark, tmp_dir):
    os.makedirs(f"{tmp_dir}/in")
    for name in ("a.csv", "b.csv"):
        with open(f"{tmp_dir}/in/{name}", "w") as f:
            f.write("\n\nx,y\n" + "1,2\n" * 50 + "x,y\n")
    lines = FS.landed_lines(FS.text_lines(spark, f"{tmp_dir}/in"))
    headed = FS.read_headers(FS.file_manifest(spark, f"{tmp_dir}/in"), lines)
    assert "SortAggregate" not in _plan(headed)
    assert [(r["header_line"], r["header"]) for r in headed.collect()] == [("x,y", ["x", "y"])] * 2


def test_sums_are_shuffled_once_for_the_mart(no_broadcast):
    spark = no_broadcast
    dims = [spark.createDataFrame([(1, "a", "b", "x", "1", "2")], CUSTOMER_SCHEMA),
            spark.createDataFrame([(7, "s", "m")], STORE_SCHEMA),
            spark.createDataFrame([(3, "p", "q", 3, "Y", "x", "1")], SALES_TEAM_SCHEMA)]
    sums = spark.createDataFrame([(1, "2001-01", 2)], "customer_id long, sales_date_month string, amount int")
    rows = MS.customer_mart(*dims).rows(sums.withColumn("amount", sums.amount.cast(MS.AMOUNT)))
    # the sums once; the customers' rows, their attributes by customer, their counts
    assert _plan(rows).count("Exchange hashpartitioning") <= 4
    assert [r["full_name"] for r in rows.collect()] == ["a b"]


def test_refresh_keeps_no_copy_and_removes_months_without_rows(spark, tmp_dir):
    rows = spark.createDataFrame([("2001-01", 1), ("2001-02", 2), (None, 3)], "sales_month string, v long")
    S.refresh_months(rows, f"{tmp_dir}/mart", ["2001-01", "2001-02", None])
    S.refresh_months(rows.where("v = 1"), f"{tmp_dir}/mart", ["2001-01", None])
    left = S.read_partitioned(spark, f"{tmp_dir}/mart", rows.schema).collect()
    assert sorted((r["sales_month"], r["v"]) for r in left) == [("2001-01", 1), ("2001-02", 2)]


def test_two_runs_land_their_files_once(spark):
    from conftest import SF_SMALL
    from tillflow.sources import drops as DR

    root = DR.drops_root(spark, SF_SMALL) + "-only"
    with pytest.MonkeyPatch.context() as m:
        m.setattr(DR, "drops_root", lambda *_: root)
        landed = []
        land = DR.land
        m.setattr(DR, "land", lambda staged, place, some: (landed.extend(some), land(staged, place, some)))
        C.two_runs_files(spark, SF_SMALL).collect()
    assert sorted(landed) == sorted(DR.LAYOUT_BY_PRIORITY)


def test_drop_files_do_not_grow_with_the_parts_of_the_staged_table(spark, tmp_dir):
    from tillflow.sources import drops as DR

    staged = spark.range(400).selectExpr(
        "id AS customer_id", "1 AS store_id", "'pen' AS product_name", "DATE'2001-01-05' AS sales_date", "3L AS sales_person_id",
        "1.5 AS price", "2 AS quantity", "3.0 AS total_cost", "'1-URGENT' AS o_orderpriority", "0.0 AS l_discount").repartition(40)
    staged.write.parquet(f"{tmp_dir}/staged")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2k")
    spark.conf.set("spark.sql.files.openCostInBytes", "1k")
    try:
        DR.land(spark.read.parquet(f"{tmp_dir}/staged"), f"{tmp_dir}/landing", ["1-URGENT"])
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    landed = [f for f in os.listdir(f"{tmp_dir}/landing/plain_urgent") if f.endswith(".csv")]
    assert len(landed) <= spark.sparkContext.defaultParallelism < 40
    assert spark.read.option("header", True).csv(f"{tmp_dir}/landing/plain_urgent").distinct().count() == 400


def test_sums_of_a_micro_batch_are_a_file_for_each_month(spark, tmp_dir):
    from tillflow.schema import SALES_SCHEMA
    from tillflow.streaming import file_stream as ST

    people = spark.createDataFrame([(i, "a", "b", "x", "1", "2") for i in range(50)], CUSTOMER_SCHEMA)
    mart = MS.customer_mart(people, spark.createDataFrame([(7, "s", "m")], STORE_SCHEMA),
                            spark.createDataFrame([(3, "p", "q", 3, "Y", "x", "1")], SALES_TEAM_SCHEMA))
    sales = spark.range(600).selectExpr(
        "id % 50 AS customer_id", "7 AS store_id", "add_months(DATE'2001-01-05', CAST(id % 12 AS INT)) AS sales_date",
        "3L AS sales_person_id", "CAST(2 AS DECIMAL(24,6)) AS total_cost")
    sales = sales.select(*[(F.col(f.name) if f.name in sales.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in SALES_SCHEMA])
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        ST._keep_mart(spark, tmp_dir, mart, sales, 0, 50)
        ST._refresh_mart(spark, tmp_dir, mart)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    files = [f for _, _, names in os.walk(f"{tmp_dir}/customer_mart_sums/batches") for f in names if f.endswith(".parquet")]
    assert len(files) == 12
    got = spark.read.schema(mart.schema).parquet(f"{tmp_dir}/customer_mart")
    assert got.agg(F.sum("total_sales")).first()[0] == 1200


def test_kept_dimension_has_its_real_size(spark):
    a, b = (spark.range(50_000).withColumnRenamed("id", n) for n in ("a", "b"))
    joined = a.join(b, a.a == b.b)
    size = lambda df: int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    assert size(joined) > 10 << 20 > size(kept(joined, "dimension"))
