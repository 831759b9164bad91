"""availableNow stream (each file once, archive), sinks, snapshots, refresh."""

from __future__ import annotations

import datetime as dt
import os
from decimal import Decimal as D

from pyspark.sql import functions as F

from tillflow.operators import ledger as L
from tillflow.plans import sinks as S
from tillflow.streaming import file_stream as ST

HEADER = "customer_id,store_id,product_name,sales_date,sales_person_id,price,quantity,total_cost"


def _drop(folder, name, lines):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as f:
        f.write("\n".join([HEADER] + lines) + "\n")


def test_stream_processes_each_file_once(spark, tmp_dir):
    landing, out, ckpt = (os.path.join(tmp_dir, x) for x in ("landing", "out", "ckpt"))
    archive = os.path.join(tmp_dir, "archive")
    _drop(landing, "d1.csv", ["1,7,pen,2001-01-05,3,1.50,2,3.00"])
    _drop(landing, "d2.csv", ["2,7,ink,2001-01-06,3,2.00,1,2.00"])
    ST.ingest_available_now(spark, landing, out, ckpt, archive_dir=archive)
    assert ST.ingested_sales(spark, out).count() == 2

    _drop(landing, "d3.csv", ["3,7,cup,2001-01-07,3,4.00,1,4.00"])
    ST.ingest_available_now(spark, landing, out, ckpt, archive_dir=archive)
    got = sorted(r["customer_id"] for r in ST.ingested_sales(spark, out).collect())
    assert got == [1, 2, 3]  # no file twice

    ST.ingest_available_now(spark, landing, out, ckpt, archive_dir=archive)
    assert ST.ingested_sales(spark, out).count() == 3  # nothing new, nothing repeated

    ledger = spark.read.parquet(os.path.join(out, "ledger"))
    status = {r["file_name"]: r["status"] for r in L.current_status(ledger).collect()}
    assert status == {"d1.csv": "I", "d2.csv": "I", "d3.csv": "I"}
    archived = [f for _, _, fs in os.walk(archive) for f in fs if f.endswith(".csv")]
    assert set(archived) >= {"d1.csv", "d2.csv"}  # moved by a later run


def _facts(spark):
    rows = [(7, 3, "2001-01", D("1.00")), (7, 4, "2001-01", D("2.00")),
            (8, 5, "2001-02", D("3.00"))]
    return spark.createDataFrame(rows, "store_id int, sales_person_id long, sales_month string, "
                                       "total_cost decimal(18,2)")


def test_partitioned_write_prunes_on_read(spark, tmp_dir):
    df = _facts(spark)
    path = os.path.join(tmp_dir, "mart")
    S.write_partitioned(df, path, ["sales_month", "store_id"])
    back = S.read_partitioned(spark, path, df.schema)
    q = back.where((F.col("sales_month") == "2001-01") & (F.col("store_id") == 7))
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "2001-01" in plan
    assert q.count() == 2
    folders = sorted(f for f in os.listdir(path) if not f.startswith(("_", ".")))
    assert folders == ["sales_month=2001-01", "sales_month=2001-02"]


def test_refresh_replaces_only_touched_months(spark, tmp_dir):
    path = os.path.join(tmp_dir, "monthly")
    undated = spark.createDataFrame([(7, 3, None, D("4.00"))], _facts(spark).schema)
    S.refresh_months(_facts(spark).unionByName(undated), path, ["2001-01", "2001-02", None])
    newer = spark.createDataFrame([(7, 3, "2001-01", D("9.00"))], _facts(spark).schema)
    S.refresh_months(newer, path, ["2001-01"])

    def months():
        return sorted(((r["sales_month"], r["total_cost"]) for r in
                       S.read_partitioned(spark, path, newer.schema).collect()), key=str)

    assert months() == [("2001-01", D("9.00")), ("2001-02", D("3.00")), (None, D("4.00"))]
    # touched months of which nothing is left are removed, the undated one too
    S.refresh_months(newer, path, ["2001-01", "2001-02", None])
    assert months() == [("2001-01", D("9.00"))]


def test_overwrite_leaves_no_old_partition(spark, tmp_dir):
    path = os.path.join(tmp_dir, "mart")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        S.write_partitioned(_facts(spark), path, ["sales_month"])
        S.write_partitioned(_facts(spark).where("sales_month = '2001-02'"), path, ["sales_month"])
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")
    assert [r["sales_month"] for r in S.read_partitioned(spark, path, _facts(spark).schema).collect()] == ["2001-02"]


def test_month_refresh_keeps_undated_sales_and_reads_touched_months_only(spark, tmp_dir):
    out = os.path.join(tmp_dir, "out")
    landing, ckpt = os.path.join(tmp_dir, "landing"), os.path.join(tmp_dir, "ckpt")
    _drop(landing, "d1.csv", ["1,7,pen,2001-01-05,3,1.50,2,3.00", "1,7,pen,,3,1.50,2,5.00"])
    ST.ingest_available_now(spark, landing, out, ckpt)
    undated = ST.touched_facts(spark, out, [None])
    assert [r["total_cost"] for r in undated.collect()] == [D("5.000000")]
    plan = ST.touched_facts(spark, out, ["2001-01"])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "2001-01" in plan.split("PartitionFilters")[1][:120]


def test_first_batch_without_a_csv_file_is_quarantined(spark, tmp_dir):
    landing, out, ckpt = (os.path.join(tmp_dir, x) for x in ("landing", "out", "ckpt"))
    os.makedirs(landing)
    with open(os.path.join(landing, "a.json"), "w") as f:
        f.write("{}\n")

    def build(sales):
        return (sales.groupBy("customer_id", F.date_format("sales_date", "yyyy-MM").alias("sales_date_month"))
                .agg(F.sum("total_cost").alias("total")))

    ST.ingest_available_now(spark, landing, out, ckpt, mart_builder=build)
    rejected = spark.read.parquet(os.path.join(out, "quarantine")).collect()
    assert [(r["reason"], r["record_count"]) for r in rejected] == [("NOT_CSV", 1)]
    _drop(landing, "d1.csv", ["1,7,pen,2001-01-05,3,1.50,2,3.00"])
    ST.ingest_available_now(spark, landing, out, ckpt, mart_builder=build)
    assert ST.ingested_sales(spark, out).count() == 1


def test_batch_run_leaves_no_open_file_and_can_be_repeated(spark, tmp_dir):
    from tillflow.plans import batch_run as B
    from tillflow.schema import CUSTOMER_SCHEMA, SALES_TEAM_SCHEMA, STORE_SCHEMA

    landing, out = os.path.join(tmp_dir, "landing"), os.path.join(tmp_dir, "out")
    _drop(landing, "d1.csv", ["1,7,pen,2001-01-05,3,1.50,2,3.005", "1,7,pen,2001-01-06,4,1.50,2,9.00"])
    dims = [spark.createDataFrame([(1, "a", "b", "x", "1", "2")], CUSTOMER_SCHEMA),
            spark.createDataFrame([(7, "s", "m")], STORE_SCHEMA),
            spark.createDataFrame([(3, "p", "q", 3, "Y", "x", "1"), (4, "r", "s", 3, "N", "x", "1")], SALES_TEAM_SCHEMA)]
    for _ in range(2):
        B.run_batch(spark, landing, out, *dims, run_id="r1")
        mart = {r["sales_person_id"]: (r["total_sales"], r["incentive"]) for r in B.sales_team_mart(spark, out).collect()}
        assert mart == {3: (D("3.01"), D("0.00")), 4: (D("9.00"), D("0.09"))}
        assert [r["total_sales"] for r in B.customer_mart(spark, out).collect()] == [D("12.01")]
    ledger = L.read_events(spark, f"{out}/ledger")
    assert ledger.count() == 2 and B.left_over(spark, landing, out).count() == 0
    L.write_events(L.open_events(spark.createDataFrame([("d1.csv", "x")], "file_name string, file_location string"),
                                 F.current_timestamp(), "r2"), f"{out}/ledger")
    assert [r["file_name"] for r in B.left_over(spark, landing, out).collect()] == ["d1.csv"]


def test_latest_snapshot(spark, tmp_dir):
    root = os.path.join(tmp_dir, "snaps")
    S.write_snapshot(_facts(spark), root, run_id=100)
    S.write_snapshot(_facts(spark).limit(1), root, run_id=200)
    latest = S.read_latest(spark, root)
    assert latest.count() == 1 and "run_id" not in latest.columns


def test_parquet_roundtrip_keeps_types(spark, tmp_dir):
    df = _facts(spark).withColumn("d", F.lit(dt.date(2001, 1, 1)))
    path = os.path.join(tmp_dir, "flat")
    S.write_mart(df, path)
    back = spark.read.parquet(path)
    # Parquet marks every column nullable on read; names and types are kept.
    assert [(f.name, f.dataType) for f in back.schema] == [(f.name, f.dataType) for f in df.schema]
    assert sorted(back.collect()) == sorted(df.collect())


def test_stream_keeps_mart_equal_to_batch(spark, tmp_dir):
    from tillflow.operators import marts as M

    landing, out, ckpt = (os.path.join(tmp_dir, x) for x in ("landing", "out", "ckpt"))
    # three files, one per micro-batch; January is touched by two of them
    _drop(landing, "d1.csv", ["1,7,pen,2001-01-05,3,1.50,2,3.00", "2,7,pen,2001-02-05,3,1.50,2,3.00"])
    _drop(landing, "d2.csv", ["1,7,ink,2001-01-20,3,2.00,1,2.00"])
    _drop(landing, "d3.csv", ["3,8,cup,2001-03-01,4,4.00,1,4.00"])

    def build(sales):
        return (sales.groupBy("customer_id", M.month_of("sales_date").alias("sales_date_month"))
                .agg(F.sum("total_cost").cast("decimal(18,2)").alias("total")))

    ST.ingest_available_now(spark, landing, out, ckpt, max_files_per_batch=1, mart_builder=build)
    schema = build(ST.ingested_sales(spark, out)).schema
    got = sorted(tuple(r) for r in ST.stream_mart(spark, out, schema).select(*schema.fieldNames()).collect())
    want = sorted(tuple(r) for r in build(ST.ingested_sales(spark, out)).collect())
    assert got == want
    assert (1, "2001-01", D("5.00")) in got


def test_ledger_events_of_a_batch_are_replaced_on_replay(spark, tmp_dir):
    out = os.path.join(tmp_dir, "out")
    files = spark.createDataFrame([("a.csv", "p/a.csv")], "file_name string, file_location string")
    for _ in range(2):  # the same micro-batch twice
        L.write_events(L.open_events(files, F.current_timestamp(), "batch-0", seq=1), f"{out}/ledger")
        L.write_events(L.close_events(files, F.current_timestamp(), "batch-0", seq=2), f"{out}/ledger")
    ledger = L.read_events(spark, os.path.join(out, "ledger"))
    assert ledger.count() == 2
    assert [(r["status"], r["event_count"]) for r in L.current_status(ledger).collect()] == [("I", 2)]


def test_preview_is_a_limit(spark):
    df = spark.range(100)
    assert S.preview(df).count() == 20 and S.preview(df, 5).count() == 5
