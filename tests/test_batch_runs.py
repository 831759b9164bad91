"""Runs over a growing landing folder: what is taken, what is kept, what is moved."""

from __future__ import annotations

import os
import time
from decimal import Decimal as D

import pytest

from tillflow.operators import ledger as L
from tillflow.plans import archive as A
from tillflow.plans import batch_run as B
from tillflow.plans import catalog_tables as CT
from tillflow.plans import sinks as S
from tillflow.schema import CUSTOMER_SCHEMA, SALES_TEAM_SCHEMA, STORE_SCHEMA

HEADER = "customer_id,store_id,product_name,sales_date,sales_person_id,price,quantity,total_cost"


def drop(folder, name, lines, header=HEADER):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as f:
        f.write("\n".join([header] + lines) + "\n")


@pytest.fixture()
def place(spark, tmp_dir):
    dims = [spark.createDataFrame([(1, "a", "b", "x", "1", "2"), (2, "c", "d", "y", "3", "4")], CUSTOMER_SCHEMA),
            spark.createDataFrame([(7, "s", "m")], STORE_SCHEMA),
            spark.createDataFrame([(3, "p", "q", 3, "Y", "x", "1"), (4, "r", "s", 3, "N", "x", "1")], SALES_TEAM_SCHEMA)]

    class Place:
        landing, out, archive = (os.path.join(tmp_dir, x) for x in ("landing", "out", "archive"))

        def run(self, run_id, archive=True, **options):
            B.run_batch(spark, self.landing, self.out, *dims, run_id=run_id,
                        archive=self.archive if archive else None, **options)

        def spend(self):
            return {(r["customer_id"], r["sales_date_month"]): r["total_sales"]
                    for r in B.customer_mart(spark, self.out).collect()}

        def incentives(self):
            return {(r["sales_person_id"], r["sales_month"]): (r["total_sales"], r["incentive"])
                    for r in B.sales_team_mart(spark, self.out).collect()}

        def files(self, folder):
            return sorted(os.path.relpath(os.path.join(d, f), folder) for d, _, fs in os.walk(folder) for f in fs
                          if not f.startswith("."))

    return Place()


def test_two_runs_equal_one_run_over_both(spark, place):
    drop(place.landing, "d1.csv", ["1,7,pen,2001-01-05,3,1.50,2,3.005", "2,7,pen,2001-02-05,3,1.50,2,1.00"])
    place.run("r1")
    drop(f"{place.landing}/late", "d2.csv", ["1,7,pen,2001-01-06,4,1.50,2,3.004", "2,7,pen,2001-03-01,3,1.50,2,5.00"])
    place.run("r2")
    # January: 3.005 + 3.004 rounded once; its top seller is found over both runs
    assert place.spend() == {(1, "2001-01"): D("6.01"), (2, "2001-02"): D("1.00"), (2, "2001-03"): D("5.00")}
    assert place.incentives()[3, "2001-01"] == (D("3.01"), D("0.03"))
    assert place.incentives()[4, "2001-01"] == (D("3.00"), D("0.00"))
    assert B.customer_extract(spark, place.out).count() == B.sales_team_extract(spark, place.out).count() == 4
    assert place.files(place.landing) == []
    assert place.files(place.archive) == ["processed/r1/d1.csv", "processed/r2/late/d2.csv"]
    before = (place.spend(), place.files(place.archive))
    place.run("r2")  # the same run again, and one that finds nothing
    place.run("r3")
    assert (place.spend(), place.files(place.archive)) == before


def test_sums_of_a_run_are_not_a_file_for_each_month(spark, place):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        drop(place.landing, "d1.csv", [f"{1 + i % 2},7,pen,20{i:02}-01-05,3,1.50,2,1.25" for i in range(40)] + ["1,7,pen,,3,1.50,2,2.00"])
        place.run("r1")
        tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
        for mart in ("customer_mart", "sales_team_mart"):
            assert sum(f.endswith(".parquet") for f in place.files(f"{place.out}/{mart}_sums")) <= tasks
        drop(place.landing, "d2.csv", ["1,7,pen,2000-01-09,3,1.50,2,0.50", "1,7,pen,,3,1.50,2,2.00"])
        place.run("r2")
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    spend = place.spend()
    assert len(spend) == 41 and spend[1, "2000-01"] == D("1.75") and spend[2, "2039-01"] == D("1.25") and spend[1, None] == D("4.00")


def test_closed_files_are_skipped_and_open_ones_taken_up_without_an_archive(spark, place):
    drop(place.landing, "d1.csv", ["1,7,pen,2001-01-05,3,1.50,2,3.00"])
    place.run("r1", archive=False)
    drop(place.landing, "d2.csv", ["1,7,pen,2001-01-06,3,1.50,2,2.00"])
    assert [r["file_name"] for r in B.files_of_run(spark, place.landing, place.out).collect()] == ["d2.csv"]
    place.run("r2", archive=False)
    assert place.spend() == {(1, "2001-01"): D("5.00")}
    assert B.files_of_run(spark, place.landing, place.out).count() == 0
    with pytest.raises(Exception, match="no CSV file"):
        place.run("r3", archive=False, strict=True)


def test_run_that_broke_off_before_its_commit_counts_once(spark, place, monkeypatch):
    drop(place.landing, "d1.csv", ["1,7,pen,2001-01-05,3,1.50,2,3.00", "bad,7,pen,2001-01-05,3,1.50,2,3.00"])
    drop(place.landing, "note.txt", ["x"])

    def lost(*args, **kwargs):
        raise RuntimeError("executors lost")

    with monkeypatch.context() as m:
        m.setattr(L, "close_events", lost)
        with pytest.raises(RuntimeError):
            place.run("r1")
    assert [r["file_name"] for r in B.left_over(spark, place.landing, place.out).collect()] == ["d1.csv"]
    assert B.customer_extract(spark, place.out).count() == 0  # written, not published
    place.run("r2")
    assert place.spend() == {(1, "2001-01"): D("3.00")}
    assert B.left_over(spark, place.landing, place.out).count() == 0
    assert sorted(r["reason"] for r in B.quarantine(spark, place.out).collect()) == ["CORRUPT_ROW", "NOT_CSV"]
    assert place.files(place.archive) == ["processed/r2/d1.csv", "rejected/r1/note.txt"]


def test_run_that_broke_off_after_its_commit_is_ended_by_the_next(spark, place, monkeypatch):
    drop(place.landing, "d1.csv", ["1,7,pen,2001-01-05,3,1.50,2,3.00"])

    def lost(*args, **kwargs):
        raise RuntimeError("executors lost")

    with monkeypatch.context() as m:
        m.setattr(B, "refresh_marts", lost)
        with pytest.raises(RuntimeError):
            place.run("r1")
    drop(place.landing, "d2.csv", ["2,7,pen,2001-04-05,3,1.50,2,1.00"])
    place.run("r2")
    assert place.spend() == {(1, "2001-01"): D("3.00"), (2, "2001-04"): D("1.00")}
    assert place.files(place.archive) == ["processed/r1/d1.csv", "processed/r2/d2.csv"]


def test_file_delivered_anew_under_its_name_is_new(spark, place):
    drop(place.landing, "d1.csv", ["1,7,pen,2001-01-05,3,1.50,2,3.00"])
    place.run("r1")
    time.sleep(0.1)
    drop(place.landing, "d1.csv", ["1,7,pen,2001-01-09,3,1.50,2,4.00"])
    place.run("r2")
    assert place.spend() == {(1, "2001-01"): D("7.00")}
    assert place.files(place.archive) == ["processed/r1/d1.csv", "processed/r2/d1.csv"]


def test_rejected_files_are_judged_once(spark, place):
    drop(place.landing, "short.csv", ["1,7"], header="customer_id,store_id")
    for run in ("r1", "r2"):
        place.run(run, archive=False)
    assert [(r["reason"], r["run_id"]) for r in B.quarantine(spark, place.out).collect()] == [("MISSING_COLUMNS", "r1")]
    place.run("r3")
    assert place.files(place.archive) == ["rejected/r1/short.csv"]


def test_move_ends_what_a_lost_task_left(tmp_dir):
    source, target = os.path.join(tmp_dir, "in", "ä b%1.csv"), os.path.join(tmp_dir, "arch", "r 1", "ä b%1.csv")
    drop(os.path.dirname(source), "ä b%1.csv", ["x"])
    assert A.move(f"file:{source}", target) == A.MOVED and os.path.exists(target)
    assert A.move(f"file:{source}", target) == A.WAS_MOVED
    drop(os.path.dirname(source), "ä b%1.csv", ["x"])  # copied, not yet deleted
    assert A.move(source, f"file://{target}") == A.MOVED and not os.path.exists(source)
    drop(os.path.dirname(source), "ä b%1.csv", ["x", "y"])  # the target is not whole
    assert A.move(source, target) == A.MOVED and open(target).read().endswith("y\n")
    assert A.move(f"{source}.none", f"{target}.none") == A.GONE


def test_snapshots_are_seen_when_published(spark, tmp_dir):
    root = os.path.join(tmp_dir, "snaps")
    df = spark.createDataFrame([(1, D("2.50"))], "a long, b decimal(18,2)")
    with pytest.raises(LookupError):
        S.read_latest(spark, root)
    S.write_snapshot(df, root, run_id=100)
    df.write.parquet(f"{root}/rows/run_id=300")  # a snapshot that was broken off
    assert S.read_latest(spark, root).collect() == df.collect()
    S.write_snapshot(df.where("false"), root, run_id=200)
    empty = S.read_latest(spark, root)
    assert empty.count() == 0 and empty.schema.simpleString() == df.schema.simpleString()
    S.write_snapshot(df.unionAll(df), root, run_id=400)
    assert S.drop_old_snapshots(spark, root, keep=2) == [100]
    assert {r["run_id"]: r["n_rows"] for r in S.published_snapshots(spark, root).collect()} == {200: 0, 400: 2}
    assert S.read_latest(spark, root).count() == 2


def test_refresh_computes_its_rows_once(spark, tmp_dir):
    path = os.path.join(tmp_dir, "mart")
    seen = spark.sparkContext.accumulator(0)

    def watch(parts):
        for part in parts:
            seen.add(part.num_rows)
            yield part

    rows = spark.createDataFrame([("2001-01", 1), ("2001-02", 2), (None, 3)], "sales_month string, v long")
    S.refresh_months(rows.mapInArrow(watch, rows.schema), path, ["2001-01", "2001-02", "2001-03", None])
    assert seen.value == 3 and S.read_partitioned(spark, path, rows.schema).count() == 3


def test_catalog_tables_by_sql(spark, tmp_dir):
    db = f"shop_{os.path.basename(tmp_dir).replace('-', '_')}"
    CT.create(spark, db, tmp_dir)
    assert {r["tableName"] for r in spark.sql(f"SHOW TABLES IN {db}").collect()} == set(CT.TABLES)
    CT.insert_values(spark, db, "customer", ["customer_id", "first_name", "last_name", "address", "phone_number"],
                     [(1, "O'Neil", "b", "x", "2"), (2, "c", "d", "y", "4")])
    CT.insert_values(spark, db, "store", ["id", "address"], [(7, "s")])
    CT.insert_values(spark, db, "sales_team", ["id", "first_name", "last_name"], [(3, "p", "q"), (4, "r", "s")])
    sales = spark.createDataFrame([(1, 7, "2001-01-05", 3, "3.005"), (1, 7, "2001-01-06", 4, "3.005"),
                                   (9, 7, "2001-01-06", 4, "9")],
                                  "customer_id long, store_id int, sales_date string, sales_person_id long, total_cost string")
    CT.insert(sales, db, "sales")
    for _ in range(2):  # a statement that is run again replaces its rows
        CT.build_marts(spark, db)
    mart = spark.sql(f"SELECT full_name, sales_date_month, total_sales FROM {db}.customers_data_mart").collect()
    assert [tuple(r) for r in mart] == [("O'Neil b", "2001-01", D("6.01"))]
    top = spark.sql(f"SELECT sales_person_id, total_sales, incentive FROM {db}.sales_team_data_mart "
                    "WHERE sales_month = '2001-01' AND store_id = 7 ORDER BY 1").collect()
    assert [tuple(r) for r in top] == [(3, D("3.01"), D("0.03")), (4, D("3.01"), D("0.03"))]
    spark.sql(f"DROP DATABASE {db} CASCADE")


def test_store_filter_prunes_the_marts_folders(spark):
    from conftest import SF_SMALL

    import __spark_entry__ as entry

    plan = entry.queries()["mart_of_some_stores"](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan
