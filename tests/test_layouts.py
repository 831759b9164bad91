"""Parsing by position: any number of layouts, values typed as the CSV reader types them."""

from __future__ import annotations

import os
import random
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillflow.operators import marts as M
from tillflow.operators import monthly_sums as MS
from tillflow.plans import sinks as S
from tillflow.schema import CUSTOMER_SCHEMA, MANDATORY_COLUMNS, MANDATORY_TYPES, SALES_TEAM_SCHEMA, STORE_SCHEMA
from tillflow.sources import files as FS
from tillflow.streaming import file_stream as ST

ROW = {"customer_id": "1", "store_id": "7", "product_name": "pen", "sales_date": "2001-01-05", "sales_person_id": "3",
       "price": "1.50", "quantity": "2", "total_cost": "3.00"}


def write_layouts(folder, n, seed=0):
    """Files whose columns differ in order and in their extra columns."""
    rnd = random.Random(seed)
    os.makedirs(folder)
    for k in range(n):
        header = MANDATORY_COLUMNS + [f"extra_{k}", f"more_{k}"][:rnd.randint(1, 2)]
        rnd.shuffle(header)
        line = [ROW.get(c, f"x{k}" if c.startswith("extra") else "") for c in header]
        with open(os.path.join(folder, f"f{k}.csv"), "w") as f:
            f.write(",".join(header) + "\n" + ",".join(line) + "\n")


def plan_size(df):
    return len(df._jdf.queryExecution().optimizedPlan().toString())


def test_plan_does_not_grow_with_layouts(spark, tmp_dir):
    sizes = []
    for n in (5, 2000):
        folder = os.path.join(tmp_dir, f"landing{n}")
        write_layouts(folder, n)
        lines = FS.landed_lines(FS.text_lines(spark, folder))
        files = FS.judged(FS.file_manifest(spark, folder), lines)
        staged = FS.stage(lines, files)
        sizes.append(plan_size(staged))
        plan = staged._jdf.queryExecution().executedPlan().toString()
        assert "FileScan text" not in plan  # the files were read once, by landed_lines
        rows = FS.sales_rows(staged).collect()
        assert len(rows) == n and {r["total_cost"] for r in rows} == {D("3.000000")}
        assert sorted(r["additional_column"] for r in rows) == sorted(f"x{k}" for k in range(n))
    assert abs(sizes[0] - sizes[1]) < 200


VALUES = ["1", "+5", "-3", " 5", "5 ", "2.0", "1e3", "", '""', '"7"', "1,5", '"1,500.25"', "2001-01-05", "2001-1-5",
          "2001-01-05 ", "2001", "2001-02-30", "abc", "99999999999", "1.23456789", "123456789012345678901234567",
          '"a ""b"" c"', "'q'", "NaN", "null", "é", '"open', "\t9", "0x1F", "1_000", "12.", ".5", "--1"]


def test_values_are_typed_as_the_csv_reader_types_them(spark, tmp_dir):
    rnd = random.Random(6)
    folder = os.path.join(tmp_dir, "landing")
    os.makedirs(folder)
    header = rnd.sample(MANDATORY_COLUMNS + ["extra"], 9)
    lines = []
    for k in range(1500):
        cells = [ROW.get(c, "e") for c in header]
        for at in rnd.sample(range(9), rnd.choice([0, 1, 1, 2])):
            cells[at] = rnd.choice(VALUES)
        if rnd.random() < 0.05:
            cells = cells[:rnd.randint(1, 8)] if rnd.random() < 0.5 else cells + ["z"]
        lines.append(",".join(cells))
    with open(os.path.join(folder, "a.csv"), "w") as f:
        f.write("\n".join([",".join(header), *lines]) + "\n")
    schema = T.StructType([T.StructField(c, MANDATORY_TYPES.get(c, T.StringType())) for c in header]
                          + [T.StructField(FS.CORRUPT, T.StringType())])
    read = spark.createDataFrame([(x,) for x in lines], "value string").select(
        F.from_csv("value", ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema),
                   {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": FS.CORRUPT}).alias("r")).select("r.*").collect()
    want_bad = sorted(r[FS.CORRUPT] for r in read if r[FS.CORRUPT] is not None)
    want = sorted(str([r[c] for c in MANDATORY_COLUMNS] + [r["extra"] or ""]) for r in read if r[FS.CORRUPT] is None)
    sales, rejected, _ = FS.ingest(spark, folder, os.path.join(tmp_dir, "stage"))
    got = sorted(str([r[c] for c in MANDATORY_COLUMNS] + [r["additional_column"]]) for r in sales.collect())
    assert got == want
    assert sorted(r["raw_record"] for r in rejected.collect()) == want_bad
    assert len(want) > 600 and len(want_bad) > 300


def test_stream_keeps_marts_by_their_sums(spark, tmp_dir):
    landing, out, ckpt = (os.path.join(tmp_dir, x) for x in ("landing", "out", "ckpt"))
    dims = [spark.createDataFrame([(1, "a", "b", "x", "1", "2")], CUSTOMER_SCHEMA),
            spark.createDataFrame([(7, "s", "m")], STORE_SCHEMA),
            spark.createDataFrame([(3, "p", "q", 3, "Y", "x", "1"), (4, "r", "s", 3, "N", "x", "1")], SALES_TEAM_SCHEMA)]
    marts = [MS.customer_mart(*dims), MS.sales_team_mart(*dims)]
    os.makedirs(landing)
    header = ",".join(MANDATORY_COLUMNS)
    for k in range(5):  # five batches; sums are put together after the second and the fourth
        with open(os.path.join(landing, f"d{k}.csv"), "w") as f:
            f.write(f"{header}\n1,7,pen,2001-0{k % 2 + 1}-05,{3 + k % 3 // 2},1.50,2,{k + 1}.004\n")
            f.write("1,7,pen,,3,1.50,2,0.50\n")
        ST.ingest_available_now(spark, landing, out, ckpt, marts=marts, compact_every=2)
    sales = ST.ingested_sales(spark, out)
    for mart in marts:
        got = sorted(map(str, spark.read.schema(mart.schema).parquet(f"{out}/{mart.name}")
                         .select(*mart.schema.fieldNames()).collect()))
        assert got == sorted(map(str, mart.rows(mart.sums(sales)).collect()))
        batches = os.listdir(f"{out}/{mart.name}_sums/batches/{mart.month}=2001-01")
        assert [b for b in batches if not b.startswith(".")] == ["batch_id=4"]
        assert [r["run_id"] for r in S.published_snapshots(spark, f"{out}/{mart.name}_sums/base").collect()] == [3]
    total = M.customer_monthly_spend_from_sales(sales, *dims)
    assert {r["sales_date_month"]: r["total_sales"] for r in total.collect()}[None] == D("2.50")
    # A batch that is replayed after it was put together is not counted twice.
    schema = ST._sums_schema(marts[0], marts[0].sums(sales))
    before = marts[0].merged(ST.stream_sums(spark, out, marts[0], schema)).orderBy("sales_date_month").collect()
    ST._keep_mart(spark, out, marts[0], sales.limit(1), 3, 1000)
    assert marts[0].merged(ST.stream_sums(spark, out, marts[0], schema)).orderBy("sales_date_month").collect() == before


def test_stream_builds_the_months_of_many_batches_once(spark, tmp_dir, monkeypatch):
    landing, out, ckpt = (os.path.join(tmp_dir, x) for x in ("landing", "out", "ckpt"))
    dims = [spark.createDataFrame([(1, "a", "b", "x", "1", "2")], CUSTOMER_SCHEMA),
            spark.createDataFrame([(7, "s", "m")], STORE_SCHEMA),
            spark.createDataFrame([(3, "p", "q", 3, "Y", "x", "1")], SALES_TEAM_SCHEMA)]
    mart = MS.customer_mart(*dims)
    built, refresh = [], ST.refresh_months

    def run(refreshed):
        monkeypatch.setattr(ST, "refresh_months", refreshed)
        ST.ingest_available_now(spark, landing, out, ckpt, marts=[mart], max_files_per_batch=1, compact_every=2)

    def counted(rows, path, months, month_col):
        built.append(sorted(months))
        refresh(rows, path, months, month_col)

    def breaks(*_):
        raise RuntimeError("lost")

    def land(names):
        for k in names:
            with open(os.path.join(landing, f"d{k}.csv"), "w") as f:
                f.write(f"{','.join(MANDATORY_COLUMNS)}\n1,7,pen,2001-0{k % 2 + 1}-05,3,1.50,2,{k + 1}.00\n")

    os.makedirs(landing)
    land(range(3))  # three batches; sums are put together after the second
    with pytest.raises(RuntimeError):
        run(breaks)
    run(counted)  # nothing new: what the first run noted
    land([4])
    run(counted)
    run(counted)
    assert built == [["2001-01", "2001-02"], ["2001-01"]]
    got = {r["sales_date_month"]: r["total_sales"] for r in spark.read.schema(mart.schema).parquet(f"{out}/{mart.name}").collect()}
    assert got == {"2001-01": D("9.00"), "2001-02": D("2.00")}
