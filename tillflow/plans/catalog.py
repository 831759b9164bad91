"""Named queries: each takes (spark, sf_dir) and returns a DataFrame.

Every query reads the driver tables of ``sf_dir`` (or files Spark derives
from them), whole.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillflow.functions.expressions import fold_columns, full_name, incentive, money, month_of
from tillflow.operators import enrich as E
from tillflow.operators import ledger as L
from tillflow.operators import marts as M
from tillflow.operators import monthly_sums as MS
from tillflow.plans import sinks as S
from tillflow.plans import batch_run as B
from tillflow.plans import catalog_tables as CT
from tillflow.plans.scratch import fresh_dir, kept, path_exists
from tillflow.schema import (ADDITIONAL_COLUMN, FOLD_SEPARATOR, MANDATORY_COLUMNS,
                             SALES_TEAM_EXTRACT_COLUMNS)
from tillflow.sources import drops as DR
from tillflow.sources import files as FS
from tillflow.sources import tables as TB
from tillflow.sources.drops import drops_for
from tillflow.streaming import file_stream as ST

Query = Callable[[SparkSession, str], DataFrame]


def facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales without the product lookup (no mart reads product name or price)."""
    return TB.sales(spark, sf_dir, with_product=False)


def enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E.enrich(facts(spark, sf_dir), TB.customer(spark, sf_dir),
                    TB.store(spark, sf_dir), TB.sales_team(spark, sf_dir))


def _dims(spark: SparkSession, sf_dir: str, customer: DataFrame | None = None):
    return (customer if customer is not None else TB.customer(spark, sf_dir),
            TB.store(spark, sf_dir), TB.sales_team(spark, sf_dir))


def salesperson_monthly_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.salesperson_monthly_sales_from_sales(facts(spark, sf_dir), *_dims(spark, sf_dir))


def top_seller_incentive(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.top_seller_incentive(salesperson_monthly_sales(spark, sf_dir))


def sales_rank_in_store_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.sales_rank(salesperson_monthly_sales(spark, sf_dir))


def customer_monthly_spend(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.customer_monthly_spend_from_sales(facts(spark, sf_dir), *_dims(spark, sf_dir))


def enrich_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E.enrich_customer(facts(spark, sf_dir), TB.customer(spark, sf_dir))


def enrich_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E.enrich_store(facts(spark, sf_dir), TB.customer(spark, sf_dir),
                          TB.store(spark, sf_dir))


def customer_mart_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.customer_extract(enriched(spark, sf_dir))


def sales_team_mart_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.sales_team_extract(enriched(spark, sf_dir))


QUERIES: dict[str, Query] = {
    "top_seller_incentive": top_seller_incentive,
    "salesperson_monthly_sales": salesperson_monthly_sales,
    "sales_rank_in_store_month": sales_rank_in_store_month,
    "customer_monthly_spend": customer_monthly_spend,
    "enrich_customer": enrich_customer,
    "enrich_store": enrich_store,
    "enrich_full": enriched,
    "customer_mart_extract": customer_mart_extract,
    "sales_team_mart_extract": sales_team_mart_extract,
}


# --- more marts over the same enrichment --------------------------------------

def customer_spend_shared_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.customer_monthly_spend_from_sales(facts(spark, sf_dir),
                                 *_dims(spark, sf_dir, TB.customer_with_renames(spark, sf_dir)))


def daily_store_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.daily_store_sales_from_sales(facts(spark, sf_dir), *_dims(spark, sf_dir))


def product_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    sales = TB.sales(spark, sf_dir, extra=("l_partkey",), with_product=False)
    return M.product_monthly_sales(sales, TB.product(spark, sf_dir), key="l_partkey")


def orphan_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales without a customer, store or sales person in the full tables."""
    return E.orphan_sales(TB.sales(spark, sf_dir), *_dims(spark, sf_dir))


# Fixed value: the region whose own store list the report below is checked against.
ORPHAN_REGION = "AMERICA"


def orphan_sales_of_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales that one region's system, which knows its own stores only, can't place."""
    return E.orphan_sales(TB.sales(spark, sf_dir), TB.customer(spark, sf_dir),
                          TB.store_in_region(spark, sf_dir, ORPHAN_REGION),
                          TB.sales_team(spark, sf_dir))


def scalar_semantics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The scalar functions of the marts on NULL and non-NULL inputs, per order."""
    o = TB.table(spark, sf_dir, "orders")
    status = F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus"))  # NULL for P
    rush = F.when(F.col("o_orderpriority") == "1-URGENT", F.lit("rush"))  # NULL otherwise
    return o.select(
        "o_orderkey",
        month_of("o_orderdate").alias("order_month"),
        full_name("o_orderpriority", status).alias("label"),
        F.concat_ws(FOLD_SEPARATOR, status, rush).alias("folded"),
        F.when(status == "F", F.lit("closed")).otherwise(F.lit("open")).alias("state"),
        incentive(money("o_totalprice"), F.lit(True)).alias("cents"),
    )


# --- files: drops, manifest, gate, ingest, quarantine -------------------------

def _ingested(spark: SparkSession, sf_dir: str):
    landing = drops_for(spark, sf_dir)
    return FS.ingest(spark, landing, fresh_dir(spark, "ingest-stage"))


def file_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Folders, kinds and extensions of the landed files (how many files a folder
    has depends on how Spark wrote it)."""
    m = FS.file_manifest(spark, drops_for(spark, sf_dir))
    return m.select("source_folder", "kind",
                    F.regexp_extract("file_name", r"([.][^.]+)$", 1).alias("extension")).distinct()


def csv_header_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    landing = drops_for(spark, sf_dir)
    manifest = FS.file_manifest(spark, landing)
    gate = FS.header_gate(manifest.where(F.col("kind") == FS.KIND_CSV), FS.text_lines(spark, landing))
    return gate.select(
        "source_folder",
        F.concat_ws(",", "header").alias("header"),
        "accepted",
        F.concat_ws(",", "missing_columns").alias("missing_columns"),
        F.concat_ws(",", "extra_columns").alias("extra_columns"),
    ).distinct()


def csv_ingest_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    sales = _ingested(spark, sf_dir)[0]
    return sales.withColumn("price", money("price")).withColumn("total_cost", money("total_cost"))


def quarantine_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return FS.quarantine_report(_ingested(spark, sf_dir)[1])


def fold_extra_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = DR.sales_with_extras(spark, sf_dir)
    return s.select(*MANDATORY_COLUMNS,
                    fold_columns(["payment_mode", "coupon_code"]).alias(ADDITIONAL_COLUMN))


# --- ledger --------------------------------------------------------------------

def ledger_current_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.current_status(TB.daily_file_events(spark, sf_dir))


def ledger_open_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.open_files(TB.files_in_landing(spark, sf_dir), TB.daily_file_events(spark, sf_dir))


# --- sinks ---------------------------------------------------------------------

def parquet_mart_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_dir(spark, "customer-extract")
    S.write_mart(customer_mart_extract(spark, sf_dir), path)
    return spark.read.parquet(path)


def partitioned_mart_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_dir(spark, "sales-team-partitioned")
    extract = sales_team_mart_extract(spark, sf_dir)
    S.write_partitioned(extract, path, ["sales_month", "store_id"])
    return S.read_partitioned(spark, path, extract.schema).select(*SALES_TEAM_EXTRACT_COLUMNS)


# Fixed value: the first of two loads holds the sales shipped before this day.
FIRST_LOAD_BEFORE = "1997-07-15"


def latest_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two run-stamped snapshots of the customer mart (an early load, then the
    full one); reading the latest gives the full mart."""
    root = fresh_dir(spark, "customer-mart-snapshots")
    sales, dims = facts(spark, sf_dir), _dims(spark, sf_dir)
    early = sales.where(F.col("sales_date") < F.lit(FIRST_LOAD_BEFORE).cast("date"))
    S.write_snapshot(M.customer_monthly_spend_from_sales(early, *dims), root, run_id=1)
    S.write_snapshot(M.customer_monthly_spend_from_sales(sales, *dims), root, run_id=2)
    return S.read_latest(spark, root)


def mart_month_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales arrive in two loads; after the second, only the months it touches
    are recomputed from the partitioned fact mart and replaced in the monthly
    mart.  The result equals a full recomputation.  Each load has partitions of
    its own, so one that is repeated replaces itself."""
    base = fresh_dir(spark, "month-refresh")
    facts_path, mart_path = f"{base}/facts", f"{base}/monthly"
    ext = sales_team_mart_extract(spark, sf_dir)
    cut = F.coalesce(F.col("sales_date") < F.lit(FIRST_LOAD_BEFORE).cast("date"), F.lit(False))
    schema = T.StructType(ext.schema.fields + [T.StructField("load", T.IntegerType())])
    for load, rows in ((1, ext.where(cut)), (2, ext.where(~cut))):
        S.write_partitioned(rows.withColumn("load", F.lit(load)), facts_path,
                            ["sales_month", "load"], dynamic=True)
        facts = S.read_partitioned(spark, facts_path, schema)
        months = S.months_in(facts.where(F.col("load") == load))
        touched = facts.where(S.in_months(F.col("sales_month"), months)).drop("load")
        mart = M.top_seller_incentive(M.salesperson_monthly_sales(touched))
        S.refresh_months(mart, mart_path, months)
    return S.read_partitioned(spark, mart_path, mart.schema).select(*mart.columns)


# One month and store of the partitioned mart.
PRUNED_MONTH, PRUNED_STORE = "1998-05", 7


def partitioned_mart_one_store_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole extract is written by month and store; one store's month is read back,
    from its folder alone."""
    path = fresh_dir(spark, "sales-team-partitioned")
    extract = sales_team_mart_extract(spark, sf_dir)
    S.write_partitioned(extract, path, ["sales_month", "store_id"])
    mart = S.read_partitioned(spark, path, extract.schema)
    return mart.where((F.col("sales_month") == PRUNED_MONTH) & (F.col("store_id") == PRUNED_STORE)).select(
        *SALES_TEAM_EXTRACT_COLUMNS)


# --- files to both marts ---------------------------------------------------------

def _kept_dims(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """The dimensions for jobs that join them many times: read and put together once."""
    return [kept(d, "dimension") for d in _dims(spark, sf_dir)]


def _batch(spark: SparkSession, sf_dir: str) -> str:
    out = fresh_dir(spark, "batch-run")
    B.run_batch(spark, drops_for(spark, sf_dir), out, *_kept_dims(spark, sf_dir), run_id="run-1")
    return out


def files_to_customer_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    return B.customer_mart(spark, _batch(spark, sf_dir))


def files_to_sales_team_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    return B.sales_team_mart(spark, _batch(spark, sf_dir))


def files_ledger_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Status, by folder, of the files that a batch run processed, whether each has its
    two events, and whether the run stamped them with its own time."""
    began = spark.sql("SELECT current_timestamp() AS t").first()["t"]
    events = L.read_events(spark, f"{_batch(spark, sf_dir)}/ledger")
    status = L.current_status(events)
    return status.select(
        F.element_at(F.split("file_location", "/"), -2).alias("source_folder"), "status",
        (F.col("event_count") == 2).alias("opened_and_closed"),
        F.col("updated_at").between(F.lit(began), F.current_timestamp()).alias("stamped"),
    ).distinct()


# --- runs over a growing landing folder -------------------------------------------

# The drop layouts that land before the first of two runs, by priority;
# the others and the file that is not CSV land before the second.
FIRST_RUN = ["1-URGENT", "3-MEDIUM", "4-NOT SPECIFIED"]


def _two_runs(spark: SparkSession, sf_dir: str) -> str:
    """Files land in two parts, each followed by a run that archives them; a third run
    finds nothing new.  The queries below look at what the runs left, which is made
    once in a session."""
    drops = DR.drops_root(spark, sf_dir)
    base = f"{drops}-two-runs"
    if path_exists(spark, f"{base}/ready"):
        return base
    landing, out = f"{base}/landing", f"{base}/out"
    # The session's drops are not landed for this, only their sales are read, if they are there.
    ready = path_exists(spark, f"{drops}/ready")
    staged = spark.read.parquet(f"{drops}/staged_sales") if ready else DR.staged_sales(spark, sf_dir, base)
    dims = _kept_dims(spark, sf_dir)

    def run(run_id: str) -> None:
        B.run_batch(spark, landing, out, *dims, run_id=run_id, archive=f"{base}/archive")

    DR.land(staged, landing, FIRST_RUN)
    run("run-1")
    DR.land(staged, landing, [p for p in DR.LAYOUT_BY_PRIORITY if p not in FIRST_RUN])
    TB.table(spark, sf_dir, "region").write.mode("overwrite").json(f"{landing}/{DR.NOT_CSV_FOLDER}")
    run("run-2")
    run("run-3")
    spark.range(1).write.mode("overwrite").parquet(f"{base}/ready")
    return base


def two_runs_customer_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The customer mart after two runs: that of one run over all files."""
    return B.customer_mart(spark, f"{_two_runs(spark, sf_dir)}/out")


def two_runs_sales_team_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sales-team mart after two runs; top sellers are those of the whole months."""
    return B.sales_team_mart(spark, f"{_two_runs(spark, sf_dir)}/out")


def two_runs_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which run took the files of each folder, and what became of them."""
    out = f"{_two_runs(spark, sf_dir)}/out"
    folder = lambda path: F.element_at(F.split(path, "/"), -2).alias("source_folder")
    taken = L.read_events(spark, f"{out}/ledger").select(folder("file_location"), "run_id", "status")
    rejected = B.quarantine(spark, out).select(folder("path"), "run_id", F.col("reason").alias("status"))
    return taken.unionByName(rejected).distinct()


def two_runs_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where the landed files are after two runs with an archive, by run and folder."""
    base = _two_runs(spark, sf_dir)
    parts = F.split("path", "/")
    places = [FS.file_manifest(spark, f"{base}/archive").select(
        F.element_at(parts, -4).alias("place"), F.element_at(parts, -3).alias("run_id"), "source_folder", "kind")]
    places.append(FS.file_manifest(spark, f"{base}/landing").select(
        F.lit("landing").alias("place"), F.lit(None).cast("string").alias("run_id"), "source_folder", "kind"))
    return places[0].unionByName(places[1]).distinct()


def two_runs_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sales-team extract of both runs, kept by run, month and store."""
    return B.sales_team_extract(spark, f"{_two_runs(spark, sf_dir)}/out").withColumn("total_cost", money("total_cost"))


def published_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three snapshots of the monthly sales per person, the last one empty, one dropped:
    what is published, and what a reader of the latest gets."""
    root = fresh_dir(spark, "published-snapshots")
    monthly = salesperson_monthly_sales(spark, sf_dir)
    for run, rows in ((1, monthly.where("sales_month < '1996'")), (2, monthly), (3, monthly.where("false"))):
        S.write_snapshot(rows, root, run_id=run)
    S.drop_old_snapshots(spark, root, keep=2)
    read = S.read_latest(spark, root).agg(F.count("*").alias("rows_read"), F.lit(3).cast("long").alias("latest"))
    kept = S.published_snapshots(spark, root).select("run_id", "n_rows")
    return kept.join(read, F.col("run_id") == F.col("latest"), "left").select("run_id", "n_rows", "rows_read")


# --- SQL over catalog tables --------------------------------------------------------

def _catalog(spark: SparkSession, sf_dir: str) -> str:
    """A database of its own with the retail tables, filled from the given ones, and both
    marts built by SQL."""
    base = fresh_dir(spark, "catalog")
    db = "tillflow_" + base.rsplit("-", 1)[1]
    CT.create(spark, db, base)
    customer, store, sales_team = _dims(spark, sf_dir)
    for name, rows in (("sales", facts(spark, sf_dir)), ("customer", customer), ("store", store),
                       ("sales_team", sales_team), ("product", TB.product(spark, sf_dir)),
                       ("product_staging", TB.daily_file_events(spark, sf_dir))):
        CT.insert(rows, db, name)
    CT.build_marts(spark, db)
    return db


def catalog_customers_data_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(f"SELECT * FROM {_catalog(spark, sf_dir)}.customers_data_mart")


def catalog_sales_team_data_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(f"SELECT * FROM {_catalog(spark, sf_dir)}.sales_team_data_mart")


def catalog_open_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files that are still being processed, asked of the staging table in SQL."""
    return spark.sql(f"""
        SELECT file_name FROM {_catalog(spark, sf_dir)}.product_staging
        GROUP BY file_name HAVING max_by(status, struct(event_ts, seq)) = 'A'""")


# Fixed value: stores whose name begins so are asked for below.
STORE_PREFIX = "NATION_2"


def mart_of_some_stores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly sales of some stores from the extract by month and store.  The filter is on
    the store table; the scan learns the store folders from it when it runs."""
    path = fresh_dir(spark, "sales-team-partitioned")
    extract = sales_team_mart_extract(spark, sf_dir)
    S.write_partitioned(extract, path, ["sales_month", "store_id"])
    mart = S.read_partitioned(spark, path, extract.schema)
    stores = TB.store(spark, sf_dir).where(F.col("address").startswith(STORE_PREFIX))
    return mart.join(stores, mart["store_id"] == stores["id"]).groupBy("store_id", "address", "sales_month").agg(
        money(F.sum("total_cost")).alias("total_sales"), F.count(F.lit(1)).alias("sales_count"))


# --- stream --------------------------------------------------------------------

def stream_ingest_available_now(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Drops are written to a fresh landing folder and streamed once with
    availableNow (files archived as they are finished); the stream keeps the
    customer mart by its sums, month by month, and the query reads that mart."""
    run = fresh_dir(spark, "stream")
    landing = DR.write_drops(spark, sf_dir, f"{run}/drops")
    # Files per micro-batch and compaction (fixed): several batches, so later ones add
    # to months that earlier ones wrote, and sums are put together on the way.
    mart = MS.customer_mart(*_kept_dims(spark, sf_dir))
    ST.ingest_available_now(spark, landing, f"{run}/out", f"{run}/checkpoint",
                            archive_dir=f"{run}/archive", marts=[mart],
                            max_files_per_batch=16, compact_every=2)
    return spark.read.schema(mart.schema).parquet(f"{run}/out/{mart.name}").select(*mart.schema.fieldNames())


def stream_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Kinds of files, by folder, that the stream has moved to its archive.  A file is
    moved when a later micro-batch is done: each layout's files are a micro-batch,
    and the folder that comes last (``late``, a copy of another) is still landed."""
    run = fresh_dir(spark, "stream-archive")
    landing = DR.write_drops(spark, sf_dir, f"{run}/drops")
    streamed = lambda: ST.ingest_available_now(
        spark, landing, f"{run}/out", f"{run}/checkpoint", archive_dir=f"{run}/archive")
    streamed()
    for _ in range(2):  # the first run's files move once a second batch follows
        late = spark.read.text(f"{landing}/{DR.NOT_CSV_FOLDER}")
        late.write.mode("append").text(f"{landing}/late")
        streamed()
    archived = FS.file_manifest(spark, f"{run}/archive")
    return archived.where("source_folder <> 'late'").select("source_folder", "kind").distinct()


QUERIES.update({
    "customer_spend_shared_key": customer_spend_shared_key,
    "daily_store_sales": daily_store_sales,
    "product_sales": product_sales,
    "orphan_sales": orphan_sales,
    "scalar_semantics": scalar_semantics,
    "file_manifest": file_manifest,
    "csv_header_gate": csv_header_gate,
    "csv_ingest_union": csv_ingest_union,
    "fold_extra_columns": fold_extra_columns,
    "quarantine_report": quarantine_report,
    "ledger_current_status": ledger_current_status,
    "ledger_open_files": ledger_open_files,
    "parquet_mart_roundtrip": parquet_mart_roundtrip,
    "partitioned_mart_month": partitioned_mart_month,
    "latest_snapshot": latest_snapshot,
    "mart_month_refresh": mart_month_refresh,
    "partitioned_mart_one_store_month": partitioned_mart_one_store_month,
    "files_to_customer_mart": files_to_customer_mart,
    "files_to_sales_team_mart": files_to_sales_team_mart,
    "files_ledger_status": files_ledger_status,
    "orphan_sales_of_region": orphan_sales_of_region,
    "two_runs_customer_mart": two_runs_customer_mart,
    "two_runs_sales_team_mart": two_runs_sales_team_mart,
    "two_runs_files": two_runs_files,
    "two_runs_archive": two_runs_archive,
    "two_runs_extract": two_runs_extract,
    "published_snapshots": published_snapshots,
    "catalog_customers_data_mart": catalog_customers_data_mart,
    "catalog_sales_team_data_mart": catalog_sales_team_data_mart,
    "catalog_open_files": catalog_open_files,
    "mart_of_some_stores": mart_of_some_stores,
    "stream_archive": stream_archive,
    "stream_ingest_available_now": stream_ingest_available_now,
})
