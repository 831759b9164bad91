"""Daily file arrival as a stream that processes each file once.

``readStream.format("binaryFile")`` discovers new files below the landing
folder (only path, size and time are selected, so no file body is read by the
source); the checkpoint remembers which files were handed out, in place of the
retail job's staging table.  Each micro-batch runs the batch ingest of
``sources.files`` on exactly its files:

* the parsed rows go to ``<out>/facts`` partitioned by ``sales_month`` and
  ``batch_id``, the quarantine (written first) to ``<out>/quarantine`` -- both by
  dynamic partition overwrite, so a micro-batch replayed after a failure replaces
  its own output;
* the ledger gets an A event per accepted file before the write and an I event
  after it (see ``operators.ledger``), stored per (micro-batch, status), so a
  replay rewrites its own events;
* a monthly mart is kept by its sums (``operators.monthly_sums``): a micro-batch
  adds its own by month and notes the months it touched.  When the stream has
  processed what is there, the months noted are built once from the sums of all
  micro-batches and replaced in ``<out>/<mart>``, however many batches touched them;
  months that a broken-off run noted are built by the next one.  Facts of earlier
  batches are not read.  Every ``compact_every`` batches the sums so far are put together
  into one published snapshot that stands for them, so a month is a bounded
  number of folders however long the stream lives; a batch that is replayed after
  that is already in it and not counted again;
* with a mart builder, which maps sales to any mart, the months the micro-batch
  touched are recomputed from the facts of these months and replaced in
  ``<out>/mart``.  The months are literals in the filter on the partition column.

``trigger(availableNow=True)`` processes what is there and stops.  With an
archive folder the source moves finished files there (``cleanSource``); it
does so for the files of earlier batches, so the move lags one run.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from collections.abc import Callable, Sequence

from tillflow.functions.expressions import month_of
from tillflow.operators.ledger import close_events, open_events, write_events
from tillflow.operators.monthly_sums import MonthlyMart
from tillflow.plans import sinks as S
from tillflow.plans.scratch import CODEC, path_exists, remove_path
from tillflow.plans.sinks import in_months, months_in, refresh_months
from tillflow.schema import SALES_SCHEMA
from tillflow.sources import files as FS

MartBuilder = Callable[[DataFrame], DataFrame]

DEFAULT_MAX_FILES = 1000

#: Micro-batches after which sums are put together.
COMPACT_EVERY = 50

# The fixed schema of the binaryFile source (a stream must be given it).
BINARY_FILE_SCHEMA = T.StructType([
    T.StructField("path", T.StringType(), False),
    T.StructField("modificationTime", T.TimestampType(), False),
    T.StructField("length", T.LongType(), False),
    T.StructField("content", T.BinaryType(), True),
])


MONTH = "sales_month"
FACTS_SCHEMA = T.StructType(SALES_SCHEMA.fields + [
    T.StructField(MONTH, T.StringType(), True), T.StructField("batch_id", T.LongType(), True)])


def _replace_partitions(df: DataFrame, path: str, *by: str) -> None:
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", CODEC)
     .partitionBy(*by).parquet(path))


def touched_facts(spark: SparkSession, out: str, months: list[str | None]) -> DataFrame:
    """The facts of some months: other months' folders are not read."""
    facts = spark.read.schema(FACTS_SCHEMA).parquet(f"{out}/facts")
    return facts.where(in_months(F.col(MONTH), months)).select(*SALES_SCHEMA.fieldNames())


def _sums_schema(mart: MonthlyMart, sums: DataFrame) -> T.StructType:
    return T.StructType([*[f for f in sums.schema if f.name != mart.month], T.StructField(mart.month, T.StringType()),
                         T.StructField("batch_id", T.LongType())])


def stream_sums(spark: SparkSession, out: str, mart: MonthlyMart, schema: T.StructType) -> DataFrame:
    """A mart's sums of all micro-batches: the last published snapshot and what came after."""
    place = f"{out}/{mart.name}_sums"
    newest = S.published_snapshots(spark, f"{place}/base").agg(F.max("run_id")).first()[0]
    later = spark.read.schema(schema).parquet(f"{place}/batches")
    if newest is None:
        return later.drop("batch_id")
    base = S.read_latest(spark, f"{place}/base").select(*later.drop("batch_id").columns)
    return later.where(F.col("batch_id") > newest).drop("batch_id").unionByName(base)


def _keep_mart(spark: SparkSession, out: str, mart: MonthlyMart, sales: DataFrame, batch_id: int,
               compact_every: int) -> None:
    place = f"{out}/{mart.name}_sums"
    sums = mart.sums(sales)
    schema = _sums_schema(mart, sums)
    # A month's sums meet before they are written: else each task has a file for each month.
    _replace_partitions(S.rebalanced(sums.withColumn("batch_id", F.lit(batch_id).cast("long")), [mart.month]),
                        f"{place}/batches", mart.month, "batch_id")
    if not path_exists(spark, f"{place}/batches"):
        return
    mine = spark.read.schema(schema).parquet(f"{place}/batches").where(F.col("batch_id") == batch_id)
    _replace_partitions(mine.select(F.col(mart.month).alias("month"), "batch_id").distinct(), f"{place}/touched", "batch_id")
    if (batch_id + 1) % compact_every == 0:
        whole = mart.merged(stream_sums(spark, out, mart, schema)).sort(mart.month)
        S.write_snapshot(whole, f"{place}/base", run_id=batch_id)
        S.drop_old_snapshots(spark, f"{place}/base", keep=1)
        done = spark.read.schema(schema).parquet(f"{place}/batches").where(F.col("batch_id") <= batch_id)
        for r in done.select(mart.month, "batch_id").distinct().collect():  # one for each folder
            month = "__HIVE_DEFAULT_PARTITION__" if r[0] is None else r[0]
            remove_path(spark, f"{place}/batches/{mart.month}={month}/batch_id={r[1]}")


def _refresh_mart(spark: SparkSession, out: str, mart: MonthlyMart) -> None:
    """Builds the months that micro-batches noted since the last refresh.  Notes go when the
    months are replaced, so a refresh that breaks off is done again."""
    place = f"{out}/{mart.name}_sums"
    if not path_exists(spark, f"{place}/touched"):
        return
    noted = spark.read.schema("month string, batch_id long").parquet(f"{place}/touched").distinct().collect()
    months = list(dict.fromkeys(r["month"] for r in noted))
    if not months:
        return
    schema = _sums_schema(mart, mart.sums(spark.createDataFrame([], SALES_SCHEMA)))
    touched = stream_sums(spark, out, mart, schema).where(in_months(F.col(mart.month), months))
    refresh_months(mart.rows(touched), f"{out}/{mart.name}", months, mart.month)
    for batch_id in {r["batch_id"] for r in noted}:
        remove_path(spark, f"{place}/touched/batch_id={batch_id}")


def _ingest_batch(spark: SparkSession, out: str, build: MartBuilder | None, month_col: str,
                  marts: Sequence[MonthlyMart], compact_every: int):
    def run(batch: DataFrame, batch_id: int) -> None:
        manifest = FS.classify(batch).where(F.col("kind") != FS.KIND_HIDDEN)
        # The paths of one micro-batch: at most as many as its limit of files.
        lines = FS.landed_lines(FS.text_lines(spark, [r["path"] for r in manifest.select("path").collect()]))
        files = FS.judged(manifest, lines)
        accepted = files.where("accepted").select("file_name", F.col("path").alias("file_location"))
        run_id = f"batch-{batch_id}"
        ledger = f"{out}/ledger"
        write_events(open_events(accepted, F.current_timestamp(), run_id, seq=1), ledger)
        stage = f"{out}/staged/batch_id={batch_id}"
        FS.stage(lines, files).write.mode("overwrite").option("compression", CODEC).parquet(stage)
        staged = spark.read.parquet(stage)
        _replace_partitions(FS.quarantine(files, staged).withColumn("batch_id", F.lit(batch_id)),
                            f"{out}/quarantine", "batch_id", "reason")
        sales = FS.sales_rows(staged).withColumn(MONTH, month_of("sales_date"))
        _replace_partitions(sales.withColumn("batch_id", F.lit(batch_id).cast("long")),
                            f"{out}/facts", MONTH, "batch_id")
        for mart in marts:
            _keep_mart(spark, out, mart, sales.drop(MONTH), batch_id, compact_every)
        months = months_in(sales, MONTH) if build is not None else []
        if months:
            refresh_months(build(touched_facts(spark, out, months)), f"{out}/mart", months, month_col)
        write_events(close_events(accepted, F.current_timestamp(), run_id, seq=2), ledger)

    return run


def ingest_available_now(spark: SparkSession, landing: str, out: str, checkpoint: str,
                         archive_dir: str | None = None,
                         max_files_per_batch: int = DEFAULT_MAX_FILES,
                         mart_builder: MartBuilder | None = None,
                         mart_month_col: str = "sales_date_month",
                         marts: Sequence[MonthlyMart] = (), compact_every: int = COMPACT_EVERY) -> None:
    """Processes every file below ``landing`` not yet seen by ``checkpoint``.
    ``marts`` are kept in ``<out>/<name>``.  ``mart_builder`` maps sales rows to any
    mart with a ``mart_month_col`` column, kept in ``<out>/mart``."""
    reader = (spark.readStream.format("binaryFile").schema(BINARY_FILE_SCHEMA)
              .option("recursiveFileLookup", "true")
              .option("maxFilesPerTrigger", max_files_per_batch))
    if archive_dir:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive_dir)
    files = reader.load(landing).select("path", "length", "modificationTime")
    query = (files.writeStream
             .foreachBatch(_ingest_batch(spark, out, mart_builder, mart_month_col, marts, compact_every))
             .option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
    query.awaitTermination()
    for mart in marts:
        _refresh_mart(spark, out, mart)


def ingested_sales(spark: SparkSession, out: str) -> DataFrame:
    return spark.read.schema(FACTS_SCHEMA).parquet(f"{out}/facts").select(*SALES_SCHEMA.fieldNames())


def stream_mart(spark: SparkSession, out: str, schema) -> DataFrame:
    """The mart kept by the stream, read with its schema (month as text)."""
    return spark.read.schema(schema).parquet(f"{out}/mart")
