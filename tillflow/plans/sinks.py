"""Parquet sinks for the marts.

* ``write_mart``         plain overwrite.
* ``write_partitioned``  partitioned by e.g. (sales_month, store_id).  Rows are
  first rebalanced on the partition columns (the ``rebalance`` hint): each
  partition value goes to one writer task, so a folder gets one file instead of
  one per upstream task, and AQE splits an oversized value (a store-month
  holding a third of all sales) over several tasks and merges small ones, by
  ``spark.sql.adaptive.advisoryPartitionSizeInBytes``.
* ``write_snapshot`` / ``read_latest``  run-stamped copies: rows below
  ``<root>/rows/run_id=...`` and, written last, a marker with the row count and
  the schema below ``<root>/published``.  Readers follow the newest marker, so an
  empty snapshot reads as empty and one that is being written, or was broken off,
  is not seen.  ``drop_old_snapshots`` keeps the newest ones.
* ``refresh_months``  replaces the months it is told; a month without new rows
  is removed, others stay.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillflow.plans.scratch import CODEC, path_exists, remove_path


def write_mart(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).parquet(path)


def rebalanced(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.hint("rebalance", *cols)


def write_partitioned(df: DataFrame, path: str, cols: list[str], mode: str = "overwrite",
                      dynamic: bool = False) -> None:
    """``dynamic``: an overwrite replaces the partitions that ``df`` has rows for;
    otherwise it replaces everything below ``path``, whatever the session's mode."""
    (rebalanced(df, cols).write.mode(mode).partitionBy(*cols)
     .option("partitionOverwriteMode", "dynamic" if dynamic else "static").option("compression", CODEC).parquet(path))


def read_partitioned(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Reads a partitioned mart with the partition columns typed by ``schema``
    (no type guessing from directory names)."""
    return spark.read.schema(schema).parquet(path)


PUBLISHED_SCHEMA = T.StructType([
    T.StructField("n_rows", T.LongType(), False),
    T.StructField("schema", T.StringType(), False),
    T.StructField("published_at", T.TimestampType(), False),
    T.StructField("run_id", T.LongType(), False),
])


def write_snapshot(df: DataFrame, root: str, run_id: int) -> None:
    """A snapshot of that run, in place of an earlier one; published when it is whole.
    A published run that is written again stays as it was until the new marker."""
    spark = df.sparkSession
    place = f"{root}/rows/run_id={run_id}"
    df.write.mode("overwrite").parquet(place)
    written = spark.read.schema(df.schema).parquet(place).count()  # from the files' footers
    marker = spark.range(1).select(
        F.lit(written).cast("long").alias("n_rows"), F.lit(df.schema.json()).alias("schema"),
        F.current_timestamp().alias("published_at"), F.lit(run_id).cast("long").alias("run_id"))
    (marker.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run_id")
     .parquet(f"{root}/published"))


def published_snapshots(spark: SparkSession, root: str) -> DataFrame:
    """(n_rows, schema, published_at, run_id), a row for each published snapshot."""
    if not path_exists(spark, f"{root}/published"):
        return spark.createDataFrame([], PUBLISHED_SCHEMA)
    return spark.read.schema(PUBLISHED_SCHEMA).parquet(f"{root}/published")


def read_latest(spark: SparkSession, root: str) -> DataFrame:
    """The newest published snapshot; only its files are scanned."""
    newest = published_snapshots(spark, root).orderBy(F.desc("run_id")).first()
    if newest is None:
        raise LookupError(f"no published snapshot below {root}")
    schema = T.StructType.fromJson(json.loads(newest["schema"]))
    return spark.read.schema(schema).parquet(f"{root}/rows/run_id={newest['run_id']}")


def drop_old_snapshots(spark: SparkSession, root: str, keep: int) -> list[int]:
    """Removes all published snapshots but the newest ``keep``, markers first; their runs."""
    runs = [r["run_id"] for r in published_snapshots(spark, root).select("run_id").orderBy(F.desc("run_id")).collect()]
    for run in runs[max(keep, 1):]:
        remove_path(spark, f"{root}/published/run_id={run}")
        remove_path(spark, f"{root}/rows/run_id={run}")
    return runs[max(keep, 1):]


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """``df`` with the columns, order and types of ``schema``."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])


def months_in(df: DataFrame, month_col: str = "sales_month") -> list[str | None]:
    """The months of ``df``, NULL among them: as many values as there are months."""
    return [r[0] for r in df.select(month_col).distinct().collect()]


def in_months(month: Column, months: list[str | None]) -> Column:
    """Whether a month is one of ``months``, as literals, so that a scan is pruned."""
    dated = [m for m in months if m is not None]
    hit = month.isin(dated) if dated else F.lit(False)
    return hit | month.isNull() if None in months else hit


def _files(spark: SparkSession, path: str, schema: T.StructType) -> set[str]:
    """The files of a mart, as the driver lists them to read it."""
    return set(spark.read.schema(schema).parquet(path).inputFiles()) if path_exists(spark, path) else set()


def refresh_months(new_rows: DataFrame, path: str, months: list[str | None],
                   month_col: str = "sales_month") -> None:
    """Replaces ``months`` by ``new_rows``, which are not read from ``path``: a month of which
    no row is left is removed.  The rows are computed and written once; a month that has
    none is left with the files that it had before."""
    spark = new_rows.sparkSession
    before = _files(spark, path, new_rows.schema)
    write_partitioned(new_rows, path, [month_col], mode="overwrite", dynamic=True)
    old = {f.rsplit("/", 2)[-2] for f in before & _files(spark, path, new_rows.schema)} if before else set()
    for m in months:
        folder = f"{month_col}={'__HIVE_DEFAULT_PARTITION__' if m is None else m}"
        if folder in old:
            remove_path(spark, f"{path}/{folder}")


def preview(df: DataFrame, n: int = 20) -> DataFrame:
    """The first ``n`` rows, for a look at an intermediate result (the retail
    job's ``show``).  Each call runs the plan up to a limit; keep it out of
    jobs."""
    return df.limit(n)
