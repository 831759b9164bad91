"""Where jobs put intermediate tables.

On a cluster the shared folder is the one the session names in
``spark.checkpoint.dir``; executors can be lost, so intermediate results are
written there (never to a machine-local folder) and re-read.  Only a local
session without that setting (a test, a laptop) gets a fresh folder of its own;
on a cluster the setting is required.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession


def _context(spark: SparkSession):
    try:
        return spark.sparkContext
    except Exception:  # a session without a local SparkContext (Spark Connect)
        return None


def scratch_root(spark: SparkSession) -> str:
    sc = _context(spark)
    root = sc.getCheckpointDir() if sc is not None else None
    if not root:
        root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.conf.get("spark.master", None)
        if sc is None or not (master or "").split("-")[0].startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        # One machine: give this session its own folder.
        root = tempfile.mkdtemp(prefix="run-", dir="/tmp")
        sc.setCheckpointDir(root)
        root = sc.getCheckpointDir()
    return root.rstrip("/")


def fresh_dir(spark: SparkSession, name: str) -> str:
    """A new, empty location below the scratch root (never reused, never cleared)."""
    return f"{scratch_root(spark)}/tillflow/{name}-{uuid.uuid4().hex[:12]}"


def stable_dir(spark: SparkSession, name: str) -> str:
    """A location shared by calls in this session that derive the same data."""
    return f"{scratch_root(spark)}/tillflow/{name}"


#: Codec of intermediate tables: about two thirds of the bytes of Parquet's default.
CODEC = "zstd"


def kept(df: DataFrame, name: str) -> DataFrame:
    """``df`` computed once, into scratch: later reads do not run its plan again, and
    joins see its real size, which Spark cannot tell of a plan with joins in it."""
    path = fresh_dir(df.sparkSession, name)
    df.write.option("compression", CODEC).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove_path(spark: SparkSession, path: str) -> None:
    """Removes a folder or file, if it is there, through the path's own file system."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def path_exists(spark: SparkSession, path: str) -> bool:
    """True when there is something at ``path``, which isn't listed: the driver keeps listings."""
    sc = _context(spark)
    if sc is not None:
        target = sc._jvm.org.apache.hadoop.fs.Path(path)
        return target.getFileSystem(sc._jsc.hadoopConfiguration()).exists(target)
    try:
        spark.read.format("binaryFile").load(path).select("path")
        return True
    except AnalysisException:
        return False
