"""Dimension tables and marts over JDBC.

* ``read_jdbc``    a table as a DataFrame.  With a numeric ``partition_column``
  and bounds it is read by ``num_partitions`` parallel range queries (the
  retail job reads each table through one connection); Spark pushes filters
  and the column list into the SQL it sends.
* ``append_jdbc``  appends a DataFrame; failures propagate (the retail job's
  writer swallowed them).

No query in the catalog uses these: running one needs a database, and this
repository starts none.  Marts go to Parquet; the same DataFrames can be handed
to ``append_jdbc`` where a database exists.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def jdbc_read_options(url: str, table: str, properties: dict[str, str] | None = None,
                      partition_column: str | None = None, lower_bound: int | None = None,
                      upper_bound: int | None = None, num_partitions: int | None = None,
                      fetch_size: int = 10_000) -> dict[str, str]:
    opts = {"url": url, "dbtable": table, "fetchsize": str(fetch_size)}
    opts.update(properties or {})
    if partition_column is not None:
        if lower_bound is None or upper_bound is None or not num_partitions:
            raise ValueError("a partitioned JDBC read needs bounds and a partition count")
        opts.update({"partitionColumn": partition_column, "lowerBound": str(lower_bound),
                     "upperBound": str(upper_bound), "numPartitions": str(num_partitions)})
    return opts


def read_jdbc(spark: SparkSession, url: str, table: str,
              properties: dict[str, str] | None = None, **partitioning) -> DataFrame:
    return spark.read.format("jdbc").options(
        **jdbc_read_options(url, table, properties, **partitioning)).load()


def append_jdbc(df: DataFrame, url: str, table: str, properties: dict[str, str] | None = None,
                num_partitions: int | None = None, batch_size: int = 10_000) -> None:
    """Appends ``df``; ``num_partitions`` caps concurrent connections."""
    writer = df.write.format("jdbc").mode("append").options(
        url=url, dbtable=table, batchsize=str(batch_size), **(properties or {}))
    if num_partitions:
        writer = writer.option("numPartitions", str(num_partitions))
    writer.save()
