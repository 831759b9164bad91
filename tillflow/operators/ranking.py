"""Rank within a group without holding the group in one task.

``rank() over (partition by g order by v desc)`` puts each group into one task.
Here the same ranks come from a global order:

1. the rows are sorted by (g, v desc nulls last, a row number) in ranges, so that
   a large group -- even a large block of equal values -- is spread over many
   partitions, and written once to the scratch folder with their partition;
2. a window inside each partition gives the rank among the rows of the group
   that the partition holds;
3. what a group or a block of equal values began in earlier partitions is
   carried over from a table with one row per partition: rows of the group so
   far are added, and a block that continues keeps the rank it began with.

NULL groups and values take part as in ``rank()``: NULL values come last, tied.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillflow.plans.scratch import fresh_dir


def _carried(ends: DataFrame) -> DataFrame:
    """For each partition (one row each, in order): ``before``, the rows of its first
    group in earlier partitions, and ``tie_rank``, the rank of its first block of
    equal values if that block began earlier."""
    along = Window.orderBy("_part")
    so_far = along.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    e = (ends.withColumn("_goes_on", F.coalesce(F.lag("last_group").over(along).eqNullSafe(F.col("first_group"))
                                               & (F.row_number().over(along) > 1), F.lit(False)))
         .withColumn("_tie_goes_on", F.col("_goes_on")
                     & F.lag("last_key").over(along).eqNullSafe(F.col("first_key"))))
    # A run of partitions that one group fills adds up; any other starts a new sum.
    filled = F.col("_goes_on") & F.col("first_group").eqNullSafe(F.col("last_group"))
    e = e.withColumn("_run", F.sum(F.when(filled, 0).otherwise(1)).over(so_far))
    in_run = Window.partitionBy("_run").orderBy("_part").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    e = e.withColumn("_group_rows", F.sum("last_group_rows").over(in_run))
    e = e.withColumn("before", F.when(F.col("_goes_on"), F.lag("_group_rows").over(along)).otherwise(F.lit(0)))
    # The rank that the last block of a partition began with, where it began there.
    began = ~(F.col("_tie_goes_on") & F.col("first_key").eqNullSafe(F.col("last_key")))
    in_first = F.col("last_group").eqNullSafe(F.col("first_group"))
    rank = F.col("last_rank") + F.when(in_first, F.col("before")).otherwise(0)
    e = e.withColumn("_began", F.when(began, rank))
    e = e.withColumn("_held", F.last("_began", ignorenulls=True).over(so_far))
    return e.select(F.col("_part").alias("_p"), "first_group", "first_key", "before",
                    F.when(F.col("_tie_goes_on"), F.lag("_held").over(along)).alias("tie_rank"))


def rank_desc(df: DataFrame, group: list[str], value: str, out: str) -> DataFrame:
    """``rank()`` by ``value`` descending within ``group``, as column ``out``."""
    spark = df.sparkSession
    order = [*[F.col(c).asc_nulls_first() for c in group], F.col(value).desc_nulls_last(), "_row"]
    path = fresh_dir(spark, "ranked")
    # The row number only parts blocks of equal values; any numbering will do.
    (df.withColumn("_row", F.monotonically_increasing_id()).repartitionByRange(*order)
     .withColumn("_part", F.spark_partition_id()).write.parquet(path))
    staged = spark.read.parquet(path)

    g, key = F.struct(*group), F.struct(*group, value)
    in_group = Window.partitionBy("_part", *group).orderBy(F.col(value).desc_nulls_last())
    in_part = Window.partitionBy("_part").orderBy(*order)
    local = (staged.withColumn("_rank", F.rank().over(in_group))
             .withColumn("_at", F.row_number().over(in_part)))
    ends = local.groupBy("_part").agg(
        F.min_by(g, "_at").alias("first_group"), F.max_by(g, "_at").alias("last_group"),
        F.min_by(key, "_at").alias("first_key"), F.max_by(key, "_at").alias("last_key"),
        F.max_by("_rank", "_at").alias("last_rank"))
    last_rows = (local.groupBy("_part", *group).agg(F.count(F.lit(1)).alias("_n"), F.max("_at").alias("_last"))
                 .groupBy(F.col("_part").alias("_q")).agg(F.max_by("_n", "_last").alias("last_group_rows")))
    carried = _carried(ends.join(last_rows, F.col("_part") == F.col("_q")).drop("_q"))
    j = local.join(carried, F.col("_part") == F.col("_p"))
    rank = (F.when(F.col("tie_rank").isNotNull() & key.eqNullSafe(F.col("first_key")), F.col("tie_rank"))
            .otherwise(F.col("_rank") + F.when(g.eqNullSafe(F.col("first_group")), F.col("before")).otherwise(0)))
    return j.select(*df.columns, rank.cast("int").alias(out))
