"""JDBC helpers without a database: options, and errors that propagate."""

from __future__ import annotations

import pytest

from tillflow.sources.jdbc import append_jdbc, jdbc_read_options


def test_partitioned_read_options():
    opts = jdbc_read_options("jdbc:x://h/db", "customer", {"user": "u"},
                             partition_column="customer_id", lower_bound=1,
                             upper_bound=1000, num_partitions=8)
    assert opts["partitionColumn"] == "customer_id"
    assert (opts["lowerBound"], opts["upperBound"], opts["numPartitions"]) == ("1", "1000", "8")
    assert opts["user"] == "u" and opts["dbtable"] == "customer"


def test_partitioned_read_needs_bounds():
    with pytest.raises(ValueError):
        jdbc_read_options("jdbc:x://h/db", "t", partition_column="id")


def test_append_failure_propagates(spark):
    df = spark.range(3)
    with pytest.raises(Exception):
        append_jdbc(df, "jdbc:nosuchdriver://nowhere/db", "t")
