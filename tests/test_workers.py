"""Workers need no copy of the package: a session started elsewhere, whose workers can't
import it, runs a query that has Python in its tasks."""

from __future__ import annotations

import os
import subprocess
import sys

from conftest import ROOT, SF_SMALL

SCRIPT = """
import sys
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", "2").getOrCreate())
sys.path.insert(0, {root!r})
import __spark_entry__ as entry
def importable(_):
    import importlib.util
    return [importlib.util.find_spec("tillflow") is not None]
assert not any(spark.sparkContext.parallelize([0], 1).mapPartitions(importable).collect())
for name in {names!r}:
    assert entry.queries()[name](spark, {sf!r}).count() > 0, name
print("RAN")
"""


def run_elsewhere(names, folder):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    script = SCRIPT.format(root=ROOT, names=names, sf=SF_SMALL)
    got = subprocess.run([sys.executable, "-c", script], cwd=folder, env=env, capture_output=True, text=True)
    assert "RAN" in got.stdout, got.stderr[-2000:]


def test_queries_run_from_another_directory(tmp_dir):
    run_elsewhere(["csv_header_gate"], tmp_dir)
