"""Scratch locations come from the session's checkpoint folder."""

from __future__ import annotations

import os

from tillflow.plans.scratch import fresh_dir, path_exists, scratch_root, stable_dir


def test_scratch_root_is_the_session_checkpoint_folder(spark):
    root = scratch_root(spark)
    assert root == spark.sparkContext.getCheckpointDir().rstrip("/")
    a, b = fresh_dir(spark, "x"), fresh_dir(spark, "x")
    assert a != b and a.startswith(root) and b.startswith(root)
    assert stable_dir(spark, "y") == stable_dir(spark, "y")


def test_a_cluster_without_a_shared_folder_is_refused():
    import pytest

    class Conf:
        def get(self, key, default=None):
            return {"spark.master": "yarn"}.get(key, default)

    class Context:
        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_root(Session())


def test_path_exists(spark):
    path = fresh_dir(spark, "exists")
    assert not path_exists(spark, path)
    spark.range(3).write.parquet(path)
    assert path_exists(spark, path)


def test_path_is_looked_up_without_a_listing(spark, tmp_dir):
    from tillflow.plans.scratch import path_exists

    os.makedirs(f"{tmp_dir}/a[1]{{2}}")
    assert path_exists(spark, f"{tmp_dir}/a[1]{{2}}") and path_exists(spark, f"file:{tmp_dir}")
    assert not path_exists(spark, f"{tmp_dir}/b") and not path_exists(spark, f"{tmp_dir}/*")
