from __future__ import annotations

import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from tillflow.session import local_session

    s = local_session("*", shuffle_partitions=8, app="tillflow-tests")
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    """A fresh folder for one test (never cleared, never reused)."""
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")
