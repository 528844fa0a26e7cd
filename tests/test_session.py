from __future__ import annotations

import os
from types import SimpleNamespace

import pytest

from demandlake.session import scratch_path, shared_dir


class Context:
    """Stands in for a Spark context without a checkpoint folder."""

    folder = None

    def __init__(self, master="local[2]"):
        self.master = master

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


def test_the_configured_folder_is_used(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    assert scratch_path(spark, "x") != scratch_path(spark, "x")


def test_an_unset_folder_is_set_once():
    session = SimpleNamespace(conf={}, sparkContext=Context())
    first = shared_dir(session)
    assert os.path.isdir(first) and shared_dir(session) == first


@pytest.mark.parametrize("master", ["spark://host:7077", "yarn", "k8s://host", "local-cluster[3,1,1024]"])
def test_a_cluster_needs_a_shared_folder(master):
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(SimpleNamespace(conf={}, sparkContext=Context(master)))
