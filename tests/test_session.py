"""Shared scratch folder: required on a cluster, released on request."""

import os
from types import SimpleNamespace

import pytest

from pixelframe import session
from pixelframe.session import checkpoint_dir, release_scratch, scratch_path, scratch_table


def fake(master, configured):
    made = []
    sc = SimpleNamespace(master=master, getCheckpointDir=lambda: made[-1] if made else None, setCheckpointDir=made.append,
                         getConf=lambda: SimpleNamespace(get=lambda k, d=None: configured or d))
    return SimpleNamespace(sparkContext=sc)


@pytest.mark.parametrize("master", ["spark://h:7077", "yarn", "k8s://x", "local-cluster[2,1,1024]"])
def test_cluster_needs_a_shared_folder(master):
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        checkpoint_dir(fake(master, None))
    assert checkpoint_dir(fake(master, "hdfs:///shared")) == "hdfs:///shared"


@pytest.mark.parametrize("master", ["local", "local[4]", "local[*]"])
def test_one_machine_may_use_its_own(master):
    assert os.path.isdir(checkpoint_dir(fake(master, None)))


def test_release(spark):
    release_scratch(spark)
    a, b = scratch_path(spark, "x"), scratch_path(spark, "y")
    spark.range(3).write.parquet(a)
    name = scratch_table(spark, "scratch_release_test")
    spark.range(3).write.option("path", b).saveAsTable(name)
    assert release_scratch(spark) == 2
    assert not spark.catalog.tableExists(name)
    assert not os.path.exists(a.removeprefix("file:")) and not os.path.exists(b.removeprefix("file:"))
    assert session._scratch_of(spark) == ([], [])
