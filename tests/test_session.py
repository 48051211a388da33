"""Where intermediate tables go and when small scans are spread."""

from types import SimpleNamespace

import pytest

from webloom.session import scratch_dir, spread


def session(master, shared=None):
    conf = {"spark.checkpoint.dir": shared} if shared else {}
    context = SimpleNamespace(
        master=master, applicationId=f"app-{master}-{shared}", getConf=lambda: SimpleNamespace(get=conf.get)
    )
    return SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda key, default: default))


def test_shared_folder_of_the_cluster_is_used():
    assert scratch_dir(session("yarn", "hdfs://c/tmp/")).startswith("hdfs://c/tmp/webloom-app")
    with pytest.raises(RuntimeError):
        scratch_dir(session("yarn"))


def test_only_scans_with_few_partitions_are_spread(spark):
    cores = spark.sparkContext.defaultParallelism
    few, many = spark.range(0, 10, 1, 1), spark.range(0, 10, 1, cores)
    assert spread(few).rdd.getNumPartitions() == cores
    assert spread(many) is many
