from types import SimpleNamespace

import pytest

from ontime.session import INITIAL_PARTITIONS, enable_checkpoints, open_session, shared_folder


def pretend(master, folder=None):
    """Just enough of a session to ask where its folder is."""
    conf = SimpleNamespace(get=lambda key, default=None: folder if key == "spark.checkpoint.dir" else default)
    context = SimpleNamespace(applicationId=f"app-{master}-{folder}", master=master)
    return SimpleNamespace(conf=conf, sparkContext=context)


def test_a_cluster_needs_a_shared_folder():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(pretend("spark://host:7077"))
    assert shared_folder(pretend("spark://host:7077", "hdfs:///shared/")).startswith("hdfs:///shared/ontime-app-")


def test_a_local_session_may_do_without():
    assert shared_folder(pretend("local[2]")) == shared_folder(pretend("local[2]"))


def test_open_session_returns_the_running_session_with_adaptive_execution(spark):
    opened = open_session()
    assert opened.sparkContext.applicationId == spark.sparkContext.applicationId
    assert opened.conf.get("spark.sql.adaptive.skewJoin.enabled") == "true"
    assert int(opened.conf.get(INITIAL_PARTITIONS)) >= opened.sparkContext.defaultParallelism


def test_checkpoints_go_to_the_shared_folder(spark):
    enable_checkpoints(spark)
    assert spark.conf.get("spark.checkpoint.dir") in spark.sparkContext.getCheckpointDir()
