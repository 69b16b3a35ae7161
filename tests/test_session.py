"""The shared folder: taken from the session, required on a cluster, below the warehouse in local sessions."""

import threading
from types import SimpleNamespace

import pytest

from stakeflow.errors import ArtifactError
from stakeflow.session import at_once, ensure_checkpoint_dir


def fake(master, **conf):
    state = SimpleNamespace(dir=None)
    sc = SimpleNamespace(master=master, getCheckpointDir=lambda: state.dir, setCheckpointDir=lambda d: setattr(state, "dir", d))
    return SimpleNamespace(sparkContext=sc, conf=SimpleNamespace(get=lambda k, *default: conf.get(k, *default))), state


def test_folder_of_the_session_is_used():
    spark, state = fake("spark://host:7077", **{"spark.checkpoint.dir": "hdfs:///shared"})
    assert ensure_checkpoint_dir(spark) == "hdfs:///shared" == state.dir


def test_a_cluster_without_shared_folder_is_an_error():
    for master in ("spark://host:7077", "yarn", "local-cluster[2,1,1024]"):
        spark, _ = fake(master, **{"spark.sql.warehouse.dir": "file:/w"})
        with pytest.raises(ArtifactError):
            ensure_checkpoint_dir(spark)


def test_local_sessions_use_the_warehouse():
    spark, _ = fake("local[4]", **{"spark.sql.warehouse.dir": "file:/w/"})
    assert ensure_checkpoint_dir(spark) == "file:/w/_checkpoints"


def test_a_folder_that_is_set_stays():
    spark, state = fake("yarn")
    state.dir = "s3a://bucket/ckpt"
    assert ensure_checkpoint_dir(spark) == "s3a://bucket/ckpt"


def test_independent_parts_run_side_by_side(spark):
    """Each part waits until all have begun; results keep the order of the parts."""
    begun = threading.Barrier(3, timeout=30)

    def run(n):
        begun.wait()
        return spark.range(n).count()

    assert at_once(spark, run, [3, 1, 2]) == [3, 1, 2]
    assert at_once(spark, run, []) == []
