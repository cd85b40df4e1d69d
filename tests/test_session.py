from types import SimpleNamespace

import pytest

from comanda.session import ensure_checkpoint_dir


def session(master, named=None, current=None):
    """A stand-in with just the settings that the choice of the folder reads."""
    sc = SimpleNamespace(master=master, dir=current)
    sc.getCheckpointDir = lambda: sc.dir
    sc.setCheckpointDir = lambda path: setattr(sc, "dir", path)
    sc.getConf = lambda: SimpleNamespace(get=lambda key, default=None: default)
    conf = SimpleNamespace(get=lambda key, default=None: named if key == "spark.checkpoint.dir" and named else default)
    return SimpleNamespace(sparkContext=sc, conf=conf)


def test_the_shared_folder_is_used():
    assert ensure_checkpoint_dir(session("yarn", named="hdfs:///shared")) == "hdfs:///shared"
    assert ensure_checkpoint_dir(session("yarn", named="hdfs:///shared", current="hdfs:///set")) == "hdfs:///set"


def test_a_scratch_folder_only_in_local_mode():
    assert "comanda-checkpoint-" in ensure_checkpoint_dir(session("local[2]"))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(session("spark://host:7077"))


def test_of_the_running_session(spark):
    assert ensure_checkpoint_dir(spark).rsplit("/", 2)[1] == "checkpoints"
