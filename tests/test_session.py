"""Checkpoint folder policy: read it from the session; a machine-local fallback only in local mode."""

import pytest

from tablescout.session import checkpoint_dir


class _Conf:
    def __init__(self, value):
        self.value = value

    def get(self, key, default=None):
        return self.value if key == "spark.checkpoint.dir" else default


class _Context:
    def __init__(self, master, current=None):
        self.master = master
        self.current = current
        self.set_to = None

    def getCheckpointDir(self):
        return self.current or self.set_to

    def setCheckpointDir(self, d):
        self.set_to = d


class _Session:
    def __init__(self, master, conf=None, current=None):
        self.sparkContext = _Context(master, current)
        self.conf = _Conf(conf)


def test_cluster_without_checkpoint_dir_raises():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        checkpoint_dir(_Session("yarn"))


def test_configured_dir_is_used():
    s = _Session("yarn", conf="hdfs:///shared/ckpt")
    assert checkpoint_dir(s) == "hdfs:///shared/ckpt"
    assert checkpoint_dir(_Session("k8s://x", current="s3a://b/ckpt")) == "s3a://b/ckpt"


def test_local_mode_may_fall_back():
    s = _Session("local[4]")
    d = checkpoint_dir(s)
    assert d and s.sparkContext.set_to == d
