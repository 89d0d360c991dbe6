"""Scratch-folder rules: the cluster's spark.checkpoint.dir, never a local
temporary folder outside local mode."""

import pytest

from tidemark.session import shared_dir


class _Conf:
    def __init__(self, values):
        self.values = values

    def get(self, key, default=None):
        return self.values.get(key, default)


class _Context:
    def __init__(self, master, conf):
        self.master = master
        self._conf = _Conf(conf)
        self._dir = None

    def getCheckpointDir(self):
        return self._dir

    def getConf(self):
        return self._conf

    def setCheckpointDir(self, path):
        self._dir = path + "/run-1"


class _Session:
    def __init__(self, master, conf):
        self.sparkContext = _Context(master, conf)


def test_cluster_without_checkpoint_dir_is_refused():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(_Session("yarn", {}))


def test_cluster_uses_the_configured_shared_folder():
    s = _Session("yarn", {"spark.checkpoint.dir": "s3a://bucket/ckpt"})
    assert shared_dir(s) == "s3a://bucket/ckpt/run-1"


def test_local_session_gets_a_temporary_folder():
    s = _Session("local[4]", {})
    assert shared_dir(s).endswith("/run-1")
