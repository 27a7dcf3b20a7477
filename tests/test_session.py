"""The shared checkpoint folder comes from the session; no local fallback on a cluster."""

import pytest

from tallow.session import checkpoint_root, shared_dir


class _Conf(dict):
    def get(self, key, default=None):  # noqa: D401 - SparkConf/RuntimeConfig-like
        if key in self:
            return self[key]
        if default is None and isinstance(self, _Runtime):
            raise KeyError(key)
        return default


class _Runtime(_Conf):
    def set(self, key, value):
        self[key] = value


class _Context:
    def __init__(self, master, conf):
        self.master, self._conf, self.dir = master, _Conf(conf), None

    def getConf(self):
        return self._conf

    def getCheckpointDir(self):
        return self.dir

    def setCheckpointDir(self, d):
        self.dir = d


class _Session:
    def __init__(self, master, conf=None):
        self.sparkContext = _Context(master, conf or {})
        self.conf = _Runtime()


def test_cluster_without_checkpoint_dir_is_an_error():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        checkpoint_root(_Session("yarn"))


def test_configured_checkpoint_dir_is_used_on_a_cluster():
    s = _Session("yarn", {"spark.checkpoint.dir": "hdfs://nn/chk"})
    assert checkpoint_root(s) == "hdfs://nn/chk"
    assert s.sparkContext.dir == "hdfs://nn/chk"
    assert shared_dir(s, "landing").startswith("hdfs://nn/chk/landing/")


def test_local_session_gets_a_scratch_folder():
    s = _Session("local[2]")
    root = checkpoint_root(s)
    assert root and s.conf["spark.checkpoint.dir"] == root and s.sparkContext.dir == root
