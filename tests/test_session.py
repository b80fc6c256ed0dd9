import pytest

from labwire.session import checkpoint_dir


class _Conf:
    def __init__(self, values):
        self.values = values

    def get(self, key, default=None):
        return self.values.get(key, default)


class _Context:
    def __init__(self, master, conf):
        self.master = master
        self._conf = _Conf(conf)
        self.dir = None

    def getCheckpointDir(self):  # noqa: N802 - Spark's API
        return self.dir

    def getConf(self):  # noqa: N802
        return self._conf

    def setCheckpointDir(self, d):  # noqa: N802
        self.dir = d


class _Session:
    def __init__(self, master, conf=None):
        self.sparkContext = _Context(master, conf or {})
        self.conf = _Conf(conf or {})


def test_cluster_without_checkpoint_folder_fails():
    with pytest.raises(RuntimeError):
        checkpoint_dir(_Session("yarn"))


def test_configured_folder_is_used():
    s = _Session("yarn", {"spark.checkpoint.dir": "hdfs:///shared/ckpt"})
    assert checkpoint_dir(s) == "hdfs:///shared/ckpt"


def test_local_mode_falls_back_to_a_fresh_folder():
    s = _Session("local[4]")
    d = checkpoint_dir(s)
    assert d and "labwire-ckpt-" in d
