"""The checkpoint folder: taken from the cluster, a scratch folder only for a local master."""

import pytest

from lumisort.session import checkpoint_root


class _Conf(dict):
    def get(self, key, default=None):
        return super().get(key, default)


class _SC:
    def __init__(self, master, ctx_dir=None, conf=None):
        self.master, self._dir, self._conf = master, ctx_dir, _Conf(conf or {})

    def getCheckpointDir(self):
        return self._dir

    def setCheckpointDir(self, d):
        self._dir = d

    def getConf(self):
        return self._conf


class _Spark:
    def __init__(self, sc, conf=None):
        self.sparkContext, self.conf = sc, _Conf(conf or {})


def test_cluster_refuses_a_folder_of_one_machine():
    with pytest.raises(RuntimeError):
        checkpoint_root(_Spark(_SC("yarn"), {"spark.checkpoint.dir": "file:///tmp/ckpt"}))


def test_cluster_folder_is_used():
    s = _Spark(_SC("yarn"), {"spark.checkpoint.dir": "hdfs:///shared/ckpt"})
    assert checkpoint_root(s) == "hdfs:///shared/ckpt"


def test_context_folder_wins():
    s = _Spark(_SC("yarn", ctx_dir="s3a://bucket/ckpt"))
    assert checkpoint_root(s) == "s3a://bucket/ckpt"


def test_cluster_without_folder_is_an_error():
    with pytest.raises(RuntimeError):
        checkpoint_root(_Spark(_SC("spark://host:7077")))


def test_local_master_gets_a_scratch_folder():
    s = _Spark(_SC("local[4]"))
    d = checkpoint_root(s)
    assert d and s.sparkContext.getCheckpointDir() == d
