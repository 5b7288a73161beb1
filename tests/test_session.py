"""The shared checkpoint folder comes from the session."""

import pytest

from pricenet import session as S


def test_tables_go_under_the_session_folder(spark):
    root = S.ensure_checkpoint_dir(spark)
    df = S.cut_lineage(spark.range(10))
    assert df.count() == 10
    bare = root.replace("file:", "")
    assert all(bare in f for f in df.inputFiles())


class _Conf:
    def __init__(self, values):
        self.values = values

    def get(self, key, default=None):
        return self.values.get(key, default)

    def set(self, key, value):  # static settings cannot be changed at runtime
        raise AssertionError(f"must not set {key}")


class _SC:
    def __init__(self, master, ckpt=None):
        self.master, self.ckpt = master, ckpt

    def getCheckpointDir(self):
        return self.ckpt

    def setCheckpointDir(self, d):
        self.ckpt = d

    def getConf(self):
        return _Conf({})


class _Session:
    def __init__(self, master, conf=None, ckpt=None):
        self.conf = _Conf(conf or {})
        self.sparkContext = _SC(master, ckpt)


def test_configured_folder_wins():
    s = _Session("yarn", conf={"spark.checkpoint.dir": "hdfs:///shared/ckpt"})
    assert S.ensure_checkpoint_dir(s) == "hdfs:///shared/ckpt"
    assert s.sparkContext.ckpt == "hdfs:///shared/ckpt"


def test_local_fallback_is_set_once_on_the_context():
    s = _Session("local[4]")
    first = S.ensure_checkpoint_dir(s)
    assert first and s.sparkContext.ckpt == first
    assert S.ensure_checkpoint_dir(s) == first


def test_cluster_without_folder_refuses():
    with pytest.raises(RuntimeError):
        S.ensure_checkpoint_dir(_Session("yarn"))
