from types import SimpleNamespace

import pytest

from daybridge.sources.scratch import checkpoint_root, scratch_path


class _Context:
    def __init__(self, master, current=None):
        self.master, self._dir = master, current

    def getCheckpointDir(self):
        return self._dir

    def setCheckpointDir(self, d):
        self._dir = d


class _Conf:
    def __init__(self, values):
        self.values = values

    def get(self, key, default=None):
        return self.values.get(key, default)


def _session(master, current=None, conf=None):
    return SimpleNamespace(sparkContext=_Context(master, current), conf=_Conf(conf or {}))


def test_session_setting_wins():
    s = _session("spark://cluster:7077", conf={"spark.checkpoint.dir": "hdfs:///shared/ckpt"})
    assert checkpoint_root(s) == "hdfs:///shared/ckpt"
    assert scratch_path(s, "x").startswith("hdfs:///shared/ckpt/daybridge/x-")


def test_existing_checkpoint_dir_is_used():
    assert checkpoint_root(_session("yarn", current="s3://bucket/ckpt/abc")) == "s3://bucket/ckpt/abc"


def test_cluster_without_setting_refuses_a_local_folder():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        checkpoint_root(_session("yarn"))


def test_local_master_gets_a_folder_of_its_own():
    assert checkpoint_root(_session("local[2]")).startswith("/")
