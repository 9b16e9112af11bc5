"""Checkpoint-folder policy, with a stand-in for the session (no second JVM)."""

from __future__ import annotations

import pytest

from slugmend.session import checkpoint_dir


class _Ctx:
    def __init__(self, master, current=None):
        self.master, self.current = master, current

    def getCheckpointDir(self):
        return self.current

    def setCheckpointDir(self, d):
        self.current = d


class _Conf:
    def __init__(self, values):
        self.values = values

    def get(self, key, default=None):
        return self.values.get(key, default)


class _Session:
    def __init__(self, master, conf=None, current=None):
        self.sparkContext = _Ctx(master, current)
        self.conf = _Conf(conf or {})


def test_cluster_without_checkpoint_dir_is_an_error():
    with pytest.raises(ValueError):
        checkpoint_dir(_Session("yarn"))


def test_configured_folder_is_used():
    s = _Session("yarn", {"spark.checkpoint.dir": "hdfs:///shared/ckpt"})
    assert checkpoint_dir(s) == "hdfs:///shared/ckpt"


def test_folder_already_set_on_the_context_wins():
    s = _Session("k8s://x", {"spark.checkpoint.dir": "hdfs:///a"}, current="hdfs:///b")
    assert checkpoint_dir(s) == "hdfs:///b"


def test_local_session_gets_a_scratch_folder():
    s = _Session("local[2]")
    assert checkpoint_dir(s).startswith("/")
