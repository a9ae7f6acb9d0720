"""Checkpoint folder: the session's setting first; a local folder only in local mode."""

from __future__ import annotations

import pytest

from daybook.session import ensure_checkpoint_dir


class _Context:
    def __init__(self, master: str, current: str | None = None):
        self.master = master
        self.current = current

    def getCheckpointDir(self):
        return self.current

    def setCheckpointDir(self, path: str) -> None:
        self.current = path


class _Conf:
    def __init__(self, values: dict[str, str]):
        self.values = values

    def get(self, key: str, default=None):
        return self.values.get(key, default)


class _Session:
    def __init__(self, master: str, conf: dict[str, str] | None = None, current: str | None = None):
        self.sparkContext = _Context(master, current)
        self.conf = _Conf(conf or {})


def test_existing_dir_is_kept():
    s = _Session("spark://master:7077", current="hdfs://nn/ckpt")
    assert ensure_checkpoint_dir(s) == "hdfs://nn/ckpt"


def test_cluster_setting_is_used():
    s = _Session("spark://master:7077", {"spark.checkpoint.dir": "s3a://bucket/ckpt"})
    assert ensure_checkpoint_dir(s) == "s3a://bucket/ckpt"
    assert s.sparkContext.getCheckpointDir() == "s3a://bucket/ckpt"


def test_cluster_without_setting_is_refused():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(_Session("spark://master:7077"))


def test_local_without_setting_gets_a_folder():
    s = _Session("local[2]")
    path = ensure_checkpoint_dir(s)
    assert path and s.sparkContext.getCheckpointDir() == path
