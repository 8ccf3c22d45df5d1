"""Scratch-folder rules: read spark.checkpoint.dir; a local fallback only in local mode."""

import pytest


class _Conf(dict):
    def get(self, key, default=None):
        return dict.get(self, key, default)

    def set(self, key, value):
        self[key] = value


class _Context:
    def __init__(self, master):
        self.master = master

    def getConf(self):
        return _Conf()


class _Session:
    def __init__(self, master, conf=None):
        self.conf = _Conf(conf or {})
        self.sparkContext = _Context(master)


def test_unset_checkpoint_dir_is_an_error_on_a_cluster():
    from lading.session import checkpoint_dir
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        checkpoint_dir(_Session("yarn"))


def test_configured_checkpoint_dir_is_used(spark):
    from lading.session import checkpoint_dir, scratch_path
    configured = spark.conf.get("spark.checkpoint.dir")
    assert checkpoint_dir(spark) == configured
    assert scratch_path(spark, "t").startswith(configured)
