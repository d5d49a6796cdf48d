"""Scratch-folder rules: read spark.checkpoint.dir from the session; only a
local session without it gets a temporary folder; a cluster must set it."""

from types import SimpleNamespace

import pytest

from ledgerlake import session
from ledgerlake.session import CLUSTER_CONF, scratch_path, scratch_root


def test_scratch_uses_session_setting(spark):
    root = scratch_root(spark)
    conf = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if conf:
        assert root == conf.rstrip("/")
    p1, p2 = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert p1 != p2 and p1.startswith(root + "/x-")


class _Conf:
    def get(self, key, default=None):
        return default


def test_cluster_without_checkpoint_dir_refuses():
    sc = SimpleNamespace(getConf=lambda: _Conf(), getCheckpointDir=lambda: None,
                         master="yarn", setCheckpointDir=lambda d: None)
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.scratch_root(SimpleNamespace(sparkContext=sc))


def test_cluster_conf_is_scale_oriented():
    assert CLUSTER_CONF["spark.sql.adaptive.enabled"] == "true"
    assert CLUSTER_CONF["spark.sql.adaptive.skewJoin.enabled"] == "true"
    assert CLUSTER_CONF["spark.sql.sources.partitionOverwriteMode"] == "dynamic"
    assert "spark.checkpoint.dir" not in CLUSTER_CONF
