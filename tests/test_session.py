"""Shared folder rules and session settings."""

import pytest

from tillwatch.session import STREAM_CONF, build_session, work_dir


class FakeSession:
    def __init__(self, **conf):
        self.settings = {key.replace("_", "."): value for key, value in conf.items()}
        self.conf = self

    def get(self, key, default=None):
        return self.settings.get(key, default)


def test_the_folder_of_the_session_is_used(spark):
    folder = work_dir(spark, "x")
    assert folder.startswith(spark.conf.get("spark.checkpoint.dir") + "/tillwatch/x-")
    assert folder != work_dir(spark, "x")


def test_a_cluster_must_name_its_folder():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        work_dir(FakeSession(spark_master="yarn"), "x")
    assert work_dir(FakeSession(spark_master="yarn", spark_checkpoint_dir="hdfs:///c/"), "x").startswith("hdfs:///c/tillwatch/x-")
    assert "/tillwatch/x-" in work_dir(FakeSession(spark_master="local[2]"), "x")


def test_session_is_in_utc(spark):
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
    assert build_session("again") is spark or build_session("again").sparkContext is spark.sparkContext


def test_totals_with_state_in_rocksdb(spark, sf_dir):
    from tillwatch.plans import registry

    for key, value in STREAM_CONF.items():
        spark.conf.set(key, value)
    try:
        result = registry.queries()["stream_minute_totals"](spark, sf_dir)
        batch = registry.queries()["minute_totals"](spark, sf_dir)
        assert result.count() == batch.count() and result.exceptAll(batch).isEmpty()
    finally:
        for key in STREAM_CONF:
            spark.conf.unset(key)
