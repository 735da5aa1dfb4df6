"""Session set-up and the shared folder for written intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Event times carry an offset; zone-less ones are read as UTC.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
}

UTC_ZONES = ("UTC", "Etc/UTC", "Z", "GMT", "+00:00")

# Streaming state lives in RocksDB, off the JVM heap, and each commit uploads
# only the changes since the last snapshot.
STREAM_CONF = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def build_session(app_name: str, master: str | None = None, streaming: bool = False, **conf: str) -> SparkSession:
    """Session with UTC event times; ``conf`` keys use ``__`` for a dot.

    On a cluster leave ``master`` unset so that ``spark-submit`` decides. The
    number of state partitions is ``spark.sql.shuffle.partitions`` at the first
    start of a stream and cannot change afterwards.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = BASE_CONF | (STREAM_CONF if streaming else {})
    settings |= {key.replace("__", "."): value for key, value in conf.items()}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def work_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder below ``spark.checkpoint.dir`` that every executor can reach.

    Only a local session may fall back to a folder of this machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        root = tempfile.mkdtemp(prefix="tillwatch-")
    return f"{root.rstrip('/')}/tillwatch/{label}-{uuid.uuid4().hex}"
