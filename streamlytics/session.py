"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Session-scoped settings every plan in this package relies on. Epoch-millisecond columns are
# turned into timestamps and calendar strings, so the zone has to be fixed.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}

STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
# Keyed state: a commit writes what changed and not the whole store, a write does not look its key up for a count of
# rows, and the four tables of a stream-stream join are one store.
STATE_CONF = {
    STATE_STORE: ROCKSDB,
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
    "spark.sql.streaming.join.stateFormatVersion": "3",
}


def build_session(app: str = "streamlytics", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the package defaults; extra settings use ``__`` for the dots of the key."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SESSION_CONF, **STATE_CONF}.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def tune(spark: SparkSession) -> SparkSession:
    """Apply the session-scoped defaults to a session somebody else made."""
    for key, value in {**SESSION_CONF, **STATE_CONF}.items():
        spark.conf.set(key, value)
    return spark


def shared_root(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Only a ``local`` master may go without the setting: a machine-local folder on a cluster would
    be lost with its machine and unseen by the others.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every node can reach")
        root = tempfile.mkdtemp(prefix="streamlytics-")
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


def shared_dir(spark: SparkSession, *parts: str, unique: bool = True) -> str:
    """A path below the shared folder; ``unique`` appends a fresh name so runs never collide."""
    pieces = [shared_root(spark), *parts]
    if unique:
        pieces.append(uuid.uuid4().hex)
    return "/".join(pieces)


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write an intermediate result to the shared folder and read it back.

    Later steps then neither recompute it nor lose it with an executor.
    """
    path = shared_dir(df.sparkSession, "tables", label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
