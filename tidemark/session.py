"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every plan here relies on. All of them can be changed at run time, so
# they are applied to a session that somebody else has built as well.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}

# Shuffled rows take twelve times their compressed size when they are sorted: partitions of
# Spark's 64 MB then take 750 MB of a task. So this is the most, also where somebody has set more.
ADVISORY, ADVISORY_MB = "spark.sql.adaptive.advisoryPartitionSizeInBytes", 16


def build_session(app_name: str = "tidemark", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings above; ``conf`` keys use ``__`` for dots."""
    # Tables that are loaded at the same time share the executors evenly.
    builder = SparkSession.builder.appName(app_name).config("spark.scheduler.mode", "FAIR")
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return prepare(builder.getOrCreate())


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the run-time settings to an existing session."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    advisory = spark.conf.get(ADVISORY, None)
    if advisory is None or spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(advisory) > ADVISORY_MB << 20:
        spark.conf.set(ADVISORY, f"{ADVISORY_MB}m")
    return spark


def shared_root(spark: SparkSession) -> str:
    """The folder all executors can reach.

    The cluster names it in ``spark.checkpoint.dir``. Only a local session, where
    every executor is this machine, may fall back to a temporary folder.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if spark.sparkContext.master.startswith("local"):
        return tempfile.mkdtemp(prefix="tidemark-")
    raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")


def scratch(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder; nothing is ever overwritten there."""
    return f"{shared_root(spark)}/tidemark/{label}-{uuid.uuid4().hex}"
