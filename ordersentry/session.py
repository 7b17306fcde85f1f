"""Spark session settings the engine relies on.

Everything time related assumes a UTC session zone: hours of the day,
``to_date`` and the day partitions are all taken in UTC.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings applied to every session the engine builds or adopts.
ENGINE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # What one task sorts after a shuffle: a screening task holds some 18 times
    # these bytes in its sorts, so the default of 64 MB takes more than 1 GB.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(16 * 1024 * 1024),
    # Broadcast only what the optimizer (and AQE at runtime) has measured
    # below this size; anything larger is joined by sort-merge.
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # A message that repeats a field counts with the last one, as JSON readers commonly do.
    "spark.sql.variant.allowDuplicateKeys": "true",
    # Messages are read back whole, so a writer need not look for fields to shred
    # them by: it takes longer than all other columns of an order.
    "spark.sql.variant.inferShreddingSchema": "false",
    # The engine caches a micro-batch, whose ids, texts and messages hardly compress:
    # trying takes two thirds of the time of decoding them, for a sixth of the bytes.
    "spark.sql.inMemoryColumnarStorage.compressed": "false",
}


# Results depend on these, so a session that refuses them is an error: hours
# and days are UTC, and a malformed id fails a strict cast instead of becoming NULL.
REQUIRED_CONF = {"spark.sql.session.timeZone": "UTC", "spark.sql.ansi.enabled": "true"}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the engine settings to an existing session (runtime confs only)."""
    for key, value in REQUIRED_CONF.items():
        spark.conf.set(key, value)
    for key, value in ENGINE_CONF.items():
        try:
            spark.conf.set(key, value)
        except Exception:  # static conf on a running session: keep the cluster's value
            pass
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder the cluster names in ``spark.checkpoint.dir``.

    Only a local session without the setting (tests) gets a folder of its
    own; on a cluster a missing setting is an error, since executors do not
    share the driver's disk.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # a remote (Connect) session: the server owns the setting
        sc = None
    if not path and sc is not None:
        path = sc.getCheckpointDir()
    if not path:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        path = tempfile.mkdtemp(prefix="ordersentry-ckpt-")
        spark.conf.set("spark.checkpoint.dir", path)
    if sc is not None and sc.getCheckpointDir() is None:
        sc.setCheckpointDir(path)
    return path


def get_session(app: str = "ordersentry", master: str | None = None,
                shuffle_partitions: int | None = None) -> SparkSession:
    """Build (or adopt) a session with the engine settings.

    Without ``master`` the submitted one holds; tests and the bench pass
    theirs.  The driver's memory is left to the submit settings unless
    ``SPARK_DRIVER_MEMORY`` names one.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    builder = (builder
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false"))
    if memory := os.environ.get("SPARK_DRIVER_MEMORY"):
        builder = builder.config("spark.driver.memory", memory)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (ENGINE_CONF | REQUIRED_CONF).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    configure(spark)
    return spark
