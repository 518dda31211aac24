"""Spark session helpers.

The library never starts a session on its own inside an operator; these helpers are
for scripts, tests and the bench. ``shared_dir`` resolves the cluster-wide scratch
folder from ``spark.checkpoint.dir`` so nothing is written to a machine-local path
on a cluster.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession


def get_spark(app: str = "postmart", cpus: int | str = "*", shuffle_partitions: int | None = None,
              extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the settings the operators are tuned for.

    Under spark-submit, which names a master, the cluster's own master, memory and number of
    shuffle partitions stay as they are.
    """
    builder = SparkSession.builder.appName(app)
    # spark-submit starts the JVM first and names its port; its master then holds.
    submitted = "PYSPARK_GATEWAY_PORT" in os.environ or "--master" in os.environ.get("PYSPARK_SUBMIT_ARGS", "")
    if not submitted and SparkSession.getActiveSession() is None:
        parts = shuffle_partitions or (8 if cpus == "*" else max(int(cpus), 1))
        builder = (builder.master(f"local[{cpus}]").config("spark.sql.shuffle.partitions", str(parts))
                   .config("spark.driver.memory", "16g"))
    elif shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    builder = (
        builder
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint folder; set a local one only when none is configured.

    On a cluster ``spark.checkpoint.dir`` names a shared folder (HDFS / object store) and
    is used as is. Only a bare local session (tests) gets a fresh temporary folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="postmart-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def shared_dir(spark: SparkSession, *parts: str) -> str:
    """A path under the shared scratch folder (the parent of the checkpoint folder)."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir", None)
    if not base:
        base = ensure_checkpoint_dir(spark)
    base = base.rstrip("/")
    return "/".join([base, "postmart", *parts])


SCRATCH_CONF = "spark.postmart.scratchDir"


def fresh_dir(spark: SparkSession, name: str) -> str:
    """A new, unique folder for intermediate tables.

    Under ``spark.postmart.scratchDir`` when a job has set it (a load points it into its
    own run folder, so intermediates live and go with that run), else under the shared
    scratch folder derived from ``spark.checkpoint.dir``.
    """
    leaf = f"{name}-{uuid.uuid4().hex[:12]}"
    root = spark.conf.get(SCRATCH_CONF, None)
    return f"{root.rstrip('/')}/{leaf}" if root else shared_dir(spark, leaf)


@contextmanager
def scratch_under(spark: SparkSession, path: str):
    """Within the block, intermediate tables go under ``path``."""
    old = spark.conf.get(SCRATCH_CONF, None)
    spark.conf.set(SCRATCH_CONF, path)
    try:
        yield path
    finally:
        if old is None:
            spark.conf.unset(SCRATCH_CONF)
        else:
            spark.conf.set(SCRATCH_CONF, old)


__all__ = ["get_spark", "ensure_checkpoint_dir", "shared_dir", "fresh_dir", "scratch_under"]
