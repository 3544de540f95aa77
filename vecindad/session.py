"""Spark session settings and shared storage locations."""

from __future__ import annotations

import functools
import tempfile

from pyspark.sql import SparkSession

# Partition counts and memory belong to the deployment; what stands here is
# what the jobs rely on.  Row-level joins depend on the adaptive skew split.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A join on several keys whose one side is grouped by some of them is still dealt by all.
    "spark.sql.requireAllClusterKeysForCoPartition": "true",
    # Integer arithmetic on cents must fail on overflow, not wrap around.
    "spark.sql.ansi.enabled": "true",
    # HotSpot does not compile methods above 8000 bytes; wide rows of decimals
    # get there, and then run faster without whole-stage code.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # The history fold is bound by CPU, not by bytes: small inputs still spread.
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k",
}


def build_session(app: str = "vecindad", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the settings above; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master is not None:
        builder = builder.master(master)
    extra = {key.replace("__", "."): value for key, value in conf.items()}
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local session that names none (a test) gets a folder of its own.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a shared folder on a cluster")
    return _local_dir()


@functools.cache
def _local_dir() -> str:
    return tempfile.mkdtemp(prefix="vecindad-")
