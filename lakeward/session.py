"""Spark session helpers."""

from __future__ import annotations

import os
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

#: A writing job's shuffle files go when it ends; else they stay until the driver collects garbage, job upon job.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def get_spark(app: str = "lakeward", master: str | None = None, shuffle_partitions: int | None = None) -> SparkSession:
    """Session with the settings the library assumes.

    UTC session time zone, ANSI mode (the Spark 4 default), AQE with
    partition coalescing and skew-join splitting, and no UI server.
    On a cluster, ``master`` stays None and the cluster's own settings win.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
        if master.startswith("local"):
            # local mode runs everything in the driver JVM; its heap must be
            # sized before the JVM starts (the default is 1 GiB)
            b = b.config("spark.driver.memory", os.environ.get("LAKEWARD_DRIVER_MEMORY", "16g"))
    # only a caller or a local test session sets the number; a cluster's own setting is left alone
    if shuffle_partitions or (master and master.startswith("local")):
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions or 8))
    b = (
        b.config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder that ``spark.checkpoint.dir`` names, which driver and executors share.

    Only a local session without one gets a scratch folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    scratch = tempfile.mkdtemp(prefix="lakeward-shared-")
    spark.sparkContext.setCheckpointDir(scratch)
    return scratch


@contextmanager
def settings(spark: SparkSession, wanted: dict[str, str]) -> Iterator[None]:
    """The session's settings while jobs are started and run."""
    before = {k: spark.conf.get(k) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
