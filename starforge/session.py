"""Spark session settings and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings that matter for correctness (UTC, ANSI) and for plan quality (AQE).
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_dropped(spark: SparkSession):
    """Drop the shuffle files of each job at its end instead of when the driver collects garbage.

    For jobs that write a table: what follows reads the table.  The setting is put back.
    """
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)


def get_session(master: str = "local[8]", shuffle_partitions: int = 8,
                app_name: str = "starforge", extra: dict | None = None) -> SparkSession:
    """Local session for tests, bench and the smoke entry point.

    On a cluster the session comes from the launcher; only the settings in
    ``BASE_CONF`` are expected there, and ``spark.sql.shuffle.partitions`` is
    sized to the data (about 128-256 MB of shuffle data per partition).
    """
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(BASE_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.setdefault("spark.driver.memory", os.environ.get("STARFORGE_DRIVER_MEMORY", "8g"))
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting a local one only if unset.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is used
    as is.  Only a local-mode session without the setting (tests, bench) gets
    a fresh folder under /tmp.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return sc.getCheckpointDir() or current
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    path = tempfile.mkdtemp(prefix="starforge-ckpt-")
    sc.setCheckpointDir(path)
    spark.conf.set("spark.checkpoint.dir", path)
    return sc.getCheckpointDir() or path


def scratch_path(spark: SparkSession, purpose: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder for staged tables."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{root}/{purpose}-{uuid.uuid4().hex}"
