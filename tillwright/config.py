"""Session settings and the shared working folder.

Operators never create a session; callers (tests, bench, jobs) do. The
shared folder for lineage cuts, stream checkpoints and versioned tables is
the cluster's ``spark.checkpoint.dir``. Only when that is unset (local
tests) do we pick a fresh local folder.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Shuffle files go with the execution that wrote them, not when the driver happens to collect its garbage.
FREED_SHUFFLES = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}


def local_session(
    cpus: int | str = "*",
    shuffle_partitions: int = 8,
    app_name: str = "tillwright",
) -> SparkSession:
    """A local session for tests and the benchmark (UI off, UTC, AQE on)."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("TILLWRIGHT_DRIVER_MEMORY", "8g"))
        .config("spark.sql.streaming.forceDeleteTempCheckpointLocation", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def configured_dir(spark: SparkSession) -> str | None:
    """The folder that ``spark.checkpoint.dir`` names, the same for every application."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    try:
        return spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    except Exception:  # a Spark Connect session has no SparkContext
        return None


def shared_dir(spark: SparkSession) -> str:
    """The cluster-wide folder named by ``spark.checkpoint.dir``.

    Set one of our own only where the session has none (local tests).
    """
    try:
        sc = spark.sparkContext
    except Exception:  # a Spark Connect session has no SparkContext
        sc = None
    if sc is not None and sc.getCheckpointDir():
        return sc.getCheckpointDir()
    configured = configured_dir(spark)
    if configured:
        if sc is not None:
            sc.setCheckpointDir(configured)
            return sc.getCheckpointDir() or configured
        return configured
    if sc is None or not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir is not set; name a folder that driver and executors share")
    local = tempfile.mkdtemp(prefix="tillwright-ckpt-", dir="/tmp")
    if sc is not None:
        sc.setCheckpointDir(local)
        return sc.getCheckpointDir() or local
    return local


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique sub-path of the shared folder for one run."""
    base = shared_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"


@contextmanager
def session_settings(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    """``settings`` hold for what is run or started inside (a stream keeps those it is started with); then the session has its own again."""
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)
