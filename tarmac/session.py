"""Session settings and the shared folder used to cut lineage."""

from __future__ import annotations

import os
import tempfile
import threading
import uuid

from pyspark.sql import DataFrame, SparkSession


FEW_ROWS = 10_000  # that one task works through sooner than a shuffle would pay
_CHOICE = threading.Lock()
_FALLBACK: dict[str, str] = {}  # folder by application


def local_session(cores: str = "8", shuffle_partitions: int = 8) -> SparkSession:
    """Session for tests and bench runs on one machine; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tarmac")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("TARMAC_DRIVER_MEMORY", "8g"))
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach.

    ``spark.checkpoint.dir`` decides, else the folder given to ``setCheckpointDir``.  Only a local master may fall back
    to a temporary folder, one per application; that setting cannot be changed once a session runs.
    """
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or _FALLBACK.get(context.applicationId) or context.getCheckpointDir()
    if configured:
        return configured
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    with _CHOICE:  # several threads may prepare joins side by side
        if context.applicationId not in _FALLBACK:
            _FALLBACK[context.applicationId] = tempfile.mkdtemp(prefix="tarmac-")
    return _FALLBACK[context.applicationId]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the checkpoint folder and continue from the written copy."""
    spark = df.sparkSession
    folder = shared_dir(spark)
    with _CHOICE:
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(folder)
    return df.checkpoint(eager=True)


def wide(spark: SparkSession) -> int:
    """Tasks that keep every core busy, some more than one."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), 2 * spark.sparkContext.defaultParallelism)


def spread(rows: DataFrame, key: str) -> DataFrame:
    """``rows`` dealt over all cores by their id, unless they are few or read by as many tasks already.

    A compressed file of some MB is one task, whose work per row the other cores would wait for.
    """
    tasks = wide(rows.sparkSession)
    if rows.rdd.getNumPartitions() >= tasks or rows.count() <= FEW_ROWS:
        return rows
    return rows.repartition(tasks, key)
