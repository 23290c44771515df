"""Session settings and the shared folder for checkpoints and written tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.ui.enabled": "false",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_session(app: str = "wardmill", master: str | None = None, **conf: str) -> SparkSession:
    """Session with this package's defaults; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = DEFAULTS | {k.replace("__", "."): v for k, v in conf.items()}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder: on a cluster an executor's own
    disk goes away with the executor.
    """
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(named)
        return named
    if not sc.getCheckpointDir():
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="wardmill-"))
    return sc.getCheckpointDir()


def new_folder(spark: SparkSession, label: str) -> str:
    """A path under the shared folder that no other run uses."""
    return f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
