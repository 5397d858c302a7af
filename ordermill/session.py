"""Session settings and the folder that all executors can reach."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession


def build_session(app_name: str = "ordermill", master: str | None = None,
                  shuffle_partitions: int | None = None) -> SparkSession:
    """A session with the settings the jobs are written for.

    Shuffle width is left to the cluster unless given: adaptive execution
    coalesces small partitions, so a generous default does no harm.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.ansi.enabled", "true")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.scheduler.mode", "FAIR")  # a refresh runs independent builds at once
        .config("spark.ui.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder for written intermediate data, named by ``spark.checkpoint.dir``.

    Unset, a temporary checkpoint folder is made, but only in local mode, where driver and
    executors are one machine.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="ordermill-"))
        folder = context.getCheckpointDir()
    return folder.rstrip("/")
