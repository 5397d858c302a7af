"""Written intermediate tables, in the folder that all executors share.

A written table cuts the lineage, survives lost executors, and has a known size, so Spark can
decide by itself whether a join with it may be a broadcast.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from .session import shared_dir


class Scratch:
    """One folder for the tables of one run, removed when the driver ends."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        path, files = self._hadoop(f"{shared_dir(spark)}/ordermill-{name}-{uuid.uuid4().hex}")
        # With its scheme, so that whoever opens it without Spark takes the same file system.
        self.folder = files.makeQualified(path).toString()
        files.mkdirs(path)
        files.deleteOnExit(path)

    def table(self, rows: DataFrame, name: str) -> DataFrame:
        rows.write.parquet(self.path(name))
        return self.spark.read.schema(rows.schema).parquet(self.path(name))

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}"

    def drop(self, name: str) -> None:
        """Remove a table that no later step reads."""
        path, files = self._hadoop(self.path(name))
        files.delete(path, True)

    def _hadoop(self, folder: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(folder)
        return path, path.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf())
