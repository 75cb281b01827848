"""Intermediate tables in the shared checkpoint folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from skillscope.session import scratch_dir


class Scratch:
    """A folder of Parquet tables for one operator run.

    ``keep`` writes a table once and reads it back, so that what builds on it survives lost
    executors and is not computed again. ``drop`` and ``drop_all_but`` delete tables that no returned DataFrame reads.
    """

    def __init__(self, spark: SparkSession, label: str) -> None:
        self.spark = spark
        self.root = f"{scratch_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(self.path(name))
        return self.spark.read.schema(df.schema).parquet(self.path(name))

    def _files(self):
        path = self.spark._jvm.org.apache.hadoop.fs.Path
        return path, path(self.root).getFileSystem(self.spark._jsc.hadoopConfiguration())

    def drop(self, *names: str) -> None:
        path, files = self._files()
        for name in names:
            files.delete(path(self.path(name)), True)

    def drop_all_but(self, *names: str) -> None:
        path, files = self._files()
        self.drop(*({f.getPath().getName() for f in files.listStatus(path(self.root))} - {*names}))
