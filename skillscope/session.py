"""Session settings and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings that the results depend on (zone, ANSI errors) or that every job wants (AQE).
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def build_session(app: str = "skillscope", master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SESSION_CONF, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder.

    A folder of our own is made only where none is set, and only in local mode: on a cluster a
    machine-local folder would be invisible to the other executors.
    """
    sc = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if folder:
        return folder
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="skillscope-"))
    return sc.getCheckpointDir()


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the scratch folder and read it back.

    Cuts the lineage with a columnar table that survives executor loss, so that several consumers
    do not repeat the work above it.
    """
    spark = df.sparkSession
    path = os.path.join(scratch_dir(spark), f"{label}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Delete what ``materialise`` wrote for ``df``, once nothing reads it any more."""
    spark = df.sparkSession
    for folder in {os.path.dirname(f) for f in df.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
