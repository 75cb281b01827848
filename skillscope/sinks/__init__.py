"""Where results go: tables, files, landing folders and document indexes."""

from __future__ import annotations

import logging
import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

log = logging.getLogger(__name__)


MANIFEST = "_current"


def _files(spark: SparkSession, place: str):
    """Hadoop's path class, and the file system of a place."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    return path, path(place).getFileSystem(spark._jsc.hadoopConfiguration())


def current_version(spark: SparkSession, folder: str) -> str | None:
    """The folder of the table's current version; None before the first."""
    path, files = _files(spark, folder)
    manifest = path(f"{folder}/{MANIFEST}")
    if not files.exists(manifest):
        return None
    stream = files.open(manifest)
    try:
        return f"{folder}/{stream.readLine()}"
    finally:
        stream.close()


def _swing(spark: SparkSession, folder: str, version: str) -> None:
    """Make a whole version the current one by renaming a new manifest over the old one, which is one step."""
    path, files = _files(spark, folder)
    fresh = path(f"{folder}/.{MANIFEST}-{version}")
    out = files.create(fresh, True)
    out.writeBytes(f"{version}\n")
    out.close()
    jvm = spark._jvm
    rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    how = spark.sparkContext._gateway.new_array(rename, 1)
    how[0] = rename.OVERWRITE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(files.getUri(), spark._jsc.hadoopConfiguration())
    context.rename(files.makeQualified(fresh), files.makeQualified(path(f"{folder}/{MANIFEST}")), how)


def drop_old_versions(spark: SparkSession, folder: str, keep: int) -> None:
    """Delete all but the current version and the ``keep`` newest others; leftovers of failed writers count as others."""
    path, files = _files(spark, folder)
    current = (current_version(spark, folder) or "").rsplit("/", 1)[-1]
    others = [f for f in files.listStatus(path(folder)) if f.isDirectory() and f.getPath().getName() != current]
    for old in sorted(others, key=lambda f: f.getModificationTime(), reverse=True)[keep:]:
        files.delete(old.getPath(), True)


def open_table(spark: SparkSession, name: str, root: str) -> DataFrame:
    """The current version of a table under ``root``, whether or not the catalog knows it."""
    version = current_version(spark, f"{root}/{name}")
    if version is None:
        raise FileNotFoundError(f"table {name} has no version under {root}")
    return spark.read.parquet(version)


def replace_table(df: DataFrame, name: str, root: str | None = None, keep: int = 1) -> DataFrame:
    """Store ``df`` as table ``name`` in place of an older one, and read it back.

    Under ``root`` a table is a folder of whole versions and a manifest that names the current one. A new
    version is written beside the others and becomes current in one step, so that a writer that dies leaves the old
    table, and readers of the old version can end; ``keep`` older versions stay. ``df`` may read the table itself. Without
    ``root`` it is a managed table, which Spark's catalog replaces.
    """
    spark = df.sparkSession
    if not root:
        df.write.mode("overwrite").saveAsTable(name)
        return spark.table(name)
    folder, version = f"{root}/{name}", uuid.uuid4().hex
    df.write.parquet(f"{folder}/{version}")
    _swing(spark, folder, version)
    # The catalog's entry is a pointer to files that it does not own.
    spark.sql(f"DROP TABLE IF EXISTS `{name}`")
    spark.catalog.createTable(name, path=f"{folder}/{version}", source="parquet", schema=df.schema)
    drop_old_versions(spark, folder, keep)
    return spark.table(name)


def replace_view(df: DataFrame, name: str) -> DataFrame:
    df.createOrReplaceTempView(name)
    return df


def write_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def write_empty(spark: SparkSession, schema: T.StructType, path: str) -> None:
    """A result without rows that still has its typed columns."""
    write_parquet(spark.createDataFrame([], schema), path)


def land_json(df: DataFrame, root: str, ds: str, replace: bool = True) -> str:
    """Land rows as JSON lines under their date; NULLs are kept as JSON nulls.

    ``replace=False`` leaves an earlier landing of that date alone.
    """
    path = f"{root}/{ds}"
    df.write.mode("overwrite" if replace else "ignore").option("ignoreNullFields", False).json(path)
    return path


def write_survey_csv(df: DataFrame, path: str, replace: bool = False) -> None:
    """A CSV with a header; by default only if nothing is there yet."""
    mode = "overwrite" if replace else "ignore"
    df.write.mode(mode).option("header", True).option("escape", '"').csv(path)


def documents(df: DataFrame, index: str) -> DataFrame:
    """One JSON document per row, NULL fields included."""
    body = F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"})
    return df.select(F.lit(index).alias("index"), body.alias("document"))


def _swap(spark: SparkSession, fresh: str, place: str) -> None:
    """Put the complete folder ``fresh`` in the place of an older one, which goes last."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    files = path(place).getFileSystem(spark._jsc.hadoopConfiguration())
    old = path(f"{fresh}.old")
    had = files.exists(path(place)) and files.rename(path(place), old)
    if not files.rename(path(fresh), path(place)):
        if had:
            files.rename(old, path(place))
        raise OSError(f"{place} could not be replaced")
    if had:
        files.delete(old, True)


def index_tables(
    spark: SparkSession,
    index_map: Mapping[str, str],
    target: str,
    fmt: str = "text",
    options: Mapping[str, str] | None = None,
) -> list[str]:
    """Replace each index by the documents of its table; absent tables are skipped.

    By default an index is a folder of JSON lines under ``target``; the new one is written next to
    the old one and takes its place when it is whole. Another ``fmt`` hands the rows
    themselves to a connector, with the index name appended to ``target``.
    """
    written = []
    for index, table in index_map.items():
        if not spark.catalog.tableExists(table):
            log.warning("table %s is absent, index %s is left out", table, index)
            continue
        rows = spark.table(table)
        if fmt == "text":
            rows = documents(rows, index).select(F.col("document").alias("value"))
        if fmt == "text":
            fresh = f"{target}/.{index}-{uuid.uuid4().hex}"
            rows.write.format(fmt).options(**(options or {})).save(fresh)
            _swap(spark, fresh, f"{target}/{index}")
        else:
            rows.write.mode("overwrite").format(fmt).options(**(options or {})).save(f"{target}/{index}")
        written.append(index)
    return written
