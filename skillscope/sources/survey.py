"""Survey CSV scan and column contract."""

from __future__ import annotations

import logging
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skillscope.defaults import NA_TOKENS
from skillscope.functions.text import na_to_null
from skillscope.schemas import SURVEY_COLUMNS

log = logging.getLogger(__name__)


def _files(spark: SparkSession, path: str | list[str]) -> list[str]:
    return sorted(spark.read.text(path).inputFiles())


def read_survey(
    spark: SparkSession, path: str | list[str], multi_line: bool = True, on_bad: str = "FAILFAST"
) -> DataFrame:
    """Scan survey CSVs with headers; every column is text, missing-value tokens are NULL.

    Files are read by the names in their own header, as columns change between years; a column that
    a file lacks is NULL in its rows. A row with too many or too few cells fails the scan, unless
    ``on_bad`` is another of Spark's CSV modes. Quoted cells may hold line breaks, so a file is read
    by one task. Where no cell does, ``multi_line=False`` lets large files split.
    """
    reader = {"header": True, "escape": '"', "multiLine": multi_line, "inferSchema": False}
    by_header: dict[tuple[str, ...], list[str]] = {}
    for file in _files(spark, path):
        names = spark.read.options(**reader).csv(file).columns
        by_header.setdefault(tuple(names), []).append(file)
    scans = []
    for names, files in by_header.items():
        schema = T.StructType([T.StructField(name, T.StringType()) for name in names])
        # Without pruning, all cells of a row are read and counted.
        options = reader | {"mode": on_bad, "columnPruning": False, "enforceSchema": False}
        scans.append(spark.read.options(**options).schema(schema).csv(files))
    if not scans:
        return spark.createDataFrame([], T.StructType([]))
    whole = reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), scans)
    return null_missing(whole)


def null_missing(df: DataFrame, tokens: tuple[str, ...] = NA_TOKENS) -> DataFrame:
    return df.select(*[na_to_null(F.col(f"`{c}`"), tokens).alias(c) for c in df.columns])


def require_columns(df: DataFrame, names: tuple[str, ...] = SURVEY_COLUMNS) -> DataFrame:
    """Exactly ``names``, in order; absent ones are filled with NULL text."""
    absent = [n for n in names if n not in df.columns]
    if absent:
        log.warning("columns %s are absent and filled with NULL", absent)
    empty = F.lit(None).cast("string")
    return df.select(*[empty.alias(n) if n in absent else F.col(f"`{n}`") for n in names])
