"""Scans of stored results and constant relations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_parquet(spark: SparkSession, path: str | list[str], schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).parquet(path)


def constant_rows(
    spark: SparkSession, names: tuple[str, ...], rows: list[tuple]
) -> DataFrame:
    """A small literal relation, made inside the plan so that its size is known to be small."""
    structs = [F.struct(*[F.lit(v).alias(n) for n, v in zip(names, row)]) for row in rows]
    return spark.range(1, numPartitions=1).select(F.inline(F.array(*structs)))
