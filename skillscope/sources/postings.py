"""Landed postings: JSON scan, page envelopes, flattening."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skillscope.functions.numbers import plain_number
from skillscope.schemas import PAGE_JSON_SCHEMA, POSTING_JSON_SCHEMA


def read_postings(
    spark: SparkSession, path: str | list[str], json_lines: bool = False
) -> DataFrame:
    """Scan landed postings, one row each.

    The default reads files that hold one JSON array, each in one task. ``json_lines=True`` reads
    one posting per line; such files split, so land large volumes that way.
    """
    reader = spark.read.schema(POSTING_JSON_SCHEMA).option("mode", "FAILFAST")
    return reader.option("multiLine", not json_lines).json(path)


def parse_postings(df: DataFrame, json_col: str) -> DataFrame:
    """The same rows from a text column that holds one posting object per row."""
    parsed = F.from_json(json_col, POSTING_JSON_SCHEMA, {"mode": "FAILFAST"})
    return df.select(parsed.alias("p")).select("p.*")


def explode_pages(df: DataFrame, json_col: str) -> DataFrame:
    """Postings out of page envelopes; a page without ``results`` adds none."""
    page = F.from_json(json_col, PAGE_JSON_SCHEMA, {"mode": "FAILFAST"})
    return df.select(F.explode(page["results"]).alias("p")).select("p.*")


def _text(name: str, path: str = "$") -> Column:
    return F.try_variant_get(F.col(name), path, "string")


def flatten_postings(postings: DataFrame) -> DataFrame:
    """Nested postings to the ten flat raw columns, texts whole.

    An absent description counts as empty text, a JSON null stays NULL. Pay bounds that are not
    numbers become NULL.
    """
    description = F.when(F.col("description").isNull(), F.lit("")).otherwise(_text("description"))
    return postings.select(
        _text("id").alias("id"),
        _text("title").alias("title"),
        _text("company", "$.display_name").alias("company_name"),
        _text("location", "$.display_name").alias("location_name"),
        plain_number(_text("salary_min")).alias("salary_min"),
        plain_number(_text("salary_max")).alias("salary_max"),
        _text("contract_type").alias("contract_type"),
        _text("category", "$.label").alias("category_label"),
        description.alias("description"),
        _text("created").alias("created"),
    )
