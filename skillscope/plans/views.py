"""Postings and survey rows out of the test tables, which hold neither.

A posting is a document with the price, date and status of the order of the same number; a survey
respondent is an order line with the words of its part's name as skills.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skillscope.defaults import Rule
from skillscope.operators.marts import enrich_postings, survey_benchmarks
from skillscope.operators.staging import stage_postings, stage_survey
from skillscope.operators.tagging import keyword_flags

# Keyword rules over the document texts.
RULES = (
    Rule("skill_red", "red", ("% the %",)),
    Rule("skill_blue", "blue", ("% and %",)),
    Rule("skill_ring", "ring", ("%tion%",), ("% the %",)),
    Rule("skill_bolt", "bolt", ("% le %", "% la %")),
    Rule("skill_gear", "gear", ("% und %", "% der %")),
    Rule("skill_rod", "rod", ("% que %", "% el %")),
    Rule("skill_anvil", "anvil", ("%heed%",)),
    Rule("skill_widget", "widget", ("%license%",)),
    Rule("skill_plate", "plate", ("%@%",)),
    Rule("skill_gizmo", "gizmo", ("% the %", "% la %"), ("%heed%",)),
    Rule("skill_hot", "hot", ("%er %",)),
    Rule("skill_zero", "zero", ("%python%",)),
)

# Benchmark column -> part name words; 'Gizmo.x' does not occur.
SPEC = {
    "so_red": ("red",),
    "so_blue": ("blue", "cold"),
    "so_ring": ("ring",),
    "so_bolt": ("bolt",),
    "so_gear": ("gear",),
    "so_rod": ("rod",),
    "so_anvil": ("anvil",),
    "so_widget": ("widget",),
    "so_plate": ("plate",),
    "so_gizmo": ("Gizmo.x",),
}

# Flag -> benchmark column; 'hot' has none.
PAIRS = {
    "skill_red": "so_red",
    "skill_blue": "so_blue",
    "skill_ring": "so_ring",
    "skill_bolt": "so_bolt",
    "skill_gear": "so_gear",
    "skill_rod": "so_rod",
    "skill_anvil": "so_anvil",
    "skill_widget": "so_widget",
    "skill_plate": "so_plate",
    "skill_gizmo": "so_gizmo",
    "skill_zero": "so_plate",
}

# Rule label -> part name word, for the comparison.
LABEL_MAP = {
    "red": "red",
    "blue": "blue",
    "ring": "ring",
    "bolt": "bolt",
    "gear": "gear",
    "rod": "rod",
    "anvil": "anvil",
    "widget": "widget",
    "plate": "plate",
    "gizmo": "Gizmo.x",
    "zero": "plate",
}


# Word of the texts -> keyword that stands in for it.
KEYWORDS = {
    "the": "python", "and": "TypeScript", "of": "java", "in": "mysql", "to": "react", "that": "node",
    "de": "docker", "und": "AWS", "la": "machine learning", "der": "go", "que": "rust", "die": "scala",
}

# The table columns that the queries read.
SCHEMAS = {
    "documents": "doc_id BIGINT, text STRING, lang STRING, source STRING",
    "orders": "o_orderkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
              "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_linenumber INT, l_extendedprice DOUBLE, "
                "l_discount DOUBLE, l_returnflag STRING, l_linestatus STRING",
    "part": "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def pay_bounds() -> tuple[Column, Column]:
    """Both bounds, one of them or none, by order priority."""
    priority, price = F.col("o_orderpriority"), F.col("o_totalprice")
    low = F.when(~priority.isin("1-URGENT", "2-HIGH"), price * F.lit(0.3))
    high = F.when(~priority.isin("2-HIGH", "3-MEDIUM"), price * F.lit(0.4))
    return low, high


def _postings(documents: DataFrame, orders: DataFrame, *extra: str) -> DataFrame:
    low, high = pay_bounds()
    created = F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    undated = (F.col("o_orderstatus") == "P") & (F.col("lang") == "es")
    return documents.join(orders, F.col("doc_id") == F.col("o_orderkey"), "left").select(
        F.col("doc_id").cast("string").alias("id"),
        F.concat(F.lit("Role "), "source").alias("title"),
        F.col("source").alias("company_name"),
        F.col("lang").alias("location_name"),
        low.alias("salary_min"),
        high.alias("salary_max"),
        F.nullif(F.col("o_orderstatus"), F.lit("P")).alias("contract_type"),
        F.nullif(F.col("o_orderpriority"), F.lit("5-LOW")).alias("category_label"),
        *extra,
        F.when(~undated, created).alias("created"),
    )


def raw_postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flat postings with their text."""
    documents = table(spark, sf_dir, "documents").withColumnRenamed("text", "description")
    return _postings(documents, table(spark, sf_dir, "orders"), "description")


def flagged_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return keyword_flags(documents, "text", RULES, ["doc_id", "lang", "source"])


def tagged_postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staged postings with flags. Texts are tagged at the scan and do not reach the join."""
    orders = table(spark, sf_dir, "orders")
    flags = [r.column for r in RULES]
    return stage_postings(_postings(flagged_documents(spark, sf_dir), orders, *flags))


def raw_survey(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Respondents as a CSV scan would give them: all text, 'NA' for unknown pay."""
    # The lists depend on the part alone and are put together once per part, not per line.
    name = F.col("p_name")
    spaced = F.replace(name, F.lit(" "), F.lit(" ; "))
    first = F.split_part(name, F.lit(" "), F.lit(1))
    listed = F.col("p_brand") != "Brand#1"
    parts = table(spark, sf_dir, "part").select(
        "p_partkey",
        F.col("p_type").alias("DevType"),
        F.col("p_size").cast("string").alias("YearsCodePro"),
        F.col("p_brand").alias("EdLevel"),
        F.when(listed, spaced).alias("once"),
        F.when(listed, F.concat(spaced, F.lit(";;"), first)).alias("repeated"),
        F.replace(name, F.lit(" "), F.lit(";")).alias("LanguageWantToWorkWith"),
        F.col("p_brand").alias("DatabaseHaveWorkedWith"),
        F.col("p_type").alias("PlatformHaveWorkedWith"),
    )
    lines = table(spark, sf_dir, "lineitem")
    order, number = F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")
    pay = F.col("l_extendedprice").cast("string")
    return lines.join(parts, F.col("l_partkey") == F.col("p_partkey"), "left").select(
        F.concat(order, F.lit("-"), number).alias("ResponseId"),
        F.col("l_returnflag").alias("Country"),
        "DevType",
        "YearsCodePro",
        "EdLevel",
        F.col("l_linestatus").alias("RemoteWork"),
        F.when(F.col("l_linestatus") == "O", F.col("repeated")).otherwise(F.col("once"))
        .alias("LanguageHaveWorkedWith"),
        "LanguageWantToWorkWith",
        "DatabaseHaveWorkedWith",
        "PlatformHaveWorkedWith",
        F.when(F.col("l_discount") == 0, F.lit("NA")).otherwise(pay).alias("ConvertedCompYearly"),
    )


def staged_survey(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stage_survey(raw_survey(spark, sf_dir))


def benchmarks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return survey_benchmarks(staged_survey(spark, sf_dir), SPEC, LABEL_MAP)


def enriched_postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich_postings(
        tagged_postings(spark, sf_dir), benchmarks(spark, sf_dir), RULES, SPEC, PAIRS
    )
