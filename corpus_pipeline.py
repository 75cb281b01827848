"""The corpus pipeline: documents in, a weighted mix of clean documents out.

Stages: documents that the quality classifier rejects go; one document of each near-duplicate group
stays (five-word shingles, 80 %); documents that hold a benchmark item go; personal data in the rest is
replaced by its kind; the rest is mixed by source, with the number of copies of each document that
is taken. Every stage works on all that its predecessor kept, and all but the last return the columns
of ``documents``. Rows with equal ``doc_id`` and text count once from the second stage on. Empty tables pass
through; nulls are handled as the operators state. Further columns go along, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skillscope.llm.decontaminate import drop_leaked
from skillscope.llm.minhash import near_duplicates
from skillscope.llm.mixing import mix_sources
from skillscope.llm.pii import redact
from skillscope.llm.quality import fit_quality, score
from skillscope.llm.scratch import Scratch
from skillscope.llm.words import word_count


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Quality classifier, fitted on the labels outside its held-out third."""
    model = fit_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return score(docs, model, "__score").where("__score >= 0.5").drop("__score")


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Near-duplicates by min-max hashing: the smallest doc_id of each group stays."""
    gone = near_duplicates(docs).where("NOT kept").select("doc_id")
    kept = docs.join(gone, "doc_id", "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])
    return kept.dropDuplicates(["doc_id", "text"])


def keep_untested(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark decontamination by BM25 retrieval."""
    return drop_leaked(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def hide_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind; ``n_chars`` follows the new text."""
    hidden = redact(docs)
    return hidden.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Entropy balancing: documents of which at least one copy is taken, with their number of copies.

    Columns of ``docs`` that are named like the four added ones are replaced.
    """
    added = ("size", "copies", "taken", "target")
    key = {"doc_id": "__mix_doc_id", "source": "__mix_source", "size": "__mix_size"}
    taken = mix_sources(docs).where("copies > 0").groupBy(*[F.col(c).alias(n) for c, n in key.items()]).agg(
        *[F.max(c).alias(f"__mix_{c}") for c in added[1:]])
    docs = docs.drop(*added)
    same = F.col("doc_id").eqNullSafe(F.col(key["doc_id"])) & F.col("source").eqNullSafe(F.col(key["source"])) & (
        word_count(F.col("text")) == F.col(key["size"]))
    kept = [F.col(f"`{c}`") for c in docs.columns]
    return docs.join(taken, same).select(*kept, *[F.col(f"__mix_{c}").alias(c) for c in added])


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_classifier", keep_good),
    ("near_duplicates", keep_one_of_each),
    ("decontamination", keep_untested),
    ("personal_data", hide_personal_data),
    ("mixing", mix),
]

ORACLE_SQL = None  # a trained network, bootstrapped patterns and solved rates are beyond SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``, each to the stored result of the one before."""
    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (name, stage) in enumerate(STAGES):
        docs = scratch.keep(stage(spark, docs, sf_dir), f"{number}-{name}")
        if number:
            scratch.drop(f"{number - 1}-{STAGES[number - 1][0]}")
    return docs
