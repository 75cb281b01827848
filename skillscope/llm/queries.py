"""The registered queries: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skillscope.llm.chat import conversation_digests, format_conversations
from skillscope.llm.decontaminate import find_leaks
from skillscope.llm.html_text import extract_pages
from skillscope.llm.minhash import near_duplicates
from skillscope.llm.mixing import mix_sources
from skillscope.llm.packing import pack_documents
from skillscope.llm.pii import find_personal_data, span_digests
from skillscope.llm.quality import fit_quality, held_out, score
from skillscope.llm.rules import quality_rules
from skillscope.llm.spelling import spelling_variants, word_counts
from skillscope.llm.substring import passage_digests
from skillscope.llm.trie import conversation_trie
from skillscope.llm.warc import archived


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_warc_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archived(_table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url")


VOCABULARY = "byte_bpe_50k.json"
CONTROL_TEXT = "\\### Assistant: </turn> ok"  # a text that holds the template's own control strings


def op2_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(CONTROL_TEXT).alias("text"))
    return conversation_digests(format_conversations(rows.unionByName(extra)))


def op3_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_table(spark, sf_dir, "documents"), shingle_words=3, min_percent=85)


def op4_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passage_digests(_table(spark, sf_dir, "documents"))


def op5_benchmark_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op6_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_pages(_table(spark, sf_dir, "pages"))


def op7_quality_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = score(docs, fit_quality(docs, _table(spark, sf_dir, "labels")))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                         F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))


def op8_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(_table(spark, sf_dir, "documents")).drop("source")


def op9_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return span_digests(find_personal_data(_table(spark, sf_dir, "documents")))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(_table(spark, sf_dir, "documents")).drop("cleaned")


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(word_counts(_table(spark, sf_dir, "documents"), misspell_every=97))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie(_table(spark, sf_dir, "conversations"))


def op13_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return pack_documents(_table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY), with_ids=False)


REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_warc_archive": op1_warc_archive,
    "op2_chat_format": op2_chat_format,
    "op3_near_duplicates": op3_near_duplicates,
    "op4_repeated_passages": op4_repeated_passages,
    "op5_benchmark_leaks": op5_benchmark_leaks,
    "op6_main_text": op6_main_text,
    "op7_quality_score": op7_quality_score,
    "op8_mix_sources": op8_mix_sources,
    "op9_personal_data": op9_personal_data,
    "op10_quality_rules": op10_quality_rules,
    "op11_spelling_variants": op11_spelling_variants,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_best_fit_packing": op13_best_fit_packing,
}
