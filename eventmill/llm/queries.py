"""The operators as named queries over the driver's tables: (spark, folder) to DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import scratch_path
from . import embedding_dedup, langid, toxicity, warc
from .decontaminate import contaminated
from .mixing import mix
from .prefix_trie import borrowed, prefix_trie, sequences
from .quality_model import classify
from .quality_rules import quality_rules
from .simhash import near_duplicates
from .structure_repair import damaged, repair
from .substring_dedup import substring_dedup
from .suffix_dedup import suffix_dedup

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    cut = substring_dedup(_table(spark, folder, "documents"))
    return cut.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op2_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    judged = quality_rules(_table(spark, folder, "documents"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op3_warc(spark: SparkSession, folder: str) -> DataFrame:
    read = warc.round_trip(spark, _table(spark, folder, "pages"), scratch_path(spark, "warc"))
    return read.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op4_quality_model(spark: SparkSession, folder: str) -> DataFrame:
    return classify(_table(spark, folder, "documents"), _table(spark, folder, "labels"))


def op5_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(_table(spark, folder, "documents"))


def op6_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return contaminated(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))


def op7_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.classify(_table(spark, folder, "documents"), _table(spark, folder, "labels"))


def op8_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    cut = suffix_dedup(_table(spark, folder, "documents"))
    return cut.select(
        "doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op9_langid(spark: SparkSession, folder: str) -> DataFrame:
    return langid.identify(_table(spark, folder, "documents"))


def op10_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mix(_table(spark, folder, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op11_structure_repair(spark: SparkSession, folder: str) -> DataFrame:
    return repair(damaged(_table(spark, folder, "conversations")))


def op12_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    return prefix_trie(borrowed(sequences(_table(spark, folder, "conversations"))))


def op13_embedding_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return embedding_dedup.near_duplicates(_table(spark, folder, "embeddings"))


def queries() -> dict[str, Query]:
    named = (
        op1_substring_dedup, op2_quality_rules, op3_warc, op4_quality_model, op5_simhash, op6_decontamination,
        op7_toxicity, op8_suffix_dedup, op9_langid, op10_mixing, op11_structure_repair,
        op12_prefix_trie, op13_embedding_dedup)
    return {query.__name__: query for query in named}
