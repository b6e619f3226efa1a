"""The operators as stages of a pipeline: (spark, docs, folder) to DataFrame.

``docs`` has the columns of the table ``documents``; so has what every stage but the last returns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import toxicity as grammar
from .decontaminate import decontaminate
from .mixing import mix
from .near_copies import keep_one
from .suffix_dedup import suffix_dedup


def toxicity(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Rejected documents go. The model learns from the labelled rows among ``docs``."""
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    return grammar.drop_toxic(docs, grammar.fit(docs, labels))


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """The first document of each group of near duplicates stays: five-word shingles, similarity 0.8 or more."""
    return keep_one(docs)


def suffix_array_dedup(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Texts lose what is repeated elsewhere, in whole characters; all documents stay. A null text becomes empty."""
    others = [c for c in docs.columns if c not in ("doc_id", "text", "n_chars")]
    cut = suffix_dedup(docs, carried=(*others, "n_chars"), whole=True)
    text = F.col("kept").cast("string")
    places = {"doc_id": F.col("doc_id"), "text": text, "n_chars": F.length(text).cast("long")}
    return cut.select(*(places.get(c, F.col("carried")[c]).alias(c) for c in docs.columns))


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents with a window that nearly equals a benchmark item go."""
    return decontaminate(docs, spark.read.parquet(f"{folder}/benchmark.parquet"))


def mixing(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """The documents that the mix takes, with the words it takes of each, repeats counted.

    Columns named as those of the mix give way to them. Rows that repeat an id are documents of their own.
    """
    docs = docs.drop("size", "source_size", "target", "taken")
    others = tuple(c for c in docs.columns if c not in ("doc_id", "source"))
    mixed = mix(docs, carried=others).where("taken > 0")
    named = [F.col(c) if c in ("doc_id", "source") else F.col("carried")[c].alias(c) for c in docs.columns]
    return mixed.select(*named, "size", "source_size", "target", "taken")
