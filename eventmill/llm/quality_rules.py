"""Rule failures of documents, and of the hosts they come from.

A document fails by its own text (too few words, or too many of them in repeated stretches). Failures are
then summed by host (``source``). A host's rate is shrunk towards all hosts' by a beta prior, whose mean
and strength are fitted to the hosts' rates by moments, so that a host with few documents is not judged by
these alone. Documents of a host whose shrunk rate exceeds ``worst`` are not kept, whatever their own text.

DataFrame functions only. The text is read in one narrow pass whose counts are stored; hosts are summed
before they are shuffled, and only counts are joined.

Decided cases: a null text has no words, hence fails. A null source is a host of its own. Rows are judged
singly, so repeated rows get equal results. Other columns are ignored. An empty table gives no rows.
Windows are compared by 64-bit hashes within one text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..session import scratch_path
from .columns import BLANKS, count_of, words

WINDOW, FEWEST_WORDS, MOST_REPEATED_PERCENT = 5, 10, 20
SYMBOLS = "#*$%&|<>"
WORST_HOST = 0.5
#: Bounds of the prior's strength, in documents.
_WEAKEST, _STRONGEST = 1.0, 1000.0
#: Rates that spread no more than rounding does are equal.
_NO_SPREAD = 1e-12


def _duplicate_lines(text: Column) -> Column:
    lines = F.filter(F.split(text, "\n"), lambda line: F.btrim(line, F.lit(BLANKS)) != "")
    return (F.size(lines) - F.size(F.array_distinct(lines))).cast("long")


def _pairs(left: Column, right: Column) -> Column:
    return F.when(left["hash"] == right["hash"], F.array(left["at"], right["at"]))


def text_counts(documents: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, source, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    text = F.coalesce("text", F.lit(""))
    counted = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), "source", words(text).alias("words"),
        count_of(text, SYMBOLS).alias("n_symbols"), _duplicate_lines(text).alias("n_dup_lines"))
    counted = counted.select(
        "doc_id", "source", "n_symbols", "n_dup_lines", F.size("words").alias("n"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.transform("words", lambda word: F.xxhash64(word)).alias("hashes"))
    starts = F.greatest(F.col("n") - (window - 1), F.lit(0))
    shifted = F.arrays_zip(*(F.slice("hashes", at + 1, starts).alias(f"w{at}") for at in range(window)))
    counted = counted.withColumn("windows", F.sort_array(F.transform(shifted, lambda x, at: F.struct(
        F.xxhash64(*(x[f"w{i}"] for i in range(window))).alias("hash"), at.alias("at")))))
    # Equal windows are now neighbours: the places of those that have an equal neighbour, in order.
    neighbours = F.zip_with("windows", F.slice("windows", 2, F.greatest(starts, F.lit(1))), _pairs)
    places = F.array_sort(F.array_distinct(F.flatten(F.filter(neighbours, lambda x: x.isNotNull()))))
    counted = counted.withColumn("places", places)
    covered = F.zip_with(
        "places", F.slice("places", 2, F.greatest(F.size("places"), F.lit(1))),
        lambda a, b: F.when(a.isNull(), 0).otherwise(F.least(F.lit(window), F.coalesce(b - a, F.lit(window)))))
    return counted.select(
        "doc_id", "source", F.col("n").cast("long").alias("n_words"), "word_chars", "n_symbols", "n_dup_lines",
        F.aggregate(covered, F.lit(0), lambda sum_, x: sum_ + x).cast("long").alias("n_repeat_words"))


def base_failed() -> Column:
    return (F.col("n_words") < FEWEST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED_PERCENT * F.col("n_words"))


def host_rates(judged: DataFrame) -> DataFrame:
    """source, documents, failures, and the failure rate shrunk by the fitted prior."""
    hosts = judged.groupBy("source").agg(
        F.count("*").alias("documents"), F.sum(F.col("base_failed").cast("long")).alias("failures"))
    rate = F.col("failures") / F.col("documents")
    fit = hosts.agg(  # one row
        F.count("*").alias("hosts"), F.sum("documents").alias("documents"), F.sum("failures").alias("failures"),
        F.sum(rate).alias("rates"), F.sum(rate * rate).alias("squares")).first()
    mean = fit.failures / fit.documents if fit.hosts else 0.0
    spread = (fit.squares - 2 * mean * fit.rates) / fit.hosts + mean * mean if fit.hosts else 0.0
    strength = mean * (1 - mean) / spread - 1 if spread > _NO_SPREAD else _STRONGEST
    strength = max(_WEAKEST, min(_STRONGEST, strength))
    shrunk = (F.col("failures") + mean * strength) / (F.col("documents") + strength)
    return hosts.select("source", "documents", "failures", shrunk.alias("rate"))


def quality_rules(documents: DataFrame, worst: float = WORST_HOST) -> DataFrame:
    """The counts of each document, base_failed, its host's shrunk failure rate, and kept."""
    spark = documents.sparkSession
    path = scratch_path(spark, "rule-counts")
    text_counts(documents).withColumn("base_failed", base_failed()).write.parquet(path)
    judged = spark.read.parquet(path)
    rates = host_rates(judged).select(F.col("source").alias("host"), "rate")
    joined = judged.join(rates, F.col("source").eqNullSafe(F.col("host")))
    return joined.select(
        "doc_id", "source", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        F.col("rate").alias("host_rate"), (~F.col("base_failed") & (F.col("rate") <= worst)).alias("kept"))
