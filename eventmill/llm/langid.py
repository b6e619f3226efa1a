"""Language of a text, word first: known words by their frequency in each language, others by their letters.

The model counts the words (runs of letters, lower-cased) of all documents it may learn from, by language,
and the letter sequences of one to four letters in them. All these counts are kept, as tables. A known word
adds its log frequency in each language. An unseen word is read from left to right: each place adds the log
frequency of the longest known sequence that starts there, four letters, else three, else two, else one.

The most frequent words are also handed to each task, which sums them up as it reads; a text's other words
are counted, looked up by a join, and summed by a group. The size of that hand-out changes no result: logs are
rounded to whole numbers, so that sums do not depend on their order.

Decided cases: a null text, or one without letters, is ``und`` with score 0; so is everything if there is
nothing to learn from. A row without a doc_id is neither learned from nor held out. Rows with a null lang
are not learned from. Equal scores go to the first language by name. Rows are predicted singly, so repeated
rows get equal results. Other columns are ignored. An empty table gives no rows.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from . import arrow
from .labels import held_out, remainder
from .workspace import ship
from ..session import scratch_path

#: Words that tasks hold; the longest sequence; what a log is multiplied by before it is rounded.
WORDS, LONGEST, SCALE = 200_000, 4, 1 << 24
SMOOTHING = 0.5
UNDETERMINED = "und"
_NEAR_LETTERS = re.compile(r"[^\W\d_]+")
#: Words of a language at which a task hands on its counts; and languages.
_MOST_HELD, _MOST_LANGS = 300_000, 16


def words_of(text: str) -> list[str]:
    """Runs of letters, lower-cased. The pattern also takes numerals such as a half; these are cut out."""
    found = _NEAR_LETTERS.findall(text.lower())
    if all(map(str.isalpha, found)):
        return found
    return [part for word in found for part in "".join(c if c.isalpha() else " " for c in word).split()]


def word_counts(documents: DataFrame) -> DataFrame:
    """(lang, word, n) over all rows of (lang, text)."""
    ship(documents.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: defaultdict[str, Counter] = defaultdict(Counter)

        def settle(lang: str) -> pa.RecordBatch:
            counts = held.pop(lang)
            return arrow.batch(
                lang=pa.array([lang] * len(counts), pa.string()), word=pa.array(list(counts), pa.string()),
                n=pa.array(list(counts.values()), pa.int64()))

        for rows in batches:
            for lang, text in zip(rows.column("lang").to_pylist(), rows.column("text").to_pylist()):
                held[lang].update(words_of(text))
                if len(held[lang]) > _MOST_HELD:
                    yield settle(lang)
            while len(held) > _MOST_LANGS:
                yield settle(next(iter(held)))
        for lang in list(held):
            yield settle(lang)

    counted = documents.where("lang IS NOT NULL AND text IS NOT NULL").select("lang", "text")
    return counted.mapInArrow(count, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))


@dataclass
class Counted:
    """The model as tables of (unit, all, l0, l1, ...): a unit's count, and its log in each language, scaled."""

    langs: list[str]
    words: DataFrame | None = None
    sequences: DataFrame | None = None
    unseen: tuple[int, ...] = ()
    """Of a letter that no language has."""
    most: int = WORDS


def _logged(units: DataFrame, langs: list[str], path: str) -> tuple[DataFrame, tuple[int, ...]]:
    """A table of the model from (unit, lang, n), stored; and the logs of what is not in it."""
    spark = units.sparkSession
    counts = [F.coalesce(F.sum(F.when(F.col("lang") == lang, F.col("n"))), F.lit(0)).alias(f"n{i}") for i, lang in enumerate(langs)]
    wide = units.groupBy("unit").agg(F.sum("n").alias("all"), *counts)
    wide.write.parquet(f"{path}-counts")
    wide = spark.read.schema(wide.schema).parquet(f"{path}-counts")
    sums = wide.agg(F.count("*").alias("units"), *(F.sum(f"n{i}").alias(f"n{i}") for i in range(len(langs)))).first()
    totals = [(sums[f"n{i}"] or 0) + SMOOTHING * (sums.units + 1) for i in range(len(langs))]
    logs = [F.round(F.log((F.col(f"n{i}") + SMOOTHING) / t) * SCALE).cast("long").alias(f"l{i}") for i, t in enumerate(totals)]
    return wide.select("unit", "all", *logs), tuple(round(float(np.log(SMOOTHING / t)) * SCALE) for t in totals)


def fit(documents: DataFrame, words: int = WORDS) -> Counted:
    """Counts all rows of (lang, text); ``words``: how many tasks hold at once, which changes no result."""
    spark = documents.sparkSession
    path = scratch_path(spark, "language-words")
    word_counts(documents).write.parquet(path)
    counted = spark.read.schema("lang string, word string, n long").parquet(path)
    langs = sorted(r.lang for r in counted.select("lang").distinct().collect())
    if not langs:
        return Counted(langs)
    known, _ = _logged(counted.withColumnRenamed("word", "unit"), langs, f"{path}-0")
    tables = []
    for n in range(1, LONGEST + 1):
        places = F.sequence(F.lit(1), F.length("word") - (n - 1))
        grams = counted.where(F.length("word") >= n).select(
            "lang", "n", F.explode(F.transform(places, lambda at: F.substring("word", at, F.lit(n)))).alias("unit"))
        tables.append(_logged(grams.groupBy("unit", "lang").agg(F.sum("n").alias("n")), langs, f"{path}-{n}"))
    sequences = tables[0][0]
    for table, _ in tables[1:]:
        sequences = sequences.unionByName(table)
    return Counted(langs, known, sequences, tables[0][1], words)


def _backed_off(words: DataFrame, model: Counted) -> DataFrame:
    """(word, l0, l1, ...) of words that are not known, from their letters.

    What a place adds depends on the next few letters alone, its window. So each different window is looked up
    once, by all its beginnings, and a word's places are joined with the windows: one row a place.
    """
    names = [f"l{i}" for i in range(len(model.langs))]
    starts = F.sequence(F.lit(1), F.length("word"))
    places = words.select("word", F.explode(F.transform(starts, lambda at: F.substring("word", at, F.lit(LONGEST)))).alias("window"))
    windows = places.select("window").distinct()
    sizes = F.sequence(F.lit(1), F.length("window"))
    beginnings = windows.select("window", F.explode(sizes).alias("n")).withColumn("unit", F.substring("window", F.lit(1), F.col("n")))
    longest = beginnings.join(model.sequences, "unit").groupBy("window").agg(*(F.max_by(x, "n").alias(x) for x in names))
    read = places.join(longest, "window", "left")
    return read.groupBy("word").agg(*(F.sum(F.coalesce(x, F.lit(none))).alias(x) for x, none in zip(names, model.unseen)))


def predict(documents: DataFrame, model: Counted) -> DataFrame:
    """doc_id, lang_pred, score: the chosen language's share after a soft maximum of the scores per root of
    the number of words."""
    spark = documents.sparkSession
    ship(spark)
    narrow = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    if not model.langs:
        return narrow.select("doc_id", F.lit(UNDETERMINED).alias("lang_pred"), F.lit(0.0).alias("score"))
    names = [f"l{i}" for i in range(len(model.langs))]
    top = model.words.orderBy(F.desc("all"), "unit").limit(model.most).select("unit", *names).toArrow()
    shared = spark.sparkContext.broadcast(
        (top.column("unit").to_pylist(), np.stack([top.column(x).to_numpy() for x in names], axis=1)))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units, logs = shared.value
        row_of = {unit: i for i, unit in enumerate(units)}
        for rows in batches:
            sizes, sums, rest, times = [], [], [], []
            for text in rows.column("text").to_pylist():
                counts = Counter(words_of(text)) if text else {}
                held = {row_of[w]: n for w, n in counts.items() if w in row_of}
                others = {w: n for w, n in counts.items() if w not in row_of}
                sizes.append(sum(counts.values()))
                sums.append(np.fromiter(held.values(), np.int64, len(held)) @ logs[list(held)] if held else np.zeros(len(names), np.int64))
                rest.append(list(others))
                times.append(list(others.values()))
            yield arrow.batch(
                row=rows.column("row"), doc_id=rows.column("doc_id"), size=pa.array(sizes, pa.int64()), held=pa.array(sums, pa.list_(pa.int64())),
                rest=pa.array(rest, pa.list_(pa.string())), times=pa.array(times, pa.list_(pa.int64())))

    schema = "row long, doc_id long, size long, held array<long>, rest array<string>, times array<long>"
    path = scratch_path(spark, "language-texts")
    numbered = narrow.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")
    numbered.mapInArrow(read, schema).write.parquet(path)
    texts = spark.read.schema(schema).parquet(path)
    rest = texts.select("row", F.explode(F.arrays_zip("rest", "times")).alias("x")).select("row", F.col("x.rest").alias("word"), F.col("x.times").alias("n"))
    wanted = rest.select("word").distinct()
    known = model.words.select(F.col("unit").alias("word"), *names)
    logs_of = wanted.join(known, "word").unionByName(_backed_off(wanted.join(known, "word", "left_anti"), model))
    summed = rest.join(logs_of, "word").groupBy("row").agg(*(F.sum(F.col("n") * F.col(x)).alias(x) for x in names))
    scores = F.array(*(
        (F.col("held")[i] + F.coalesce(x, F.lit(0))) / F.lit(float(SCALE)) / F.sqrt(F.greatest("size", F.lit(1))) for i, x in enumerate(names)))
    scored = texts.select("row", "doc_id", "size", "held").join(summed, "row", "left").select("doc_id", "size", scores.alias("scores"))
    best = F.array_max("scores")
    odds = F.aggregate("scores", F.lit(0.0), lambda total, x: total + F.exp(x - best))
    named = F.element_at(F.array(*map(F.lit, model.langs)), F.array_position("scores", best).cast("int"))
    return scored.select(
        "doc_id", F.when(F.col("size") > 0, named).otherwise(UNDETERMINED).alias("lang_pred"),
        F.when(F.col("size") > 0, 1 / odds).otherwise(0.0).alias("score"))


def identify(documents: DataFrame, folds: int = 4, held: int = 2) -> DataFrame:
    """Learns from the documents outside the held-out fold and predicts all: doc_id, held_out, lang_pred, score."""
    model = fit(documents.where(remainder(folds) != held).select("lang", "text"))
    return predict(documents, model).select("doc_id", held_out(folds, held).alias("held_out"), "lang_pred", "score")
