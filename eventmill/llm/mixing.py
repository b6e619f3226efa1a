"""A training mix with given shares of sources, by capped water-filling and seeded repetitions.

Targets: the mix takes ``total`` times all words. Each source gets words by weight, but at most ``epochs``
times its own; what is cut off is shared anew by weight among the rest until no source is above its cap.
The end of that process has a closed form: in order of cap per weight, the first sources stop at their
cap, and one level per unit of weight serves all others.

Repetitions: a source with target t and s words takes all its documents floor(t / s) times, and some once
more. Those are the first ones in a seeded order, up to the point nearest to what is left of the target.
The order is cut into hash ranges, whose sums give each range its start, and only within a range are words
added up row by row, so the largest source is spread over ``ranges`` groups.

DataFrame functions only. Decided cases: a null text has no words; it takes none. A null source is a source
of its own, the last in order. Rows that share an id follow each other, the longer one last. Sources
without words have target 0. Other columns are ignored. An empty table gives no rows. Reruns agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import scratch_path
from .columns import words

WEIGHTS, TOTAL, EPOCHS, SEED = (5, 2, 1), 1.5, 2, 42
#: Hexadecimal digits of the seeded hash that name a range.
RANGE_DIGITS = 3



def _source_key() -> Column:
    """The source, or what stands for a null one, after all others."""
    return F.when(F.col("source").isNull(), "b").otherwise(F.concat(F.lit("a"), F.col("source")))


def sized(documents: DataFrame, *carried: str) -> DataFrame:
    """doc_id, source, source_key, size, and what is only carried along."""
    along = [F.struct(*carried).alias("carried")] if carried else []
    return documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), "source", _source_key().alias("source_key"),
        F.size(words(F.col("text"))).cast("long").alias("size"), *along)


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, total: float = TOTAL, epochs: int = EPOCHS) -> DataFrame:
    """source_key, source_size and target. The windows run over sources, not documents."""
    sources = sizes.groupBy("source_key").agg(F.sum("size").alias("source_size"))
    place = (F.row_number().over(Window.orderBy("source_key")) - 1) % len(weights)
    cap: Column = F.lit(epochs) * F.col("source_size")
    named = sources.withColumn("weight", F.element_at(F.array(*(F.lit(w) for w in weights)), (place + 1).cast("int")))
    named = named.withColumn("cap", cap)
    order = Window.orderBy(F.col("cap") / F.col("weight"), "source_key")
    everything = Window.partitionBy()
    before = F.coalesce(F.sum("cap").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    after = F.sum("weight").over(order.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    wanted = F.lit(total) * F.sum("source_size").over(everything)
    # The level if this source and all later ones were not capped; the first that stays below its cap sets it.
    filled = named.withColumn("level", (wanted - before) / after)
    below = F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.struct(F.col("cap") / F.col("weight"), F.col("level").alias("level")))
    settled = filled.withColumn("common", F.min(below).over(everything)["level"])
    target = F.least(F.coalesce(F.col("common") * F.col("weight"), F.col("cap").cast("double")), F.col("cap").cast("double"))
    return settled.select("source_key", "source_size", target.alias("target"))


def mix(
    documents: DataFrame, weights: tuple[int, ...] = WEIGHTS, total: float = TOTAL, epochs: int = EPOCHS, seed: int = SEED,
    carried: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, source, size, source_size, target, and taken: the words that the mix takes of the document.

    ``carried``: columns that go along, as a struct of that name.
    """
    spark = documents.sparkSession
    path = scratch_path(spark, "mix-sizes")
    key = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    rows = sized(documents, *carried).withColumn("key", key).withColumn("range", F.substring("key", 1, RANGE_DIGITS))
    narrow = rows.drop("carried")
    narrow.write.parquet(path)
    sizes = spark.read.schema(narrow.schema).parquet(path)
    docs = rows if carried else sizes  # what is only carried is read again instead of being stored
    ranges = sizes.groupBy("source_key", "range").agg(F.sum("size").alias("range_size"))
    by_range = Window.partitionBy("source_key").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.withColumn("start", F.coalesce(F.sum("range_size").over(by_range), F.lit(0))).drop("range_size")
    ranges = ranges.join(targets(sizes, weights, total, epochs), "source_key")
    within = Window.partitionBy("source_key", "range").orderBy("key", "doc_id", "size")
    before = F.sum("size").over(within.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("size")
    joined = docs.withColumn("before", before).join(ranges, ["source_key", "range"])
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    rest = F.col("target") - whole * F.col("source_size")
    once_more = (F.col("start") + F.col("before") + F.col("size") / 2 <= rest).cast("long")
    taken = (F.col("size") * (whole + once_more)).cast("long").alias("taken")
    return joined.select("doc_id", "source", "size", "source_size", "target", taken, *(["carried"] if carried else []))
