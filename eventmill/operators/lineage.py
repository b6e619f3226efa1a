"""What the lineage of Bronze rows tells about the topic: offsets that never arrived, and messages taken in twice."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

MESSAGE = ("topic", "partition")
#: Offsets of a partition that are put in order together; a topic has few partitions, but any number of blocks.
BLOCK = 1_000_000
_SOURCE = r"^kafka://(.+)/partition=(\d+)/offset=(\d+)$"


def _part(group: int) -> Column:
    return F.nullif(F.regexp_extract("source_file", _SOURCE, group), F.lit(""))


def offsets(bronze: DataFrame, dead_letters: DataFrame | None = None) -> DataFrame:
    """One row a message that arrived, with the number of batches that took it in.

    Bronze has a row an event, so a message's offset stands there many times; taken in twice, it stands there
    under two batches. A message without a usable event left a dead letter (topic, partition, offset) instead.
    """
    rows = bronze.select(
        _part(1).alias("topic"), _part(2).cast("int").alias("partition"), _part(3).cast("long").alias("offset"),
        F.coalesce("export_batch_id", F.lit("")).alias("batch"),
    ).filter("offset is not null")
    if dead_letters is not None:
        rejected = dead_letters.select("topic", F.col("partition").cast("int"), F.col("offset").cast("long"), F.lit("").alias("batch"))
        rows = rows.unionByName(rejected)
    batches = rows.groupBy(*MESSAGE, "offset", "batch").agg(F.lit(1).alias("one"))
    return batches.groupBy(*MESSAGE, "offset").agg(F.sum("one").alias("batches"))


def missing_ranges(arrived: DataFrame, block: int = BLOCK) -> DataFrame:
    """Ranges of offsets between a partition's first and last that no row speaks of.

    Neighbours are compared within blocks, and then the ends of neighbouring blocks: no task orders a partition.
    """
    blocks = arrived.select(*MESSAGE, "offset", F.expr(f"offset div {block}").alias("block"))
    before = F.lag("offset").over(Window.partitionBy(*MESSAGE, "block").orderBy("offset"))
    inside = blocks.select(*MESSAGE, before.alias("before"), F.col("offset").alias("after"))
    ends = blocks.groupBy(*MESSAGE, "block").agg(F.min("offset").alias("after"), F.max("offset").alias("last"))
    previous = F.lag("last").over(Window.partitionBy(*MESSAGE).orderBy("block"))
    between = ends.select(*MESSAGE, previous.alias("before"), "after")
    return inside.unionByName(between).filter("after > before + 1").select(
        *MESSAGE, (F.col("before") + 1).alias("first_offset"), (F.col("after") - 1).alias("last_offset"))


def offset_audit(arrived: DataFrame, block: int = BLOCK) -> DataFrame:
    """Missing ranges, and messages that more than one batch took in, with how many did. `arrived` is stored."""
    missing = missing_ranges(arrived, block).withColumns(
        {"finding": F.lit("missing"), "messages": F.col("last_offset") - F.col("first_offset") + 1, "batches": F.lit(0).cast("long")})
    replayed = arrived.filter("batches > 1").select(
        *MESSAGE, F.col("offset").alias("first_offset"), F.col("offset").alias("last_offset"), F.lit("replayed").alias("finding"),
        F.lit(1).cast("long").alias("messages"), "batches")
    return missing.unionByName(replayed)
