"""Bronze rows, as a stream, into the lake's Bronze and Silver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..plans.increments import Increment, refresh_days
from ..plans.lake import Tables
from ..schemas import BRONZE
from .sinks import MAX_FILES_PER_BATCH, batch_name


def read_bronze_stream(spark: SparkSession, folder: str, max_files: int = MAX_FILES_PER_BATCH) -> DataFrame:
    """Bronze rows of a folder's JSON files, each file once."""
    return (
        spark.readStream.schema(BRONZE).option("recursiveFileLookup", True).option("maxFilesPerTrigger", max_files).json(folder)
    )


def stream_into_lake(
    bronze: DataFrame, tables: Tables, checkpoint: str, gold: bool = False, available_now: bool = False, every: str = "1 minute",
) -> StreamingQuery:
    """Keep Bronze and Silver up to date with a stream of Bronze rows; the tables exist already.

    Each micro-batch is an increment, named by the stream's identity and the batch's number, so a batch that is
    run again after a failure changes nothing that it has changed before. Its events compete with the survivors
    that share their ids, wherever those are filed: an event may come late, in any order and any number of times,
    and Silver is what one pass over all rows so far would give. The marts follow if `gold` says so; else
    `refresh_marts` rebuilds the days touched since, once for many batches.
    """
    def take(batch: DataFrame, number: int) -> None:
        run, _, place = batch_name(batch, number).rpartition("-")
        refresh_days(batch.sparkSession, tables, batch, Increment("stream", run, place), gold=gold)

    trigger = {"availableNow": True} if available_now else {"processingTime": every}
    return bronze.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint).trigger(**trigger).start()
