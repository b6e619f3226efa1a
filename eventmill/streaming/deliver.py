"""Delivery of finished Bronze batch files into the lake's two drops. Each file is taken once.

What has been delivered is remembered by the stream's checkpoint. Where deliveries are instead
recorded in a table, `sources.files.pending_deliveries` names the files still to go.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from ..sources.files import DIRECT_GLOB, STREAM_GLOB
from .sinks import MAX_FILES_PER_BATCH, MAX_ROWS_PER_FILE, batch_name, write_batch

PATTERNS = {"direct": DIRECT_GLOB, "kafka": STREAM_GLOB}


def deliver_new_files(
    spark: SparkSession, source: str, folder: str, drop: str, checkpoint: str,
    max_rows_per_file: int = MAX_ROWS_PER_FILE, max_files: int = MAX_FILES_PER_BATCH,
) -> StreamingQuery:
    """Copy the lines of files not yet delivered from `folder` to `drop`, then stop.

    `source` is 'direct' or 'kafka'. Lines stay under their file's day folder; those of a file
    that has none go under the day of delivery.
    """
    lines = (
        spark.readStream.format("text")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", PATTERNS[source])
        .option("maxFilesPerTrigger", max_files)
        .load(folder)
    )
    day = F.regexp_extract(F.col("_metadata.file_path"), r"/date=(\d{4}-\d{2}-\d{2})/", 1)
    filed = lines.select(
        "value", F.coalesce(day.try_cast("date"), F.current_date()).alias("date")
    )

    def write(batch: DataFrame, number: int) -> None:
        write_batch(batch, drop, batch_name(batch, number), "text", max_rows_per_file)

    return (
        filed.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
