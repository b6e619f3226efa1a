"""Batch writes that can be repeated.

Files are filed by day and by micro-batch, and a batch replaces exactly its own folders. A batch that is
run again after a failure thus leaves no second copy behind. A batch's name holds the run it belongs to,
which stays the same as long as the stream's checkpoint does: streams that write to the same folders, and a
stream that starts anew with another checkpoint, leave each other's files alone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

# Rows per file. Small files are what a stream suffers from; the limit only keeps a single file
# from growing without bound.
MAX_ROWS_PER_FILE = 1_000_000
# Files taken into one micro-batch, so that a first run over a backlog is many batches of bounded size.
MAX_FILES_PER_BATCH = 1000


def batch_name(batch: DataFrame, number: int) -> str:
    """Names a micro-batch within foreachBatch: the identity that the checkpoint keeps, and the number."""
    run = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
    if not run:
        raise ValueError("not within a streaming query")
    return f"{run}-{number}"


def write_batch(
    rows: DataFrame, folder: str, batch: str, file_format: str = "json",
    max_rows_per_file: int = MAX_ROWS_PER_FILE,
) -> None:
    """Write rows with a `date` column under folder/date=.../batch=...

    Rows are dealt out by day first, a large day over several tasks, so that a day has few files. Files are
    compressed, which any Spark reader undoes: their lines shrink to a tenth.
    """
    (
        rows.withColumn("batch", F.lit(batch))
        .hint("rebalance", "date")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("maxRecordsPerFile", max_rows_per_file)
        .option("compression", "gzip")
        .partitionBy("date", "batch")
        .format(file_format)
        .save(folder)
    )
