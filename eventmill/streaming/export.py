"""Export of new raw files to Bronze files. Each raw file is taken once."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.ingest import bronze_from_records, read_records, strict
from ..sources.files import read_raw_lines
from .sinks import MAX_FILES_PER_BATCH, MAX_ROWS_PER_FILE, batch_name, write_batch


def write_records(
    records: DataFrame, batch_number: int, out: str, rejects: str | None, max_rows_per_file: int
) -> None:
    """Records to Bronze files; bad lines go to `rejects`, or fail the batch if there is none."""
    day = F.col("exported_moment").cast("date")
    if rejects is None:
        good = strict(records)
        _write_bronze(good, batch_number, out, max_rows_per_file)
        return
    batch = records.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        _write_bronze(batch.filter("problem is null"), batch_number, out, max_rows_per_file)
        bad = batch.filter("problem is not null").select("file_key", "problem", "line", day.alias("date"))
        write_batch(bad, rejects, batch_name(records, batch_number), "json", max_rows_per_file)
    finally:
        batch.unpersist()


def _write_bronze(records: DataFrame, batch_number: int, out: str, max_rows_per_file: int) -> None:
    rows = bronze_from_records(records, F.col("exported_moment"), batch_number)
    filed = rows.withColumn("date", F.to_date(F.substring("exported_at", 1, 10)))
    write_batch(filed, out, batch_name(records, batch_number), "json", max_rows_per_file)


def export_new_files(
    spark: SparkSession, base: str, out: str, checkpoint: str, rejects: str | None = None,
    max_rows_per_file: int = MAX_ROWS_PER_FILE, max_files: int = MAX_FILES_PER_BATCH,
) -> StreamingQuery:
    """Export what the raw roots below `base` hold and earlier runs have not taken, then stop.

    It goes by batches of `max_files` files.
    """
    records = read_records(read_raw_lines(spark, base, max_files=max_files)).withColumn(
        "exported_moment", F.current_timestamp()
    )
    return (
        records.writeStream.foreachBatch(
            lambda batch, number: write_records(batch, number, out, rejects, max_rows_per_file)
        )
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
