"""The consumer: topic messages to raw files, Bronze files and dead letters."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.ingest import bronze_from_messages, dead_letters, explode_events, normalise, raw_lines
from .sinks import MAX_ROWS_PER_FILE, batch_name, write_batch


@dataclass(frozen=True)
class Folders:
    """Where the stream writes. Raw and Bronze files can each be switched off."""

    dead_letters: str
    raw: str | None = None
    bronze: str | None = None
    max_rows_per_file: int = MAX_ROWS_PER_FILE


def write_messages(normalised: DataFrame, batch_number: int, folders: Folders) -> None:
    """One micro-batch to all sinks, reading the topic and parsing the envelopes once."""
    name = batch_name(normalised, batch_number)
    batch = normalised.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        events = explode_events(batch)
        limit = folders.max_rows_per_file
        if folders.raw:
            write_batch(raw_lines(events), folders.raw, name, "text", limit)
        if folders.bronze:
            write_batch(bronze_from_messages(events, batch_number), folders.bronze, name, "json", limit)
        write_batch(dead_letters(batch), folders.dead_letters, name, "json", limit)
    finally:
        batch.unpersist()


def consume(
    messages: DataFrame, folders: Folders, checkpoint: str, available_now: bool = False,
    every: str = "1 minute", loaded_at: Column | None = None,
) -> StreamingQuery:
    """Start consuming a stream of MESSAGE rows.

    Progress lives in `checkpoint`. The load time, unless one is given, is the micro-batch's own
    recorded time, so a repeated batch writes the same rows into the same folders.
    """
    stream = normalise(messages, F.current_timestamp() if loaded_at is None else loaded_at)
    trigger = {"availableNow": True} if available_now else {"processingTime": every}
    return (
        stream.writeStream.foreachBatch(lambda batch, number: write_messages(batch, number, folders))
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )
