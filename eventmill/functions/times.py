from __future__ import annotations

from pyspark.sql import Column, functions as F

from .text import stripped


def as_timestamp(text: Column) -> Column:
    """Parse, giving NULL where the text is no timestamp (a plain cast would raise)."""
    return text.try_cast("timestamp")


def as_day(text: Column) -> Column:
    return as_timestamp(text).cast("date")


def iso_text(name: str) -> str:
    """ISO text of a timestamp column, as SQL; microseconds are left out where they are zero."""
    return f"regexp_replace(date_format({name}, \"yyyy-MM-dd'T'HH:mm:ss.SSSSSS\"), '[.]000000$', '')"


def partition_day(received_at: Column, today: Column) -> Column:
    """Day a received record is filed under: the day as written, in the sender's own offset.

    Cast to a date would first convert to the session time zone; the leading ten characters
    keep the sender's calendar day. Anything unparseable goes under `today`.
    """
    text = stripped(received_at)
    written_day = F.when(
        text.rlike(r"^\d{4}-\d{2}-\d{2}") & as_timestamp(text).isNotNull(),
        F.substring(text, 1, 10).try_cast("date"),
    )
    return F.coalesce(written_day, today.cast("date"))
