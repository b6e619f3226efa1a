"""Row and error counts used to check a refresh."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.rules import all_errors


def by_source(rows: DataFrame) -> DataFrame:
    return rows.groupBy("ingestion_source").agg(F.count("*").alias("cnt")).orderBy(
        F.desc("cnt"), "ingestion_source"
    )


def by_source_and_error(rows: DataFrame) -> DataFrame:
    return rows.groupBy("ingestion_source", "error_code").agg(F.count("*").alias("cnt")).orderBy(
        "ingestion_source", F.desc("cnt"), "error_code"
    )


def by_message(parsed: DataFrame) -> DataFrame:
    """How often each sender-side complaint is found; an event may raise several."""
    complaints = parsed.select(F.explode(all_errors()).alias("complaint"))
    return complaints.groupBy("complaint").agg(F.count("*").alias("cnt"))


def row_count(rows: DataFrame) -> DataFrame:
    return rows.agg(F.count("*").alias("cnt"))


def by_partition_day(filed: DataFrame) -> DataFrame:
    """Records per day folder (`date`)."""
    return filed.groupBy("date").agg(F.count("*").alias("cnt"))
