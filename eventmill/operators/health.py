"""Workspace health: raw, valid and invalid counts, sessions and freshness per day and key."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.numbers import safe_ratio, whole_minutes
from ..functions.text import has_text
from ..functions.times import as_day, as_timestamp
from ..schemas import WORKSPACE_HEALTH, conform

KEYS = ("event_date", "sdk_key")


def raw_counts(bronze: DataFrame) -> DataFrame:
    """Every Bronze row counts, copies included, going by the Bronze columns alone."""
    rows = bronze.filter(has_text(F.trim("sdk_key"))).select(
        F.coalesce(as_day(F.col("event_time")), as_day(F.col("received_at"))).alias("event_date"),
        F.trim("sdk_key").alias("sdk_key"),
        as_timestamp(F.col("event_time")).alias("event_time"),
        as_timestamp(F.col("loaded_at")).alias("loaded_at"),
    )
    return rows.filter("event_date is not null").groupBy(*KEYS).agg(
        F.count("*").alias("raw_event_count"),
        F.max("event_time").alias("raw_latest_event_time"),
        F.max("loaded_at").alias("raw_latest_loaded_at"),
    )


def event_counts(kept: DataFrame) -> DataFrame:
    """Valid and invalid counts, exact distinct sessions and latest times, from one scan.

    Valid and quarantined events are booked by the same rule: the day of the event time, else
    the day of receipt. A quarantined event without either is booked on a NULL day.
    """
    is_valid = F.col("error_code").isNull()
    rows = kept.filter(has_text(F.trim("sdk_key"))).select(
        F.coalesce(F.col("event_time").cast("date"), F.col("received_at").cast("date")).alias("event_date"),
        F.trim("sdk_key").alias("sdk_key"),
        is_valid.alias("is_valid"),
        F.when(is_valid, F.col("session_id")).alias("session_id"),
        F.when(is_valid, F.col("event_time")).alias("event_time"),
        F.when(is_valid, F.col("loaded_at")).alias("loaded_at"),
    )
    return rows.groupBy(*KEYS).agg(
        F.count_if("is_valid").alias("valid_event_count"),
        F.count_if(~F.col("is_valid")).alias("invalid_event_count"),
        F.count_distinct("session_id").alias("distinct_sessions"),
        F.max("event_time").alias("valid_latest_event_time"),
        F.max("loaded_at").alias("valid_latest_loaded_at"),
    )


def valid_counts(counts: DataFrame) -> DataFrame:
    return counts.filter("valid_event_count > 0").drop("invalid_event_count")


def invalid_counts(counts: DataFrame) -> DataFrame:
    return counts.filter("invalid_event_count > 0").select(*KEYS, "invalid_event_count")


def key_spine(raw: DataFrame, counts: DataFrame) -> DataFrame:
    return raw.select(*KEYS).union(counts.select(*KEYS)).distinct()


def workspace_health(bronze: DataFrame, kept: DataFrame) -> DataFrame:
    """One row per day and key found in Bronze or among the surviving events.

    Both sides have at most one row per key, so laying them on top of each other and taking the
    one non-NULL value per column joins them on a common key list, with each input read once.
    The NULL day keeps its row but not its invalid count, because a NULL day equals no day.
    """
    stacked = raw_counts(bronze).unionByName(event_counts(kept), allowMissingColumns=True)
    measures = [name for name in stacked.columns if name not in KEYS]
    merged = stacked.groupBy(*KEYS).agg(*(F.max(name).alias(name) for name in measures))

    count = {
        name: F.coalesce(F.col(name), F.lit(0))
        for name in ("raw_event_count", "valid_event_count", "distinct_sessions")
    }
    invalid_count = F.when(
        F.col("event_date").isNotNull(), F.coalesce("invalid_event_count", F.lit(0))
    ).otherwise(F.lit(0))
    latest_event = F.coalesce("raw_latest_event_time", "valid_latest_event_time")
    latest_load = F.coalesce("raw_latest_loaded_at", "valid_latest_loaded_at")
    return conform(
        merged.select(
            *KEYS,
            *(column.alias(name) for name, column in count.items()),
            invalid_count.alias("invalid_event_count"),
            safe_ratio(invalid_count, count["raw_event_count"]).alias("invalid_event_ratio"),
            latest_event.alias("latest_event_time"),
            latest_load.alias("latest_loaded_at"),
            whole_minutes(latest_event, latest_load).alias("freshness_minutes"),
            F.current_timestamp().alias("last_updated_at"),
        ),
        WORKSPACE_HEALTH,
    )
