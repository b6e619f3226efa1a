"""What each layer of the lake is built from: Bronze rows, the one Silver pass with its event index, the marts.

Bronze is read once and stored as Parquet, since four later reads use few of its columns. The Silver pass runs
once: its survivors are stored in one dataset, and the valid and the quarantine table are views on it, so
neither the parse, the shuffle nor the write is done twice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..functions.rules import error_message, validation_stage
from ..functions.text import has_text
from ..functions.times import as_day
from ..operators import funnel, health, promotion, silver
from ..schemas import (
    BRONZE, CAMPAIGN_FUNNEL, PROMOTION_PERFORMANCE, SILVER_INVALID, SILVER_VALID, WORKSPACE_HEALTH,
)
from . import audit
from .lake import DAY, LOAD, WHOLE, Tables, columns_of, current_version, publish, together, write_version

# Bronze


def booked(rows: DataFrame) -> DataFrame:
    """Bronze rows with the day they are filed under: of the event, else of receipt."""
    day = F.coalesce(as_day(F.col("event_time")), as_day(F.col("received_at")))
    return rows.select(*BRONZE.names).withColumn(DAY, day)


def build_bronze(rows: DataFrame, tables: Tables) -> None:
    spark, counts = rows.sparkSession, audit.Counts(booked(rows).withColumn(LOAD, F.lit(WHOLE)))
    version = write_version(counts.rows, tables.bronze, (DAY, LOAD))
    audit.record(spark, tables, "bronze", version, counts)
    publish(spark, tables.bronze, version, {tables.bronze: f"SELECT {columns_of(BRONZE)} FROM {{version}}"})


# Silver


def stamped(kept: DataFrame) -> DataFrame:
    """Survivors with what the Silver tables hand out, and their day."""
    code = F.col("error_code")
    return kept.withColumns({
        "error_message": error_message(code),
        "validation_stage": validation_stage(code),
        "processed_at": F.current_timestamp(),
        "outcome": F.when(code.isNull(), "valid").otherwise("invalid"),
        DAY: F.coalesce(F.col("event_time").cast("date"), F.col("received_at").cast("date")),
    })


def index_part(tables: Tables) -> Column:
    return F.pmod(F.xxhash64("event_id"), F.lit(tables.index_parts)).cast("int")


def index_rows(tables: Tables, kept: DataFrame, load: str) -> DataFrame:
    """Where each event id is kept: its day, filed by the increment that brought it there and a hash."""
    known = kept.filter(has_text(F.trim("event_id")))
    return known.select("event_id", DAY, F.lit(load).alias(LOAD), index_part(tables).alias("part"))


def build_silver(spark: SparkSession, tables: Tables) -> None:
    counts = audit.Counts(stamped(silver.ranked(silver.classify(silver.parse(spark.table(tables.bronze))))))
    version = write_version(counts.rows, tables.survivors, (DAY,), ("outcome",))
    audit.record(spark, tables, "silver", version, counts)
    index = write_version(index_rows(tables, spark.table(version), WHOLE), tables.event_days, ("part", LOAD), ("event_id",))
    valid = columns_of(SILVER_VALID, {"event_date": DAY, "validated_at": "processed_at"})
    invalid = columns_of(SILVER_INVALID, {"event_time": "event_time_text", "detected_at": "processed_at"})
    publish(spark, tables.survivors, version, {
        tables.survivors: "SELECT * FROM {version}",
        tables.valid: f"SELECT {valid} FROM {{version}} WHERE outcome = 'valid'",
        tables.invalid: f"SELECT {invalid} FROM {{version}} WHERE outcome = 'invalid'",
    })
    publish(spark, tables.event_days, index, {tables.event_days: f"SELECT event_id, {DAY} FROM {{version}}"})


# Gold

#: Mart files are ordered by workspace, so that a list for one workspace skips most of a day.
MART_ORDER = ("sdk_key",)
MART_DAY = "event_date"


def health_mart(spark: SparkSession, tables: Tables, of: Column | None = None) -> DataFrame:
    bronze = spark.table(current_version(spark, tables.bronze))
    kept = spark.table(tables.survivors)
    return health.workspace_health(*(rows if of is None else rows.filter(of) for rows in (bronze, kept)))


def _valid(spark: SparkSession, tables: Tables, of: Column | None) -> DataFrame:
    kept = spark.table(tables.survivors)
    rows = (kept if of is None else kept.filter(of)).filter("outcome = 'valid'")
    return rows.selectExpr(*(f"{name} AS {name}" for name in rows.columns if name != DAY), f"{DAY} AS event_date")


def promotion_mart(spark: SparkSession, tables: Tables, of: Column | None = None) -> DataFrame:
    return promotion.promotion_performance(promotion.promotion_rollup(_valid(spark, tables, of)))


def funnel_mart(spark: SparkSession, tables: Tables, of: Column | None = None) -> DataFrame:
    return funnel.campaign_funnel(_valid(spark, tables, of))


MARTS = {
    "health": (health_mart, WORKSPACE_HEALTH),
    "promotion": (promotion_mart, PROMOTION_PERFORMANCE),
    "funnel": (funnel_mart, CAMPAIGN_FUNNEL),
}


def write_mart(spark: SparkSession, tables: Tables, name: str) -> str:
    """A new version of a mart, which no view reads yet."""
    return write_version(MARTS[name][0](spark, tables), getattr(tables, name), (MART_DAY,), MART_ORDER)


def publish_mart(spark: SparkSession, tables: Tables, name: str, version: str) -> None:
    table = getattr(tables, name)
    publish(spark, table, version, {table: f"SELECT {columns_of(MARTS[name][1])} FROM {{version}}"})


def build_health(spark: SparkSession, tables: Tables) -> None:
    publish_mart(spark, tables, "health", write_mart(spark, tables, "health"))


def build_promotion(spark: SparkSession, tables: Tables) -> None:
    publish_mart(spark, tables, "promotion", write_mart(spark, tables, "promotion"))


def build_funnel(spark: SparkSession, tables: Tables) -> None:
    publish_mart(spark, tables, "funnel", write_mart(spark, tables, "funnel"))


def write_gold(spark: SparkSession, tables: Tables) -> dict[str, str]:
    """New versions of all marts, by name."""
    versions: dict[str, str] = {}
    together(spark, *(lambda name=name: versions.update({name: write_mart(spark, tables, name)}) for name in MARTS))
    return versions


def build_gold(spark: SparkSession, tables: Tables, audited: bool = False, allowed: tuple[str, ...] = ()) -> None:
    """Write all marts, then show them; if they are audited, only once none has a finding but the allowed ones."""
    versions = write_gold(spark, tables)
    if audited:
        audit.require_clean(spark, tables, versions, allowed)
    for name, version in versions.items():
        publish_mart(spark, tables, name, version)
