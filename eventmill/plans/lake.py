"""The lake's tables: names, versions behind views, and writes that replace parts of a version.

Every table is stored by day, as a version of its own behind a view. A whole rebuild writes a new version
beside the old one and then switches the view: readers see the old rows or the new, and a rebuild that fails
leaves the old. The version before the current one stays, for readers still at it.
"""

from __future__ import annotations

import re
import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

LAYERS = ("bronze", "silver", "gold")
DAY = "booked_day"
#: Which increment brought a row: Bronze is filed by it within a day, so that a repeat replaces its own rows.
LOAD = "load_id"
WHOLE = "whole"
_VERSION = "__v"


@dataclass(frozen=True)
class Tables:
    """Table names; `prefix` sets the databases of one lake apart from another's.

    `index_parts`: into how many parts the event index is cut. An increment reads and writes those that its
    event ids fall into, so a part should be a few files: some 32 for each TB of events.
    """

    prefix: str = ""
    root: str | None = None
    index_parts: int = 32

    @property
    def bronze(self) -> str:
        return f"{self.prefix}bronze.events"

    @property
    def increments(self) -> str:
        return f"{self.prefix}bronze.increments"

    @property
    def runs(self) -> str:
        return f"{self.prefix}bronze.runs"

    @property
    def survivors(self) -> str:
        return f"{self.prefix}silver.survivors"

    @property
    def event_days(self) -> str:
        return f"{self.prefix}silver.event_days"

    @property
    def valid(self) -> str:
        return f"{self.prefix}silver.valid_events"

    @property
    def invalid(self) -> str:
        return f"{self.prefix}silver.invalid_events"

    @property
    def health(self) -> str:
        return f"{self.prefix}gold.workspace_health_daily"

    @property
    def promotion(self) -> str:
        return f"{self.prefix}gold.promotion_performance_daily"

    @property
    def funnel(self) -> str:
        return f"{self.prefix}gold.campaign_funnel_daily"


def create_databases(spark: SparkSession, tables: Tables) -> None:
    for layer in LAYERS:
        place = f" LOCATION '{tables.root}/{layer}'" if tables.root else ""
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {tables.prefix}{layer}{place}")


def drop_lake(spark: SparkSession, tables: Tables) -> None:
    """Remove the databases with all their tables and files."""
    for layer in LAYERS:
        spark.sql(f"DROP DATABASE IF EXISTS {tables.prefix}{layer} CASCADE")


# Versions


def named_like(spark: SparkSession, table: str, mark: str) -> list[str]:
    """The tables that belong to one, by a mark after its name, in order."""
    database, name = table.split(".")
    found = spark.sql(f"SHOW TABLES IN {database} LIKE '{name}{mark}*'").collect()
    return sorted(f"{database}.{row.tableName}" for row in found)


def current_version(spark: SparkSession, table: str) -> str:
    """The version that a table's view reads."""
    described = {row.col_name: row.data_type for row in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()}
    return re.search(rf"{re.escape(table)}{_VERSION}\w+", described["View Text"]).group()


def write_version(df: DataFrame, table: str, parts: tuple[str, ...], order: tuple[str, ...] = ()) -> str:
    """Write a new version that no view reads yet; its name.

    Rows are dealt out by the first part, large ones over several tasks, so that a part has few files.
    """
    number = 1 + max((int(re.search(rf"{_VERSION}(\d+)_", name).group(1)) for name in named_like(df.sparkSession, table, _VERSION)), default=0)
    version = f"{table}{_VERSION}{number:06d}_{uuid.uuid4().hex[:8]}"
    dealt = df.hint("rebalance", parts[0])
    dealt = dealt.sortWithinPartitions(*order) if order else dealt
    dealt.write.format("parquet").option("compression", "zstd").partitionBy(*parts).saveAsTable(version)
    return version


def publish(spark: SparkSession, table: str, version: str, views: dict[str, str]) -> None:
    """Switch the views (name: its SELECT list and filter) to a version; drop what is two versions old."""
    before = current_version(spark, table) if spark.catalog.tableExists(table) else None
    for name, select in views.items():
        spark.sql(f"CREATE OR REPLACE VIEW {name} AS {select.format(version=version)}")
    for name in named_like(spark, table, _VERSION):
        if name not in (before, version):
            spark.sql(f"DROP TABLE IF EXISTS {name}")


def columns_of(layout: T.StructType, stored_as: dict[str, str] | None = None) -> str:
    return ", ".join(f"{(stored_as or {}).get(name, name)} AS {name}" for name in layout.names)


# Parts of a version


def among(days: list) -> Column:
    """Whether a row's day is one of these; an absent day may be among them."""
    known = [day for day in days if day is not None]
    inside = F.col(DAY).isin(known) if known else F.lit(False)
    return (inside | F.col(DAY).isNull()) if None in days else inside


def overwrite_parts(df: DataFrame, version: str, deal: str, order: tuple[str, ...] = ()) -> None:
    """Replace those parts of a version that the rows belong to, by the session's setting."""
    spark = df.sparkSession
    rows = df.select(*spark.table(version).columns).hint("rebalance", deal)
    rows = rows.sortWithinPartitions(*order) if order else rows
    rows.write.mode("overwrite").insertInto(version)
    spark.catalog.refreshTable(version)


def overwrite_days(df: DataFrame, version: str, day: str, days: list, order: tuple[str, ...] = ()) -> None:
    """Replace the given days of a version; a day that gets no rows is dropped. `df` is stored elsewhere."""
    spark = df.sparkSession
    written = {row[0] for row in df.select(day).distinct().collect()}  # calendar days
    overwrite_parts(df, version, day, order)
    for gone in set(days) - written:
        value = "null" if gone is None else f"DATE'{gone}'"
        spark.sql(f"ALTER TABLE {version} DROP IF EXISTS PARTITION ({day} = {value})")
    spark.catalog.refreshTable(version)


def together(spark: SparkSession, *actions) -> None:
    """Run actions that do not depend on each other at once; one fills another's idle tail."""
    with ThreadPoolExecutor(len(actions)) as pool:
        for running in [pool.submit(inheritable_thread_target(spark)(action)) for action in actions]:
            running.result()
