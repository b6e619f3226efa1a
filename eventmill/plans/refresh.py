"""Refresh: Bronze files to the Bronze table, the Silver tables and the three marts.

A full refresh rebuilds every layer from the one below; `refresh_days` takes new Bronze rows in and rebuilds
only the days that they touch. What is stored is the only thing that later steps read, so a lost executor costs
its own tasks and no more.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..session import prepare
from ..sources.files import read_bronze
from .increments import Increment, refresh_days, refresh_marts
from .lake import DAY, LAYERS, Tables, create_databases, current_version, drop_lake
from .layers import build_bronze, build_funnel, build_gold, build_health, build_promotion, build_silver

__all__ = [
    "DAY", "LAYERS", "Increment", "Tables", "build_bronze", "build_funnel", "build_gold", "build_health",
    "build_promotion", "build_silver", "create_databases", "current_version", "drop_lake", "refresh", "refresh_days",
    "refresh_marts",
]


def refresh(
    spark: SparkSession,
    tables: Tables,
    direct: str | None = None,
    stream: str | None = None,
    bronze_rows: DataFrame | None = None,
    layers: tuple[str, ...] = LAYERS,
    audited: bool = False,
    allowed: tuple[str, ...] = (),
) -> Tables:
    """Rebuild the given layers, in order, from the two Bronze drops (or given Bronze rows).

    `audited`: the marts show only if `audit.findings` has nothing against them but the `allowed` checks; else
    it fails, and readers keep the marts they had. A rebuilt Bronze starts a new ledger of increments: what its rows hold must not be handed in again.
    """
    prepare(spark)
    create_databases(spark, tables)
    if "bronze" in layers:
        build_bronze(read_bronze(spark, direct, stream) if bronze_rows is None else bronze_rows, tables)
        spark.sql(f"DROP TABLE IF EXISTS {tables.increments}")
    if "silver" in layers:
        build_silver(spark, tables)
    if "gold" in layers:
        build_gold(spark, tables, audited, allowed)
    return tables
