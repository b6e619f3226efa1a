"""What is known of a layer as it is written: counts observed on the way, and the audit of marts before they show.

Counts by ingestion source and error code are taken from the rows while they are written, by the write's own
job, so the censuses of a refresh need no further scan. Marts are audited as versions that no view reads yet: a
version with a finding is dropped, and readers keep the one before.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from ..functions.rules import RULES
from ..functions.text import has_text
from ..operators import serve
from ..sources.files import DIRECT_TAG, ROOT_TAGS, STREAM_TAG
from .lake import DAY, Tables, current_version

#: Sources that are counted by name; rows of any other are counted together.
SOURCES = tuple(dict.fromkeys((DIRECT_TAG, *ROOT_TAGS.values(), STREAM_TAG, "unknown")))
OTHER = "(other)"
CODES = tuple(code for code, _, _ in RULES)
_RUNS = "table_name string, version string, ingestion_source string, error_code string, cnt long, recorded_at timestamp"


# Counts observed while writing


class Counts:
    """Counts the rows of a write by source and, where they have one, by error code."""

    def __init__(self, rows: DataFrame):
        source = F.coalesce(F.trim("ingestion_source"), F.lit("unknown"))
        by_source = {name: source == name for name in SOURCES} | {OTHER: ~source.isin(*SOURCES)}
        by_code: dict[str | None, Column] = {None: F.lit(True)}
        if "error_code" in rows.columns:
            by_code = {None: F.col("error_code").isNull()} | {code: F.col("error_code").eqNullSafe(F.lit(code)) for code in CODES}
        self._cells = [(name, code) for name in by_source for code in by_code]
        self._observation = Observation()
        self.rows = rows.observe(self._observation, *(
            F.count_if(by_source[name] & by_code[code]).alias(f"c{i}") for i, (name, code) in enumerate(self._cells)))

    def found(self) -> list[tuple[str, str | None, int]]:
        """(source, code, rows) of what has been written; it waits for the write."""
        counts = self._observation.get
        return [(*cell, counts[f"c{i}"]) for i, cell in enumerate(self._cells) if counts[f"c{i}"]]


def record(spark: SparkSession, tables: Tables, name: str, version: str, counts: Counts) -> None:
    """Keep a version's counts in the table of runs."""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {tables.runs} ({_RUNS}) USING parquet")
    rows = [(name, version, source, code, cnt, None) for source, code, cnt in counts.found()]
    kept = spark.createDataFrame(rows, _RUNS).withColumn("recorded_at", F.current_timestamp())
    kept.coalesce(1).write.mode("append").insertInto(tables.runs)


def observed(spark: SparkSession, tables: Tables, name: str) -> DataFrame:
    """(ingestion_source, error_code, cnt) of a table's current version, as counted when it was written whole."""
    table = {"bronze": tables.bronze, "silver": tables.survivors}[name]
    runs = spark.table(tables.runs).filter(F.col("version") == current_version(spark, table))
    return runs.select("ingestion_source", "error_code", "cnt")


# Audit before publishing


class AuditFailed(Exception):
    """Versions were not published; the message names the findings."""


def _difference(check: str, more: DataFrame, less: DataFrame, floor: int | None = None) -> DataFrame:
    """By how much one total (n) differs from another, or exceeds it by more than the floor."""
    both = more.select(F.col("n").cast("long")).union(less.select(-F.col("n").cast("long"))).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"))
    size = F.abs("n") if floor is None else F.greatest(F.col("n"), F.lit(floor))
    return both.select(F.lit(check).alias("check"), size.cast("long").alias("violations"))


def _rows(of: DataFrame) -> DataFrame:
    return of.agg(F.count("*").alias("n"))


def findings(spark: SparkSession, tables: Tables, versions: dict[str, str]) -> DataFrame:
    """(check, violations) of mart versions (by "health", "promotion", "funnel"): contract, then reconciliation.

    contract_*: rows of the served list that miss a value they must have. reconciled_*: by how much the health
    mart's total of raw, valid or invalid events differs from the rows it counts. covered: Silver rows beyond those
    of Bronze.
    """
    lists = serve.dashboard(*(spark.table(versions[name]) for name in ("health", "promotion", "funnel")))
    contract = [
        serve.contract_violations(rows, serve.NULLABLE[name]).agg(
            F.lit(f"contract_{name}").alias("check"), F.count("*").alias("violations"))
        for name, rows in lists.items()]
    bronze = spark.table(current_version(spark, tables.bronze))
    kept = spark.table(current_version(spark, tables.survivors))
    booked = has_text(F.trim("sdk_key")) & F.col(DAY).isNotNull()
    mart = spark.table(versions["health"])
    counted = {"raw": bronze.filter(booked)} | {
        outcome: kept.filter(booked & (F.col("outcome") == outcome)) for outcome in ("valid", "invalid")}
    return reduce(DataFrame.unionByName, [
        *contract,
        *(_difference(f"reconciled_{kind}", mart.agg(F.sum(f"{kind}_event_count").alias("n")), _rows(rows)) for kind, rows in counted.items()),
        _difference("covered", _rows(kept), _rows(bronze), floor=0),
    ])


def require_clean(spark: SparkSession, tables: Tables, versions: dict[str, str], allowed: tuple[str, ...] = ()) -> None:
    """Drop the versions and fail if a check that isn't allowed to has findings."""
    found = {row.check: row.violations for row in findings(spark, tables, versions).filter("violations > 0").collect()}
    wrong = {check: n for check, n in found.items() if check not in allowed}
    if wrong:
        for version in versions.values():
            spark.sql(f"DROP TABLE IF EXISTS {version}")
        raise AuditFailed(", ".join(f"{check}: {n}" for check, n in sorted(wrong.items())))
