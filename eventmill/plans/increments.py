"""Increments: new Bronze rows into a lake exactly once, whatever fails on the way.

An increment is named by its source, run and batch; one without a name is known by its rows. The ledger, a
small table beside Bronze, records how far each has come:

  begun      its rows are stored apart, before any table is touched
  settled    the new contents of the Silver days it touches are stored apart as well
  committed  Bronze, Silver and the event index have been written
  reported   the marts of its days have been rebuilt

A table is only written from rows that are stored apart, and only in parts that the increment owns or replaces
whole: its own folder within each Bronze day, its own rows of the event index, whole days of Silver. So any of
these writes can be repeated, and a run that finds an increment unfinished takes it up where its record ends.
Handing the same increment in again changes nothing. There is one writer at a time.

Which days hold an event id is read from the event index, so rivals of new events are looked for in those days
alone. The index lists every day that an id has been kept on since the last full refresh: at worst a day is read
for nothing.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, Row, SparkSession, functions as F

from ..functions.text import has_text
from ..operators import silver
from ..schemas import BRONZE
from ..session import checkpointed, prepare, stored
from . import layers
from .lake import (
    DAY, LOAD, Tables, among, current_version, named_like, overwrite_days, overwrite_parts, together,
)

BEGUN, SETTLED, COMMITTED, REPORTED = STEPS = ("begun", "settled", "committed", "reported")
_LEDGER = (
    "load_id string, source string, run string, batch string, step string, bronze_version string,"
    " fingerprint string, row_count long, place string, days array<date>, recorded_at timestamp")
_NEW, _SETTLED = "__new_", "__settled_"


@dataclass(frozen=True)
class Increment:
    """The name of an increment. The same one always stands for the same rows."""

    source: str
    run: str
    batch: str

    @property
    def load_id(self) -> str:
        return "/".join((self.source, self.run, self.batch))


class Ledger:
    """How far the increments on top of the current Bronze version have come."""

    def __init__(self, spark: SparkSession, tables: Tables):
        self.spark, self.table = spark, tables.increments
        self.version = current_version(spark, tables.bronze)
        spark.sql(f"CREATE TABLE IF NOT EXISTS {self.table} ({_LEDGER}) USING parquet")

    def _latest(self) -> DataFrame:
        """The last record of each increment since the last full refresh."""
        place = F.array_position(F.array(*map(F.lit, STEPS)), F.col("step"))
        rows = self.spark.table(self.table).filter(F.col("bronze_version") == self.version)
        return rows.groupBy("load_id").agg(F.max_by(F.struct("*"), place).alias("entry")).select("entry.*")

    def find(self, load_id: str) -> Row | None:
        return self._latest().filter(F.col("load_id") == load_id).first()

    def at(self, *steps: str) -> list[Row]:
        """Increments that have come as far as one of the steps and no further, in the order they got there."""
        return self._latest().filter(F.col("step").isin(*steps)).orderBy("recorded_at").collect()

    def record(self, entry: Row, step: str, days: list | None = None) -> Row:
        known = entry.asDict() | {"step": step, "bronze_version": self.version, "recorded_at": None}
        known["days"] = known.get("days") if days is None else days
        names = self.spark.table(self.table).columns
        row = self.spark.createDataFrame([tuple(known[name] for name in names)], _LEDGER)
        row.withColumn("recorded_at", F.current_timestamp()).write.mode("append").insertInto(self.table)
        self.spark.catalog.refreshTable(self.table)
        return Row(**known)


def _stored(df: DataFrame, name: str, *parts: str) -> DataFrame:
    """Rows kept apart; what an earlier attempt left there goes."""
    spark = df.sparkSession
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    writer = df.write.format("parquet").mode("overwrite").option("compression", "zstd")
    (writer.partitionBy(*parts) if parts else writer).saveAsTable(name)
    return spark.table(name)


def _fingerprint(rows: DataFrame) -> tuple[str, int]:
    """What tells one bag of Bronze rows from another, and their number."""
    one, two = F.xxhash64(*BRONZE.names), F.xxhash64(F.lit("again"), *BRONZE.names)
    found = rows.agg(F.count("*").alias("n"), *(F.sum(x.cast("decimal(20,0)")).alias(name) for name, x in (("one", one), ("two", two)))).first()
    return f"{found.n}:{found.one}:{found.two}", found.n


# Silver


def holding_days(spark: SparkSession, tables: Tables, ids: DataFrame) -> list:
    """The days that may hold one of the event ids (event_id, part)."""
    parts = [row[0] for row in ids.select("part").distinct().collect()]  # numbers of index parts
    index = spark.table(current_version(spark, tables.event_days)).filter(F.col("part").isin(parts))
    return [row[0] for row in index.join(ids, ["part", "event_id"], "left_semi").select(DAY).distinct().collect()]  # calendar days


def rivals(spark: SparkSession, tables: Tables, ids: DataFrame) -> DataFrame:
    """Survivors with one of the event ids, read from the days that may hold them."""
    kept = spark.table(current_version(spark, tables.survivors))
    return kept.filter(among(holding_days(spark, tables, ids))).join(ids, "event_id", "left_semi")


def _settle(spark: SparkSession, tables: Tables, ledger: Ledger, entry: Row) -> Row:
    """Rank new rows against the survivors that share their event ids, and store what the days become.

    A copy of a known event may come late, and on another day than the survivor it replaces. The days of both,
    before and after, get new contents, and no others.
    """
    new = spark.table(f"{tables.bronze}{_NEW}{entry.place}")
    kept = spark.table(current_version(spark, tables.survivors))
    fresh = silver.classify(silver.parse(new))
    ids = stored(fresh.select("event_id").filter(has_text(F.trim("event_id"))).distinct().withColumn("part", layers.index_part(tables)))
    known = rivals(spark, tables, ids)
    winners = silver.ranked(fresh.unionByName(known.select(*fresh.columns)))
    winners = stored(layers.stamped(winners).select(*kept.columns))
    touched = reduce(DataFrame.union, (rows.select(DAY) for rows in (new, known, winners))).distinct()
    days = [row[0] for row in touched.collect()]  # calendar days
    others = kept.filter(among(days)).join(ids, "event_id", "left_anti")
    settled = others.withColumn("won", F.lit(False)).unionByName(winners.withColumn("won", F.lit(True)))
    _stored(settled, f"{tables.survivors}{_SETTLED}{entry.place}")
    return ledger.record(entry, SETTLED, sorted(days, key=str))


def _commit(spark: SparkSession, tables: Tables, ledger: Ledger, entry: Row) -> Row:
    """Write Bronze, Silver and the index from what is stored apart; each write may be a repeat."""
    new = spark.table(f"{tables.bronze}{_NEW}{entry.place}").withColumn(LOAD, F.lit(entry.load_id))
    settled = spark.table(f"{tables.survivors}{_SETTLED}{entry.place}")
    overwrite_parts(new, current_version(spark, tables.bronze), DAY)
    overwrite_days(settled, current_version(spark, tables.survivors), DAY, entry.days, ("outcome",))
    index = layers.index_rows(tables, settled.filter("won"), entry.load_id)
    overwrite_parts(index, current_version(spark, tables.event_days), "part", ("event_id",))
    return ledger.record(entry, COMMITTED)


# Marts


def refresh_marts(spark: SparkSession, tables: Tables) -> list:
    """Rebuild the days of the marts that committed increments have touched since; those days."""
    prepare(spark)
    ledger = Ledger(spark, tables)
    stale = ledger.at(COMMITTED)
    days = sorted({day for entry in stale for day in entry.days}, key=str)
    if days:
        together(spark, *(
            lambda name=name, mart=mart: overwrite_days(
                checkpointed(mart(spark, tables, among(days))), current_version(spark, getattr(tables, name)),
                layers.MART_DAY, days, layers.MART_ORDER)
            for name, (mart, _) in layers.MARTS.items()))
    for entry in stale:
        ledger.record(entry, REPORTED)
    return days


# The run


def _forget(spark: SparkSession, tables: Tables, needed: list[Row]) -> None:
    """Drop rows kept apart for increments that no longer need them, or that never began."""
    places = {entry.place for entry in needed}
    for table, mark in ((tables.bronze, _NEW), (tables.survivors, _SETTLED)):
        for name in named_like(spark, table, mark):
            if name.rpartition("_")[2] not in places:
                spark.sql(f"DROP TABLE IF EXISTS {name}")


def _finish(spark: SparkSession, tables: Tables, ledger: Ledger, entry: Row) -> Row:
    if entry.step == BEGUN:
        entry = _settle(spark, tables, ledger, entry)
    if entry.step == SETTLED:
        entry = _commit(spark, tables, ledger, entry)
    return entry


def recover(spark: SparkSession, tables: Tables) -> None:
    """Finish the increments that an earlier run left unfinished, in the order in which they began."""
    prepare(spark)
    ledger = Ledger(spark, tables)
    unfinished = ledger.at(BEGUN, SETTLED)
    _forget(spark, tables, unfinished)
    for entry in unfinished:
        _finish(spark, tables, ledger, entry)


def refresh_days(
    spark: SparkSession, tables: Tables, new_rows: DataFrame, increment: Increment | None = None, gold: bool = True,
) -> list:
    """Take new Bronze rows in once, and rebuild only the days that they touch; returns those days.

    An increment that has been taken in before changes nothing, be it the last run's or an older one; rows that
    differ from those first handed in under its name are refused. Without a name, equal rows are the same
    increment. An earlier run's unfinished increment is finished first. `gold=False` leaves the marts to a later
    run or `refresh_marts`.
    """
    recover(spark, tables)
    ledger = Ledger(spark, tables)
    place = uuid.uuid4().hex
    rows = _stored(layers.booked(new_rows), f"{tables.bronze}{_NEW}{place}")
    fingerprint, count = _fingerprint(rows)
    name = increment or Increment("rows", fingerprint, "")
    known = ledger.find(name.load_id)
    if known is None:
        entry = Row(**vars(name), load_id=name.load_id, fingerprint=fingerprint, row_count=count, place=place)
        known = _finish(spark, tables, ledger, ledger.record(entry, BEGUN))
    elif known.fingerprint != fingerprint:
        raise ValueError(f"increment {name.load_id} was taken in before, with other rows")
    if gold:
        refresh_marts(spark, tables)
    _forget(spark, tables, [])
    return known.days
