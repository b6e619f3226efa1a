"""Increments into a lake: once each, whatever fails; rivals by the event index; a stream of them."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import DataFrameWriter, functions as F

from eventmill.plans import increments
from eventmill.plans.increments import Increment, Ledger, holding_days, recover, refresh_days, refresh_marts, rivals
from eventmill.plans.lake import Tables, current_version, named_like
from eventmill.plans.layers import index_part
from eventmill.plans.refresh import refresh
from eventmill.session import scratch_path
from eventmill.streaming.lake import read_bronze_stream, stream_into_lake

STAMPS = ("validated_at", "detected_at", "last_updated_at")


def at(day, **row):
    return {"event_time": f"2026-04-{day:02d}T10:00:00Z", "event_id": f"e{day}", **row}


FIRST = [at(1), at(2), at(3), at(3, event_id="x", page_url=""), at(4, event_id="late", loaded_at="2026-04-04T00:00:00Z")]
# A newer copy of e2, one of "late" on another day, a valid copy of x, a new event, and rows without an id.
MORE = [
    at(2, loaded_at="2026-05-02T00:00:00Z", session_id="s9"), at(5, event_id="late", loaded_at="2026-05-02T00:00:00Z"),
    at(3, event_id="x"), at(6), at(2, event_id=None, page_url="/a"), at(2, event_id=None, page_url="/b"), at(2, event_id=" ")]


def lake(spark, name):
    return Tables(prefix=f"{name}_", root=scratch_path(spark, "lake"))


def contents(spark, tables, gold=True):
    names = ("bronze", "valid", "invalid", *(("health", "promotion", "funnel") if gold else ()))
    frames = {name: spark.table(getattr(tables, name)) for name in names}
    return {name: sorted(map(str, f.drop(*STAMPS).collect())) for name, f in frames.items()}


@pytest.fixture(scope="module")
def expected(spark):
    """What one full refresh over all rows gives."""
    import json

    from eventmill.schemas import BRONZE

    defaults = {
        "received_at": "2026-04-30T10:00:00Z", "sdk_key": "k1", "event_type": "page_view", "session_id": "s1", "page_url": "/",
        "exported_at": None, "export_batch_id": "b", "source_file": "f", "ingestion_source": "direct_raw",
        "loaded_at": "2026-04-30T11:00:00Z", "raw_event_json": json.dumps({})}
    rows = [tuple({**defaults, **row}[name] for name in BRONZE.names) for row in (*FIRST, *MORE)]
    tables = lake(spark, "once")
    refresh(spark, tables, bronze_rows=spark.createDataFrame(rows, BRONZE))
    return contents(spark, tables)


def test_the_same_rows_twice_change_nothing(spark, bronze, expected):
    tables = lake(spark, "twice_in")
    refresh(spark, tables, bronze_rows=bronze(*FIRST))
    days = refresh_days(spark, tables, bronze(*MORE))
    assert contents(spark, tables) == expected
    assert {d.day for d in days} == {2, 3, 4, 5, 6}
    before = {t: spark.table(current_version(spark, t)).inputFiles() for t in (tables.bronze, tables.survivors)}
    assert refresh_days(spark, tables, bronze(*reversed(MORE))) == days
    assert {t: spark.table(current_version(spark, t)).inputFiles() for t in before} == before
    assert contents(spark, tables) == expected
    assert not named_like(spark, tables.bronze, "__new_") + named_like(spark, tables.survivors, "__settled_")


def test_equal_rows_under_two_names_are_two_increments(spark, bronze):
    tables = lake(spark, "named")
    refresh(spark, tables, bronze_rows=bronze(at(1)))
    row = bronze(at(1, event_id=None))
    for batch in ("1", "2", "1"):
        refresh_days(spark, tables, row, Increment("feed", "r", batch), gold=False)
    assert spark.table(tables.bronze).count() == 3 and spark.table(tables.invalid).count() == 2
    with pytest.raises(ValueError, match="other rows"):
        refresh_days(spark, tables, bronze(at(2)), Increment("feed", "r", "1"), gold=False)
    assert spark.table(tables.bronze).count() == 3
    refresh(spark, tables, bronze_rows=bronze(at(1)))  # a new Bronze, a new ledger
    refresh_days(spark, tables, row, Increment("feed", "r", "1"))
    assert spark.table(tables.bronze).count() == 2


class Failing:
    """Writes that stop working after, or at, a given one."""

    def __init__(self, monkeypatch, allowed, after):
        self.left, self.after = allowed, after
        for name in ("saveAsTable", "insertInto"):
            plain = getattr(DataFrameWriter, name)
            monkeypatch.setattr(DataFrameWriter, name, lambda writer, *a, plain=plain, **k: self._write(plain, writer, a, k))

    def _write(self, plain, writer, args, named):
        if self.left == 0 and not self.after:
            raise RuntimeError("stopped")
        out = plain(writer, *args, **named)
        self.left -= 1
        if self.left == 0 and self.after:
            raise RuntimeError("stopped")
        return out


#: Rows stored, begun, settled, recorded, Bronze, Silver, index, recorded, three marts, recorded.
WRITES = 12


@pytest.mark.parametrize("write", range(1, WRITES + 1))
def test_a_failure_after_any_write_is_mended_by_a_repeat(spark, bronze, expected, write):
    tables = lake(spark, f"fail{write}")
    refresh(spark, tables, bronze_rows=bronze(*FIRST))
    with pytest.MonkeyPatch.context() as patch:
        Failing(patch, write, after=True)
        with pytest.raises(RuntimeError, match="stopped"):
            refresh_days(spark, tables, bronze(*MORE))
    refresh_days(spark, tables, bronze(*MORE))
    assert contents(spark, tables) == expected


def test_an_unfinished_increment_is_finished_by_the_next(spark, bronze, expected):
    tables = lake(spark, "next_in")
    refresh(spark, tables, bronze_rows=bronze(*FIRST))
    with pytest.MonkeyPatch.context() as patch:
        Failing(patch, 5, after=True)  # Bronze is written, Silver is not
        with pytest.raises(RuntimeError):
            refresh_days(spark, tables, bronze(*MORE[:4]), Increment("feed", "r", "1"))
    refresh_days(spark, tables, bronze(*MORE[4:]), Increment("feed", "r", "2"))
    assert contents(spark, tables) == expected
    assert {(e.batch, e.step) for e in Ledger(spark, tables).at(*increments.STEPS)} == {("1", "reported"), ("2", "reported")}


def test_rows_that_cannot_be_read_begin_nothing(spark, bronze):
    tables = lake(spark, "unread")
    refresh(spark, tables, bronze_rows=bronze(at(1)))
    broken = bronze(at(2)).withColumn("page_url", F.raise_error(F.lit("stop")).cast("string"))
    with pytest.raises(Exception, match="stop"):
        refresh_days(spark, tables, broken)
    recover(spark, tables)
    assert not Ledger(spark, tables).at(*increments.STEPS) and not named_like(spark, tables.bronze, "__new_")
    assert refresh_days(spark, tables, bronze()) == []  # no rows touch no days


def test_rivals_are_read_from_the_days_that_hold_them(spark, bronze):
    tables = lake(spark, "index")
    refresh(spark, tables, bronze_rows=bronze(*(at(d) for d in range(1, 20)), at(7, event_id=None), at(8, event_id=" ")))
    ids = spark.createDataFrame([("e3",), ("e11",), ("unknown",)], "event_id string").withColumn("part", index_part(tables))
    assert {d.day for d in holding_days(spark, tables, ids)} == {3, 11}
    read = rivals(spark, tables, ids)
    assert {f.split("booked_day=")[1][:10] for f in read.inputFiles()} == {"2026-04-03", "2026-04-11"}
    assert {r.event_id for r in read.collect()} == {"e3", "e11"}
    index = spark.table(current_version(spark, tables.event_days)).filter(F.col("part").isin([r.part for r in ids.collect()]))
    assert "PartitionFilters: [part" in index._jdf.queryExecution().executedPlan().toString()
    assert spark.table(tables.event_days).count() == 19  # no rows without an id


def test_the_index_follows_an_event_to_its_new_day(spark, bronze):
    tables = lake(spark, "moves")
    refresh(spark, tables, bronze_rows=bronze(at(1, event_id="m"), at(2)))
    for day in (4, 6):
        refresh_days(spark, tables, bronze(at(day, event_id="m", loaded_at=f"2026-05-{day:02d}T00:00:00Z")), gold=False)
    ids = spark.createDataFrame([("m",)], "event_id string").withColumn("part", index_part(tables))
    assert {d.day for d in holding_days(spark, tables, ids)} == {1, 4, 6}
    assert [r.event_date.day for r in spark.table(tables.valid).filter("event_id = 'm'").collect()] == [6]


def test_marts_can_wait(spark, bronze, expected):
    tables = lake(spark, "waits")
    refresh(spark, tables, bronze_rows=bronze(*FIRST))
    for rows in (MORE[:3], MORE[3:]):
        refresh_days(spark, tables, bronze(*rows), gold=False)
    assert spark.table(tables.health).agg(F.sum("raw_event_count")).first()[0] == len(FIRST)
    assert {d.day for d in refresh_marts(spark, tables)} == {2, 3, 4, 5, 6}
    assert contents(spark, tables) == expected and refresh_marts(spark, tables) == []


def test_a_stream_in_any_order_equals_one_pass(spark, bronze, expected, tmp_path):
    rows = [*FIRST, *MORE, *FIRST[:2]]
    random.Random(2).shuffle(rows)
    for batch in range(3):
        bronze(*rows[batch::3]).coalesce(1).write.json(f"{tmp_path}/in/{batch}")
    tables = lake(spark, "streamed")
    refresh(spark, tables, bronze_rows=bronze())
    for _ in range(2):  # started again, it has nothing new to take
        stream_into_lake(read_bronze_stream(spark, f"{tmp_path}/in", 1), tables, f"{tmp_path}/progress", available_now=True).awaitTermination()
    refresh_marts(spark, tables)
    found = contents(spark, tables)
    assert {k: found[k] for k in ("valid", "invalid", "promotion", "funnel")} == {k: expected[k] for k in ("valid", "invalid", "promotion", "funnel")}
    assert len(found["bronze"]) == len(rows)
    assert len(Ledger(spark, tables).at("reported")) == 3


def test_a_failing_batch_is_taken_again_by_the_stream(spark, bronze, tmp_path):
    bronze(at(1), at(2, event_id=None)).coalesce(1).write.json(f"{tmp_path}/in")
    tables = lake(spark, "restarted")
    refresh(spark, tables, bronze_rows=bronze())

    def run():
        stream_into_lake(read_bronze_stream(spark, f"{tmp_path}/in"), tables, f"{tmp_path}/progress", available_now=True).awaitTermination()

    with pytest.MonkeyPatch.context() as patch:
        Failing(patch, 6, after=True)  # Silver is written, nothing says so yet
        with pytest.raises(Exception, match="stopped"):
            run()
    run()
    assert (spark.table(tables.bronze).count(), spark.table(tables.valid).count(), spark.table(tables.invalid).count()) == (2, 1, 1)
