"""Every registered query against its SQL statement, and the refresh job."""

from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__ as contract  # noqa: E402
from eventmill.operators import silver  # noqa: E402
from eventmill.plans import oracle, registry  # noqa: E402
from eventmill.plans.refresh import Tables, current_version, refresh, refresh_days  # noqa: E402
from eventmill.schemas import SILVER_INVALID, SILVER_VALID, WORKSPACE_HEALTH  # noqa: E402
from eventmill.session import scratch_path, shared_folder  # noqa: E402

TESTDATA = Path("/root/testdata/sf0.001")
needs_data = pytest.mark.skipif(not TESTDATA.exists(), reason="driver tables are absent")


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    connection = duckdb.connect()
    for table in TESTDATA.glob("*.parquet"):
        connection.execute(f"CREATE VIEW {table.stem} AS SELECT * FROM '{table}'")
    return connection


def plain(value):
    return round(value, 9) if isinstance(value, float) else value


@needs_data
@pytest.mark.parametrize("name", sorted(oracle.oracle_sql()))
def test_query_equals_its_sql(spark, duck, name):
    found = contract.queries()[name](spark, str(TESTDATA))
    columns = sorted(found.columns)
    expected = duck.execute(contract.oracle_sql()[name])
    names = [column[0] for column in expected.description]
    assert sorted(names) == columns
    places = [names.index(column) for column in columns]
    wanted = sorted(str(tuple(plain(row[at]) for at in places)) for row in expected.fetchall())
    assert sorted(str(tuple(plain(row[column]) for column in columns)) for row in found.collect()) == wanted


@needs_data
def test_entry_has_rows(spark):
    assert contract.entry(spark).count() > 0


def test_every_query_of_this_part_has_a_statement():
    assert set(registry.queries()) == set(oracle.oracle_sql())


def test_refresh_twice_gives_the_same_tables(spark, bronze):
    rows = bronze({}, {"event_id": "e2", "page_url": ""}, {"event_id": None})
    tables = Tables(prefix="twice_", root=scratch_path(spark, "lake"))
    for _ in range(2):
        refresh(spark, tables, bronze_rows=rows)
        assert spark.table(tables.valid).count() == 1
        assert spark.table(tables.invalid).count() == 2
        assert spark.table(tables.health).first().raw_event_count == 3
    assert [f.dataType for f in spark.table(tables.valid).schema] == [f.dataType for f in SILVER_VALID]
    assert spark.table(tables.invalid).columns == SILVER_INVALID.names
    assert spark.table(tables.health).columns == WORKSPACE_HEALTH.names


def test_refresh_can_rebuild_one_layer(spark, bronze):
    tables = Tables(prefix="layer_", root=scratch_path(spark, "lake"))
    refresh(spark, tables, bronze_rows=bronze({}), layers=("bronze", "silver"))
    assert not spark.catalog.tableExists(tables.health)
    refresh(spark, tables, layers=("gold",))
    assert spark.table(tables.health).count() == 1


def test_marts_do_not_read_the_payload(spark, bronze):
    from eventmill.operators import funnel, health, promotion

    tables = Tables(prefix="pruned_", root=scratch_path(spark, "lake"))
    refresh(spark, tables, bronze_rows=bronze({}), layers=("bronze", "silver"))
    valid, kept = spark.table(tables.valid), spark.table(tables.survivors)
    for mart in (funnel.campaign_funnel(valid), promotion.promotion_rollup(valid),
                 health.workspace_health(spark.table(tables.bronze), kept)):
        plan = mart._jdf.queryExecution().executedPlan().toString()
        assert "raw_event_json" not in plan


def test_one_survivor_scan_serves_both_silver_tables(spark, bronze):
    rows = bronze({}, {"event_id": "e2", "page_url": ""})
    kept = silver.survivors(rows)
    assert silver.valid_events(kept).count() + silver.invalid_events(kept).count() == kept.count() == 2


def test_shared_folder_is_the_named_one(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    assert scratch_path(spark, "x") != scratch_path(spark, "x")


def test_shuffles_start_from_what_the_caller_names():
    from eventmill.session import build_session

    session = build_session("tests", partitions=77)
    key = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    assert session.conf.get(key) == "77"
    session.conf.unset(key)


def _files(spark, table, day):
    version = spark.table(current_version(spark, table))
    found = version.select("_metadata.file_path", day).distinct().collect()
    return {(str(r[1]), r[0]) for r in found}


def test_refresh_by_days_touches_no_other_day(spark, bronze):
    def at(day, **row):
        return {"event_time": f"2026-04-{day:02d}T10:00:00Z", "event_id": f"e{day}", **row}

    tables = Tables(prefix="days_", root=scratch_path(spark, "lake"))
    first = [at(1), at(2), at(3), at(3, event_id="x", page_url=""), at(4, event_id="late", loaded_at="2026-04-04T00:00:00Z")]
    refresh(spark, tables, bronze_rows=bronze(*first))
    before = {t: _files(spark, t, d) for t, d in ((tables.survivors, "booked_day"), (tables.health, "event_date"))}
    # A newer copy of e2 on its own day, one of "late" on another day, a valid copy of x, a new event.
    more = [at(2, loaded_at="2026-05-02T00:00:00Z", session_id="s9"), at(5, event_id="late", loaded_at="2026-05-02T00:00:00Z"),
            at(3, event_id="x"), at(6)]
    days = refresh_days(spark, tables, bronze(*more))
    assert {d.day for d in days} == {2, 3, 4, 5, 6}
    after = {t: _files(spark, t, d) for t, d in ((tables.survivors, "booked_day"), (tables.health, "event_date"))}
    for table in before:
        assert {f for f in before[table] if f[0] == "2026-04-01"} == {f for f in after[table] if f[0] == "2026-04-01"}
        assert not {f for f in before[table] if f[0] == "2026-04-02"} & after[table]
    whole = Tables(prefix="whole_", root=scratch_path(spark, "lake"))
    refresh(spark, whole, bronze_rows=bronze(*first, *more))
    for one, other, stamp in ((tables.valid, whole.valid, "validated_at"), (tables.invalid, whole.invalid, "detected_at"),
                              (tables.health, whole.health, "last_updated_at"), (tables.funnel, whole.funnel, "last_updated_at"),
                              (tables.promotion, whole.promotion, "last_updated_at")):
        rows = [sorted(map(str, spark.table(t).drop(stamp).collect())) for t in (one, other)]
        assert rows[0] == rows[1], one
    assert {r.event_date.day for r in spark.table(tables.valid).filter("event_id = 'late'").collect()} == {5}
    refresh_days(spark, tables, bronze(*more))  # handed in again
    assert spark.table(tables.valid).count() == spark.table(whole.valid).count()


def test_a_day_that_loses_its_last_event_goes(spark, bronze):
    tables = Tables(prefix="gone_", root=scratch_path(spark, "lake"))
    row = {"event_time": "2026-04-01T10:00:00Z", "event_id": "e", "loaded_at": "2026-04-02T00:00:00Z"}
    refresh(spark, tables, bronze_rows=bronze(row, {"event_time": "2026-04-09T10:00:00Z", "event_id": "f"}))
    refresh_days(spark, tables, bronze({**row, "event_time": "2026-04-05T10:00:00Z", "loaded_at": "2026-04-06T00:00:00Z"}))
    assert sorted(r.event_date.day for r in spark.table(tables.valid).collect()) == [5, 9]
    assert sorted((r.event_date.day, r.raw_event_count, r.valid_event_count) for r in spark.table(tables.health).collect()) == [
        (1, 1, 0), (5, 1, 1), (9, 1, 1)]


def test_a_failed_refresh_leaves_the_old_table(spark, bronze):
    from pyspark.sql import functions as F

    tables = Tables(prefix="fails_", root=scratch_path(spark, "lake"))
    refresh(spark, tables, bronze_rows=bronze({}))
    broken = bronze({}, {"event_id": "e2"}).withColumn(
        "page_url", F.when(F.col("event_id") == "e2", F.raise_error(F.lit("stop"))).otherwise(F.col("page_url")))
    for attempt in (refresh, refresh_days):
        with pytest.raises(Exception, match="stop"):
            attempt(spark, tables, bronze_rows=broken) if attempt is refresh else attempt(spark, tables, broken)
        assert spark.table(tables.bronze).count() == spark.table(tables.valid).count() == 1
    refresh(spark, tables, bronze_rows=bronze({}, {"event_id": "e2"}))
    assert spark.table(tables.valid).count() == spark.table(tables.health).first().valid_event_count == 2


def test_stored_lists_read_only_the_days_asked_for(spark, bronze):
    from eventmill.operators import serve

    tables = Tables(prefix="pruning_", root=scratch_path(spark, "lake"))
    refresh(spark, tables, bronze_rows=bronze(*({"event_id": f"e{d}", "event_time": f"2026-04-{d:02d}T10:00:00Z"} for d in range(1, 6))))
    recent = serve.health_rows(spark.table(tables.health).filter("event_date >= DATE'2026-04-04'"), "k1")
    plan = recent._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan and recent.count() == 2


def test_queries_leave_no_database_behind(spark, tmp_path):
    from pyspark.sql import functions as F

    spark.range(300).select(
        F.col("id").alias("event_id"), F.expr("timestamp'2024-01-03 10:00:00' + make_dt_interval(0, 0, 0, id)").alias("ts"),
        (F.col("id") % 9).alias("user_id"), F.element_at(F.array(*map(F.lit, ("view", "click", "signup", "error", "purchase"))),
        (F.col("id") % 5 + 1).cast("int")).alias("event_type"), F.lit(1.5).alias("value"), F.lit('{"k": 3}').alias("props"),
    ).write.parquet(f"{tmp_path}/events.parquet")
    before = {d.name for d in spark.catalog.listDatabases()}
    found = registry.queries()["refresh_roundtrip"](spark, str(tmp_path)).collect()
    assert {r.table_name: r.cnt for r in found}["bronze"] == 300
    assert {d.name for d in spark.catalog.listDatabases()} == before
