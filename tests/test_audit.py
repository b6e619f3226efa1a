"""Counts observed while writing, the audit before publishing, the topic's offsets, session sketches."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from eventmill.operators import census, health, lineage, promotion, sessions, silver
from eventmill.plans import audit, layers
from eventmill.plans.audit import AuditFailed
from eventmill.plans.lake import Tables, current_version, named_like
from eventmill.plans.refresh import refresh
from eventmill.session import scratch_path


def lake(spark, name):
    return Tables(prefix=f"{name}_", root=scratch_path(spark, "lake"))


ROWS = [
    {}, {"event_id": "e2", "page_url": ""}, {"event_id": "e3", "ingestion_source": "kafka_consumer"}, {"event_id": "e3"},
    {"event_id": "e4", "ingestion_source": "elsewhere"}, {"event_id": None, "ingestion_source": None}]


def test_observed_counts_are_the_censuses(spark, bronze):
    tables = lake(spark, "observed")
    rows = bronze(*ROWS)
    refresh(spark, tables, bronze_rows=rows, layers=("bronze", "silver"))
    named = F.when(F.col("ingestion_source").isin(*audit.SOURCES), F.col("ingestion_source")).otherwise(audit.OTHER)
    kept = silver.survivors(rows).withColumn("ingestion_source", named)
    expected = {(r.ingestion_source, r.error_code, r.cnt) for r in census.by_source_and_error(kept).collect()}
    assert {tuple(r) for r in audit.observed(spark, tables, "silver").collect()} == expected
    assert {(r.ingestion_source, r.cnt) for r in audit.observed(spark, tables, "bronze").collect()} == {
        ("direct_raw", 3), ("kafka_consumer", 1), (audit.OTHER, 1), ("unknown", 1)}
    refresh(spark, tables, bronze_rows=bronze({}), layers=("bronze", "silver"))  # of the current version only
    assert [r.cnt for r in audit.observed(spark, tables, "silver").collect()] == [1]


def test_a_mart_with_a_finding_never_shows(spark, bronze, monkeypatch):
    tables = lake(spark, "audited")
    refresh(spark, tables, bronze_rows=bronze({}, {"event_id": "e2"}), audited=True)
    shown = {name: current_version(spark, getattr(tables, name)) for name in layers.MARTS}
    wrong = {"contract_promotion": ("promotion", lambda f: f.withColumn("campaign_id", F.lit(None).cast("string"))),
             "reconciled_valid": ("health", lambda f: f.withColumn("valid_event_count", F.col("valid_event_count") + 1))}
    promo = {"event_type": "promotion_view", "payload": {"promotion_id": "p", "promotion_name": "P", "campaign_id": "c", "placement": "top"}}
    for check, (name, change) in wrong.items():
        mart, layout = layers.MARTS[name]
        monkeypatch.setitem(layers.MARTS, name, (lambda *a, mart=mart, change=change: change(mart(*a)), layout))
        with pytest.raises(AuditFailed, match=f"{check}: 1"):
            refresh(spark, tables, bronze_rows=bronze({}, {"event_id": "e2"}, {"event_id": "e3", **promo}), audited=True)
        monkeypatch.undo()
        assert {n: current_version(spark, getattr(tables, n)) for n in layers.MARTS} == shown
        assert spark.table(tables.health).first().valid_event_count == 2
        assert all(len(named_like(spark, getattr(tables, n), "__v")) == 1 for n in layers.MARTS)


def test_an_allowed_finding_does_not_stop_a_mart(spark, bronze):
    tables = lake(spark, "allowed")
    rows = bronze({"event_time": "bad", "received_at": "bad"}, {"event_id": "e2"})  # a health row without a day
    with pytest.raises(AuditFailed, match="contract_health: 1"):
        refresh(spark, tables, bronze_rows=rows, audited=True)
    assert not spark.catalog.tableExists(tables.health)
    refresh(spark, tables, bronze_rows=rows, audited=True, allowed=("contract_health",))
    assert spark.table(tables.health).count() == 2


def at(offset, partition=0, batch="b1", topic="t"):
    return {"source_file": f"kafka://{topic}/partition={partition}/offset={offset}", "export_batch_id": batch}


@pytest.mark.parametrize("block", [2, 7, 1_000_000])
def test_missing_and_replayed_offsets(spark, bronze, block):
    rows = bronze(
        *(at(o) for o in (3, 4, 4, 7, 8, 20)), at(8, batch="b2"), at(8, batch="b3"), at(5, partition=1), at(100, topic="u"), at(102, topic="u"),
        {"source_file": "raw_events/date=2026-04-01/events-0001.jsonl"}, {"source_file": None})
    dead = spark.createDataFrame([("t", 0, 6), ("t", 1, 6)], "topic string, partition int, offset long")
    found = lineage.offset_audit(lineage.offsets(rows, dead), block).collect()
    assert {(r.finding, r.topic, r.partition, r.first_offset, r.last_offset, r.messages, r.batches) for r in found} == {
        ("missing", "t", 0, 5, 5, 1, 0), ("missing", "t", 0, 9, 19, 11, 0), ("missing", "u", 0, 101, 101, 1, 0),
        ("replayed", "t", 0, 8, 8, 1, 3)}


def test_sketches_count_over_days_and_merge(spark):
    days = [F.lit(f"2026-04-0{d}").cast("date") for d in (1, 2, 3)]
    rows = spark.range(60_000).select(
        F.array(*days)[(F.col("id") % 3).cast("int")].alias("event_date"), F.format_string(" k%d", F.col("id") % 2).alias("sdk_key"),
        F.format_string("s%d", F.col("id") % 20_000).alias("session_id"))  # each session is on all three days
    rows = rows.union(rows.limit(1).select("event_date", F.lit(" "), "session_id"))
    daily = sessions.session_sketches(rows)
    assert daily.count() == 6
    per_key = {r.sdk_key: r for r in sessions.session_counts(sessions.merged(daily, "sdk_key")).collect()}
    assert set(per_key) == {"k0", "k1"} and all(r.events == 30_000 for r in per_key.values())
    assert all(abs(r.sessions - 10_000) <= 200 for r in per_key.values())
    one, two = daily.filter("sdk_key = 'k0'"), daily.filter("sdk_key = 'k1'")
    whole = sessions.session_counts(sessions.merged(one.union(two))).first()
    assert abs(whole.sessions - 20_000) <= 400 and whole.events == 60_000


def test_merged_sketches_of_many_sessions_stay_well_within_two_percent(spark):
    rows = spark.range(1_800_000).select(
        F.date_add(F.lit("2026-04-01").cast("date"), (F.col("id") / 60 % 3).cast("int")).alias("event_date"),
        F.format_string("k%d", F.col("id") % 60).alias("sdk_key"), F.format_string("s%d", "id").alias("session_id"))
    found = sessions.session_counts(sessions.merged(sessions.session_sketches(rows), "sdk_key")).collect()
    assert len(found) == 60 and max(abs(r.sessions - 30_000) for r in found) <= 300


def test_few_sessions_are_counted_exactly(spark, bronze):
    rows = bronze(*({"event_id": f"e{i}", "session_id": f"s{i % 7}"} for i in range(30)))
    valid = silver.valid_events(silver.survivors(rows))
    assert [r.sessions for r in sessions.session_counts(sessions.session_sketches(valid)).collect()] == [7]
    assert health.event_counts(silver.survivors(rows)).first().distinct_sessions == 7
    assert promotion.promotion_rollup(valid).count() == 0
