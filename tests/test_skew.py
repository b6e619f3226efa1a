"""Hot groups: results against plain Python, and how many rows reach the shuffle."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from eventmill.operators import health, silver

ROWS, TASKS = 3000, 6


def _rows(kind):
    rows = []
    for number in range(ROWS):
        hot = number % 3 == 0
        rows.append({
            "event_id": {"copies": "hot", "unkeyed": None}.get(kind, f"e{number}") if hot else f"e{number}",
            "sdk_key": "hot" if hot and kind == "workspace" else f"k{number % 5}",
            "session_id": "hot" if hot and kind == "workspace" else f"s{number % 50}",
            "loaded_at": f"2026-05-01T{number % 24:02d}:00:00Z",
            "source_file": f"f{number:05d}",
            "page_url": "" if number % 7 == 0 else "/",
        })
    return rows


def _survivors(rows):
    """Best copy per event id by plain Python; rows without an id all stay."""
    best, unkeyed = {}, 0
    for row in rows:
        if row["event_id"] is None:
            unkeyed += 1
            continue
        rank = (row["page_url"] != "", row["loaded_at"], row["source_file"])
        if row["event_id"] not in best or rank > best[row["event_id"]]:
            best[row["event_id"]] = rank
    return sorted((key, rank[2]) for key, rank in best.items()), unkeyed


@pytest.mark.parametrize("kind", ["copies", "unkeyed", "workspace"])
def test_hot_group_results(bronze, kind):
    rows = _rows(kind)
    kept = silver.survivors(bronze(*rows)).persist()
    expected, unkeyed = _survivors(rows)
    found = kept.filter("event_id is not null").select("event_id", "source_file").collect()
    assert sorted((r.event_id, r.source_file) for r in found) == expected
    assert kept.filter("event_id is null").count() == unkeyed
    counts = health.workspace_health(bronze(*rows), kept).agg(
        F.sum("raw_event_count").alias("raw"), F.sum("distinct_sessions").alias("sessions")
    ).first()
    valid = {(r.sdk_key, r.session_id) for r in kept.filter("error_code is null").collect()}
    assert (counts.raw, counts.sessions) == (ROWS, len(valid))
    kept.unpersist()


def _shuffled_rows(df):
    """Rows written to the last shuffle of a plan, and rows of its result."""
    kept = len(df.collect())
    node = df._jdf.queryExecution().executedPlan()
    while "ShuffleExchange" not in (name := node.getClass().getSimpleName()):
        if name == "AdaptiveSparkPlanExec":
            node = node.executedPlan()
        elif name.endswith("QueryStageExec"):
            node = node.plan()
        else:
            node = node.children().apply(0)
    return node.metrics().apply("shuffleRecordsWritten").value(), kept


@pytest.mark.parametrize("kind,most", [("copies", ROWS * 2 // 3 + TASKS), ("unkeyed", ROWS)])
def test_copies_of_a_hot_id_do_not_reach_the_shuffle(spark, bronze, tmp_path, kind, most):
    bronze(*_rows(kind)).repartition(TASKS).write.parquet(str(tmp_path / "bronze"))
    stored = spark.read.option("pathGlobFilter", "*.parquet").parquet(str(tmp_path / "bronze"))
    written, kept = _shuffled_rows(silver.survivors(stored))
    assert kept <= written <= most
