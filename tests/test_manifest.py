"""The manifest of raw files: open days only."""

from __future__ import annotations

from datetime import date
from pathlib import Path

import pytest

from eventmill.plans.lake import Tables, create_databases
from eventmill.session import scratch_path
from eventmill.sources.manifest import Manifest


@pytest.fixture
def manifest(spark, request):
    tables = Tables(prefix=f"m{abs(hash(request.node.name)) % 10**6}_", root=scratch_path(spark, "lake"))
    create_databases(spark, tables)
    return Manifest(spark, f"{tables.prefix}bronze.raw_files")


def put(base, root, day, *numbers):
    folder = Path(base, root, f"date={day}")
    folder.mkdir(parents=True, exist_ok=True)
    for n in numbers:
        (folder / f"events-{n:04d}.jsonl").write_text("{}\n")


def keys(frame):
    return sorted(r.file_key for r in frame.collect())


def test_runs_take_each_file_once(spark, manifest, tmp_path):
    put(tmp_path, "raw_events", "2026-04-01", 1, 2)
    put(tmp_path, "raw_events_kafka", "2026-04-02", 1)
    found = manifest.pending(str(tmp_path), date(2026, 4, 3))
    assert keys(found) == ["raw_events/date=2026-04-01/events-0001.jsonl", "raw_events/date=2026-04-01/events-0002.jsonl", "raw_events_kafka/date=2026-04-02/events-0001.jsonl"]
    manifest.take(found)
    manifest.take(spark.createDataFrame(found.collect(), found.schema))  # a repeat
    assert keys(manifest.pending(str(tmp_path), date(2026, 4, 3))) == []
    put(tmp_path, "raw_events", "2026-04-01", 3)
    put(tmp_path, "raw_events", "2026-04-04", 1)  # not asked for yet
    assert keys(manifest.pending(str(tmp_path), date(2026, 4, 3))) == ["raw_events/date=2026-04-01/events-0003.jsonl"]


def test_closed_days_are_neither_listed_nor_kept(spark, manifest, tmp_path):
    for day in range(1, 9):
        put(tmp_path, "raw_events", f"2026-04-{day:02d}", 1, 2)
    manifest.take(manifest.pending(str(tmp_path), date(2026, 4, 8)))
    marks = {m.root: (m.files, m.last_seq) for m in manifest.close(date(2026, 4, 6))}
    assert marks == {"raw_events": (12, 2), "raw_events_kafka": (0, None)}
    assert {r.day for r in spark.table(manifest.taken).collect()} == {date(2026, 4, 7), date(2026, 4, 8)}
    put(tmp_path, "raw_events", "2026-04-03", 9)  # too late
    put(tmp_path, "raw_events", "2026-04-08", 3)
    put(tmp_path, "raw_events_kafka", "2026-04-07", 1)
    (tmp_path / "raw_events" / "date=2026-04-05" / "events-broken.jsonl").write_text("")  # would fail if it were listed
    assert keys(manifest.listed(str(tmp_path), date(2026, 4, 9))) == [
        "raw_events/date=2026-04-07/events-0001.jsonl", "raw_events/date=2026-04-07/events-0002.jsonl", "raw_events/date=2026-04-08/events-0001.jsonl",
        "raw_events/date=2026-04-08/events-0002.jsonl", "raw_events/date=2026-04-08/events-0003.jsonl", "raw_events_kafka/date=2026-04-07/events-0001.jsonl"]
    assert keys(manifest.pending(str(tmp_path), date(2026, 4, 9))) == ["raw_events/date=2026-04-08/events-0003.jsonl", "raw_events_kafka/date=2026-04-07/events-0001.jsonl"]
    assert keys(manifest.pending(str(tmp_path), date(2026, 4, 6))) == []


def test_nothing_there(manifest, tmp_path):
    assert keys(manifest.pending(str(tmp_path), date(2026, 4, 9))) == []
    manifest.close(date(2026, 4, 1))
    assert keys(manifest.pending(str(tmp_path), date(2026, 4, 9))) == []
