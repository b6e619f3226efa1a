"""The best copy of each event by state, against the ranking in one pass."""

from __future__ import annotations

import random
import time

import pytest

from eventmill.operators import silver
from eventmill.streaming.best_copy import keep_best_copies, read_best_copies
from eventmill.streaming.lake import read_bronze_stream

SHOWN = ("event_id", "error_code", "loaded_at", "event_time", "source_file", "page_url")


def copies(seed):
    """Copies of few events that differ in what they are compared by; some without an id."""
    rng = random.Random(seed)
    rows = []
    for n in range(60):
        rows.append({
            "event_id": rng.choice(["a", "b", "c", "d", None, " "]), "page_url": rng.choice(["/x", "/y", ""]), "source_file": rng.choice(["f1", "f2", None]),
            "loaded_at": rng.choice(["2026-05-01T00:00:00Z", "2026-05-02T00:00:00Z", None]),
            "event_time": rng.choice(["2026-04-01T10:00:00Z", "2026-04-02T10:00:00Z", "bad"])})
    return rows


def shown(frame):
    return sorted(map(str, frame.select(*SHOWN).collect()))


@pytest.mark.parametrize("seed", [1, 2])
def test_any_order_equals_one_ranking(spark, bronze, tmp_path, seed):
    rows = copies(seed)
    for part in range(3):  # runs of one stream; state goes on between them
        bronze(*rows[part::3]).coalesce(1).write.mode("append").json(f"{tmp_path}/in")
        keep_best_copies(read_bronze_stream(spark, f"{tmp_path}/in"), f"{tmp_path}/out", f"{tmp_path}/state").awaitTermination()
    assert shown(read_best_copies(spark, f"{tmp_path}/out")) == shown(silver.survivors(bronze(*rows)))
    revisions = {r.event_id: r.n for r in spark.read.parquet(f"{tmp_path}/out").filter("trim(event_id) <> ''").groupBy("event_id").agg({"revision": "max"}).withColumnRenamed("max(revision)", "n").collect()}
    assert set(revisions) == {"a", "b", "c", "d"} and 1 <= max(revisions.values()) <= 3


def test_a_worse_copy_hands_nothing_on(spark, bronze, tmp_path):
    def run(**row):
        bronze({"event_id": "e", **row}).coalesce(1).write.mode("append").json(f"{tmp_path}/in")
        keep_best_copies(read_bronze_stream(spark, f"{tmp_path}/in"), f"{tmp_path}/out", f"{tmp_path}/state").awaitTermination()
        return sorted((r.revision, r.page_url) for r in spark.read.parquet(f"{tmp_path}/out").collect())

    assert run(page_url="/first", loaded_at="2026-05-02T00:00:00Z") == [(1, "/first")]
    assert run(page_url="/older", loaded_at="2026-05-01T00:00:00Z") == [(1, "/first")]
    assert run(page_url="", loaded_at="2026-05-09T00:00:00Z") == [(1, "/first")]  # newer, but invalid
    assert run(page_url="/newer", loaded_at="2026-05-03T00:00:00Z") == [(1, "/first"), (2, "/newer")]


def test_state_is_asked_once_for_each_id_of_a_part():
    from pyspark.sql import Row

    from eventmill.streaming.best_copy import MERITS, KeepBest

    class State(dict):
        asked = 0

        def getValue(self, key):
            self.asked += 1
            return self.get(key)

        updateValue = dict.__setitem__

    class Handle:
        getMapState = staticmethod(lambda *_: State())

    def copies(loaded):
        return [Row("event_id", *MERITS, "page")(f"e{n % 10}", 1, loaded + n, 0, 1, "f", n, f"/{loaded + n}") for n in range(100)]

    processor = KeepBest(None, ("page",))
    processor.init(Handle())
    first = list(processor.handleInputRows((0,), iter(copies(0)), None))
    assert {(r.page, r.revision) for r in first} == {(f"/{n}", 1) for n in range(90, 100)}
    assert processor.best.asked == 10
    assert list(processor.handleInputRows((0,), iter(copies(0)), None)) == []
    assert {r.revision for r in processor.handleInputRows((0,), iter(copies(5)), None)} == {2}


class Remembered(dict):
    """State variables of one part, as the processors use them."""

    asked, value = 0, None

    def getValue(self, key):
        self.asked += 1
        return dict.get(self, key)

    updateValue = dict.__setitem__

    def get(self):
        return self.value

    def update(self, value):
        self.value = value


class Handle:
    getMapState = getValueState = staticmethod(lambda *_: Remembered())


def paged(batches):
    """The processor by pages, and what it hands on of each batch: (event_id, page, revision); a batch is frames of (event_id, loaded, page)."""
    import pandas as pd

    from eventmill.streaming.best_copy import MERITS, KeepBestByPages

    processor = KeepBestByPages(("page",))
    processor.init(Handle())
    handed_on = []
    for batch in batches:
        frames = (pd.DataFrame([(n, 1, loaded, 0, 1, "f", 0, page) for n, loaded, page in rows], columns=["event_id", *MERITS, "page"]) for rows in batch)
        handed_on.append(sorted((r.page, r.revision) for frame in processor.handleInputRows((0,), frames, None) for r in frame.itertuples()))
    return processor, handed_on


def test_state_without_expiry_is_asked_once_for_each_page():
    def copies(ids, loaded):
        return [[(f"e{n}", loaded, f"/{n}/{loaded}") for n in part] for part in (ids[::2], ids[1::2])]

    few, many = range(100), range(5000)
    processor, handed_on = paged([copies(few, 5), copies(many, 4), copies(many, 4), copies(many, 6)])
    assert handed_on[0] == sorted((f"/{n}/5", 1) for n in few)
    assert handed_on[1] == sorted((f"/{n}/4", 1) for n in range(100, 5000))
    assert handed_on[2] == []
    assert handed_on[3] == sorted((f"/{n}/6", 2) for n in many)
    ids, pages = processor.size.value
    assert ids == 5000 and len(processor.pages) == pages == 32  # 16 of 512 would do; a batch of copies counts as new ids
    assert processor.pages.asked <= 1 + 4 * pages


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_paged_state_equals_a_plain_one(seed, monkeypatch):
    from eventmill.streaming import best_copy

    monkeypatch.setattr(best_copy, "PAGE", 4)
    rng, known, wanted, batches, serial = random.Random(seed), {}, [], [], 0
    for size in (3, 40, 1, 90):
        batch, best = [], {}
        for _ in range(3):
            rows = []
            for _ in range(size):
                serial += 1
                event_id, loaded = rng.choice(["", *(f"e{n}" for n in range(2 * size))]), rng.randrange(9)
                rows.append((event_id, loaded, f"/{serial}"))
                if event_id and loaded > best.get(event_id, (-1,))[0]:
                    best[event_id] = loaded, f"/{serial}"
            batch.append(rows)
        of_batch = [(page, 1) for rows in batch for event_id, _, page in rows if not event_id]
        for event_id, (loaded, page) in best.items():
            old, revision = known.get(event_id, (-1, 0))
            if loaded > old:
                known[event_id] = loaded, revision + 1
                of_batch.append((page, revision + 1))
        batches.append(batch)
        wanted.append(sorted(of_batch))
    processor, handed_on = paged(batches)
    assert handed_on == wanted and processor.size.value[0] == len(known)


def test_rows_without_an_id_go_on_beside_state_that_expires():
    from pyspark.sql import Row

    from eventmill.streaming.best_copy import MERITS, KeepBest

    processor = KeepBest(1000, ("page",))
    processor.init(Handle())
    rows = [Row("event_id", *MERITS, "page")(event_id, 1, n, 0, 1, "f", 0, f"/{n}") for n, event_id in enumerate(["", "e", "", "e"])]
    assert [(r.page, r.revision) for r in processor.handleInputRows((0,), iter(rows), None)] == [("/0", 1), ("/2", 1), ("/3", 1)]


def test_the_source_is_read_once(spark, bronze, tmp_path):
    rows = copies(3)
    bronze(*rows).coalesce(1).write.json(f"{tmp_path}/in")
    query = keep_best_copies(read_bronze_stream(spark, f"{tmp_path}/in"), f"{tmp_path}/out", f"{tmp_path}/state")
    query.awaitTermination()
    assert sum(progress.numInputRows for progress in query.recentProgress) == len(rows)


def test_state_expires(spark, bronze, tmp_path):
    def run(page):
        bronze({"event_id": "e", "page_url": page, "loaded_at": "2026-05-01T00:00:00Z" if page == "/late" else "2026-05-02T00:00:00Z"}).coalesce(1).write.mode("append").json(f"{tmp_path}/in")
        query = keep_best_copies(read_bronze_stream(spark, f"{tmp_path}/in"), f"{tmp_path}/out", f"{tmp_path}/state", expiry=1, every="1 second")
        for _ in range(300):
            if query.lastProgress and sum(p.numInputRows for p in query.recentProgress):
                break
            time.sleep(0.2)
        query.stop()

    run("/first")
    time.sleep(0.1)
    run("/late")  # worse, but nothing is remembered any more
    assert sorted((r.revision, r.page_url) for r in spark.read.parquet(f"{tmp_path}/out").collect()) == [(1, "/first"), (1, "/late")]
    assert [r.page_url for r in read_best_copies(spark, f"{tmp_path}/out").collect()] == ["/first"]
