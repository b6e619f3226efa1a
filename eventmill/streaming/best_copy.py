"""The best copy of each event on a stream, kept by state: a better copy that comes later replaces an earlier one.

Copies are compared as `operators.silver.ranked` does: valid before invalid, then newest load, newest event time,
last source. The state of an event id is what its best copy is compared by, not the copy: some hundred bytes. A
copy that beats it is handed on with a revision number one higher, so a reader keeps the highest revision of
each id, and that is what one ranking over all rows so far gives, in whatever order they came. A stream that
drops duplicates would keep the first copy instead.

State grows with the ids seen. `expiry` lets an id's state go when no better copy came for that long; a copy
that comes later still starts over at revision one, so choose it beyond the longest delay of a copy. Spark lets
go what is stored under a key of its own, so with an expiry each id is one; that costs two calls, near a millisecond.
Without, some hundred ids share a key and its calls.
"""

from __future__ import annotations

import json
import sys
import zlib
from collections import defaultdict
from collections.abc import Iterator
from typing import Any

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Row, SparkSession, Window, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from ..functions.text import has_text
from ..operators import silver
from ..schemas import BRONZE
from .sinks import batch_name

# Spark's workers for state may not find this package: what they run is sent to them whole.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_LEAST = -(1 << 63)
#: Parts that event ids are dealt into by hash. It is kept by the state: a checkpoint goes with its number.
PARTS = 1024
#: Ids that a page of state holds at most, on the average of a part.
PAGE = 512
#: What copies are compared by, the larger the better.
MERITS = ("is_valid", "loaded", "happened", "has_source", "source", "fingerprint")
_MERITS_SCHEMA = "is_valid int, loaded long, happened long, has_source int, source string, fingerprint long, revision long"


def _merits() -> dict[str, Column]:
    return dict(zip(MERITS, (
        F.col("error_code").isNull().cast("int"),
        F.coalesce(F.unix_micros("loaded_at"), F.lit(_LEAST)),
        F.coalesce(F.unix_micros("event_time"), F.lit(_LEAST)),
        F.col("source_file").isNotNull().cast("int"),
        F.coalesce("source_file", F.lit("")),
        F.col("row_fingerprint"),
    )))


class KeepBest(StatefulProcessor):
    """Hands on the best of the copies of each id that came together, if it beats all that came before.

    A group is a part of the ids: what is best is found while its rows stream by, and the state is asked once for
    each id, not for each copy. Rows without an id are handed on as they come.
    """

    def __init__(self, expiry: int | None, columns: tuple[str, ...]):
        self.expiry, self.columns = expiry, columns

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.best = handle.getMapState("best", "event_id string", _MERITS_SCHEMA, self.expiry)

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        best: dict[str, tuple[tuple, tuple]] = {}
        handed_on = Row(*self.columns, "revision")
        for row in rows:
            event_id, copy = row["event_id"], tuple(row[name] for name in self.columns)
            if not event_id:
                yield handed_on(*copy, 1)
                continue
            merits = tuple(row[name] for name in MERITS)
            rival = best.get(event_id)
            if rival is None or merits > rival[0]:
                best[event_id] = merits, copy
        for event_id, (merits, copy) in best.items():
            known = self.best.getValue((event_id,))
            if known is not None and merits <= tuple(known)[: len(MERITS)]:
                continue
            revision = known[-1] + 1 if known is not None else 1
            self.best.updateValue((event_id,), (*merits, revision))
            yield handed_on(*copy, revision)

    def close(self) -> None:
        pass


class KeepBestByPages(StatefulProcessor):
    """The same by state that never expires: a part's ids are dealt into pages, and the state is asked once for each page.

    A page is the JSON text of what its ids' best copies are compared by. A part that outgrows its pages gets twice
    as many, so a page stays small however many ids there are. Rows come in frames: reading a row so costs about a sixth
    of what reading it singly does.
    """

    def __init__(self, columns: tuple[str, ...]):
        self.columns = columns

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.size = handle.getValueState("size", "ids long, pages long")
        self.pages = handle.getMapState("pages", "page long", "best string")

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        best: dict[str, tuple] = {}
        leading = []  # of each frame, the rows that beat all before them
        for frame in rows:
            places, without_id = {}, []
            for place, (event_id, *merits) in enumerate(zip(*(frame[name].tolist() for name in ("event_id", *MERITS)))):
                if not event_id:
                    without_id.append(place)
                elif event_id not in best or tuple(merits) > best[event_id]:
                    best[event_id], places[event_id] = tuple(merits), place
            leading.append(frame.iloc[list(places.values())][["event_id", *self.columns]])
            if without_id:
                yield frame.iloc[without_id][[*self.columns]].assign(revision=1)
        revisions = self._revise(best)
        if revisions:
            copies = pd.concat(leading).drop_duplicates("event_id", keep="last").set_index("event_id")
            yield copies.loc[list(revisions), [*self.columns]].assign(revision=list(revisions.values()))

    def _revise(self, best: dict[str, tuple]) -> dict[str, int]:
        """The ids whose merits beat those in the state, which takes them over, with their new revisions."""
        ids, pages = self.size.get() or (0, 1)
        wanted = pages
        while wanted * PAGE < ids + len(best):
            wanted *= 2
        if ids and wanted > pages:
            self._deal_out(pages, wanted)
        touched: dict[int, list[str]] = defaultdict(list)
        for event_id in best:
            touched[_page(event_id, wanted)].append(event_id)
        revisions, added = {}, 0
        for page, event_ids in touched.items():
            known = self._read(page) if ids else {}
            before, had = len(known), len(revisions)
            for event_id in event_ids:
                *merits, revision = known.get(event_id, (0,))
                if not merits or best[event_id] > tuple(merits):
                    known[event_id] = (*best[event_id], revision + 1)
                    revisions[event_id] = revision + 1
            if len(revisions) > had:
                self._write(page, known)
            added += len(known) - before
        if added or wanted > pages:
            self.size.update((ids + added, wanted))
        return revisions

    def _deal_out(self, pages: int, wanted: int) -> None:
        """From `pages` to `wanted`, a multiple: ids of a page only go to those that have its number but for a multiple."""
        for page in range(pages):
            dealt: dict[int, dict] = {number: {} for number in range(page, wanted, pages)}
            for event_id, known in self._read(page).items():
                dealt[_page(event_id, wanted)][event_id] = known
            for number, known in dealt.items():
                self._write(number, known)

    def _read(self, page: int) -> dict[str, list]:
        stored = self.pages.getValue((page,))
        return json.loads(stored[0]) if stored else {}

    def _write(self, page: int, known: dict) -> None:
        self.pages.updateValue((page,), (json.dumps(known, separators=(",", ":")),))

    def close(self) -> None:
        pass


def _page(event_id: str, pages: int) -> int:
    return zlib.crc32(event_id.encode()) % pages


def best_copies(bronze: DataFrame, expiry: int | None = None) -> DataFrame:
    """A stream of Bronze rows to Silver rows with a revision: the best copies so far, each when it becomes the best.

    Rows without an event id can't be copies of each other: all go on, at revision one. They are dealt out evenly, and
    go the same way as the others, so that the source is read once. `expiry`: milliseconds.

    Bronze rows, a third as wide as Silver ones, go through the state and are parsed again after it: in Python
    each column of a row costs more than its parse. For that a row's columns go as one array.
    """
    bronze.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", PROVIDER)
    classified = silver.classify(silver.parse(bronze, (f"array({', '.join(BRONZE.names)}) AS copy",)))
    known = has_text(F.trim("event_id"))
    part = F.when(known, F.pmod(F.xxhash64("event_id"), F.lit(PARTS))).otherwise(F.rand(0) * PARTS).cast("int").alias("part")
    event_id = F.when(known, F.col("event_id")).otherwise("").alias("event_id")
    keyed = classified.withColumns(_merits()).select(part, event_id, *MERITS, "copy").groupBy("part")
    schema = "copy array<string>, revision long"
    if expiry:
        best = keyed.transformWithState(KeepBest(expiry, ("copy",)), schema, "update", "ProcessingTime")
    else:
        best = keyed.transformWithStateInPandas(KeepBestByPages(("copy",)), schema, "update", "None")
    best = best.select(*(F.col("copy")[n].alias(name) for n, name in enumerate(BRONZE.names)), "revision")
    return silver.classify(silver.parse(best, ("revision",)))


def keep_best_copies(
    bronze: DataFrame, folder: str, checkpoint: str, expiry: int | None = None, every: str = "1 minute",
) -> StreamingQuery:
    """Write what `best_copies` hands on below `folder`, a part for each micro-batch that a repeat overwrites.

    It stops when it has taken what is there; with an expiry it goes on until it is stopped, since time alone
    may then end a state.
    """
    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{folder}/batch={batch_name(batch, number)}")

    trigger = {"processingTime": every} if expiry else {"availableNow": True}
    stream = best_copies(bronze, expiry).writeStream.outputMode("update").foreachBatch(write)
    return stream.option("checkpointLocation", checkpoint).trigger(**trigger).start()


def read_best_copies(spark: SparkSession, folder: str) -> DataFrame:
    """The last revision of each event id, and all rows without one."""
    rows = spark.read.parquet(folder).drop("batch")
    own = F.when(~has_text(F.trim(F.coalesce("event_id", F.lit("")))), F.monotonically_increasing_id())
    last = Window.partitionBy("event_id", "own").orderBy(F.col("revision").desc(), *(F.desc(name) for name in MERITS))
    ranked = rows.withColumns(_merits()).withColumn("own", own).withColumn("place", F.row_number().over(last))
    return ranked.filter("place = 1").drop("place", "own", "revision", *MERITS)
