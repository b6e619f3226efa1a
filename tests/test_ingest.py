from __future__ import annotations

import json
from pathlib import Path

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from eventmill.operators import ingest
from eventmill.schemas import BRONZE, MESSAGE
from eventmill.sources import catalog, files
from eventmill.sources.topic import envelope_text
from eventmill.streaming.consume import Folders, consume
from eventmill.streaming.export import export_new_files

NOW = "2026-05-02T00:00:00Z"
EVENT = {"event_id": "e1", "event_type": "page_view", "z": 1.50, "a": None, "nested": {"q": [1, "é"]}}


def now():
    return F.lit(NOW).cast("timestamp")


def messages(spark, *values):
    rows = [("t", 3, offset, value) for offset, value in enumerate(values)]
    return spark.createDataFrame(rows, MESSAGE)


def opened(spark, *values):
    return ingest.normalise(messages(spark, *values), now())


def reasons(spark, *values):
    return [row.reason for row in opened(spark, *values).orderBy("offset").collect()]


def envelope(events, key="k", received="2026-04-30T10:00:00Z"):
    return json.dumps({"received_at": received, "sdk_key": key, "events": events})


def test_reasons_in_order(spark):
    assert reasons(
        spark, "not json", "[1]", "5", "null", envelope([EVENT], key=" "), '{"sdk_key":"k"}',
        envelope({"a": 1}), envelope("text"), envelope([]), envelope([5, "{x", None]), envelope([5, EVENT]),
        '{"sdk_key":" ","events":5}', '{"sdk_key":"k","sdk_key":"l","events":[{}]}',
    ) == [
        "invalid json", *["payload must be object"] * 3, "missing sdk_key",
        *["events must be a non-empty array"] * 4, "events array contains no valid event object", None,
        "missing sdk_key", None,
    ]


@pytest.mark.parametrize("value", [
    '{"sdk_key":"k","events":[{},]}', '{"sdk_key":"k","events":[{}]', "", "{}", "[]", '"text"', "true",
    '{"sdk_key":"k","events":[{}]}', '{"sdk_key":"k","events":[{"a":[{}]}]}', '{"sdk_key":7,"events":[{}]}',
])
def test_reason_is_what_a_strict_json_parser_gives(spark, value):
    def expected():
        try:
            payload = json.loads(value)
        except json.JSONDecodeError:
            return "invalid json"
        if not isinstance(payload, dict):
            return "payload must be object"
        return None if payload.get("sdk_key") else "missing sdk_key"

    assert reasons(spark, value) == [expected()]


def test_only_objects_are_exploded_and_keep_their_text(spark):
    rows = ingest.explode_events(opened(spark, envelope([5, EVENT, '{"fake":1}', {"event_id": 7}, None]))).collect()
    assert [json.loads(r.event) for r in rows] == [EVENT, {"event_id": 7}]
    assert rows[0].event.startswith('{"event_id":"e1","event_type"'), "key order is the sender's"


def test_bronze_rows_of_a_message(spark):
    rows = ingest.bronze_from_messages(ingest.explode_events(opened(spark, envelope([EVENT, {"event_id": 7}]))), 26)
    first, second = rows.collect()
    assert (first.event_id, first.session_id, second.event_id) == ("e1", None, "7")
    assert first.source_file == "kafka://t/partition=3/offset=0"
    assert first.export_batch_id == "kafka_bronze_20260502T000000Z_0000001a"
    assert first.ingestion_source == "kafka_consumer_direct" and first.loaded_at == first.exported_at


@pytest.mark.parametrize("received,day,kept", [
    ("2026-04-30T23:30:00+09:00", "2026-04-30", True), ("2026-04-30T00:30:00Z", "2026-04-30", True),
    ("yesterday", "2026-05-02", True), ("  ", "2026-05-02", False), (None, "2026-05-02", False),
    ("2026-99-30T00:00:00Z", "2026-05-02", True),
])
def test_partition_day_and_default_receipt_time(spark, received, day, kept):
    row = opened(spark, envelope([EVENT], received=received)).first()
    assert str(row.partition_date) == day
    assert row.received_at == (received if kept else "2026-05-02T00:00:00.000000Z")


def test_dead_letters_keep_the_payload(spark):
    row = ingest.dead_letters(opened(spark, "not json", envelope([EVENT]))).collect()
    assert [(r.reason, r.payload, r.partition, r.offset) for r in row] == [("invalid json", "not json", 3, 0)]


def test_admission(spark):
    rows = spark.createDataFrame(
        [("k", list(range(500))), ("k", list(range(501))), (" \t", [1]), ("k", []), ("k", None), (None, None)],
        "sdk_key string, events array<int>",
    )
    assert [r.rejection for r in ingest.admit(rows).collect()] == [
        None, "events must not exceed 500 items per request", "sdk_key is required",
        *["events must contain at least one item"] * 2, "sdk_key is required",
    ]


def test_envelope_leaves_out_missing_values(spark):
    rows = spark.sql("SELECT array(named_struct('event_id', 'e', 'user_id', CAST(NULL AS STRING))) AS events")
    text = rows.select(envelope_text(F.lit("now"), F.lit(" k "), F.col("events")).alias("t")).first().t
    assert json.loads(text) == {"received_at": "now", "sdk_key": "k", "events": [{"event_id": "e"}]}


def write(path, *lines):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join(lines) + "\n", encoding="utf-8")


def record(number):
    return json.dumps({"received_at": NOW, "sdk_key": "k", "event": {"event_id": f"e{number}"}})


def test_strict_export_names_file_and_line(spark, tmp_path):
    write(tmp_path / "raw_events/date=2026-04-30/events-0001.jsonl", record(1), "", '{"event":"{}"}')
    records = ingest.read_records(files.read_raw_lines(spark, str(tmp_path)))
    assert sorted(str(r.problem) for r in records.collect()) == ["None", "missing event object"]
    strict = ingest.bronze_from_records(ingest.strict(records), now())
    with pytest.raises(PySparkException, match="missing event object in raw_events/date=2026-04-30/events-0001.jsonl"):
        strict.collect()


def test_line_problems(spark):
    lines = spark.createDataFrame([("{broken", "f"), ("[1]", "f"), ('{"event":5}', "f"), (record(1), "f")], "line string, file_key string")
    assert [r.problem for r in ingest.read_records(lines).collect()] == [
        "invalid json", "invalid record type", "missing event object", None]


def test_new_files_only(spark, tmp_path):
    base, out, progress, rejects = (tmp_path / name for name in ("in", "out", "progress", "rejects"))

    def export():
        export_new_files(spark, str(base), str(out), str(progress), str(rejects)).awaitTermination()
        return files.read_bronze(spark, str(out), str(tmp_path / "absent"))

    write(base / "raw_events/date=2026-04-30/events-0001.jsonl", record(1), record(2), "", "{broken")
    write(base / "raw_events/date=2026-04-30/other.jsonl", record(9))
    assert export().count() == 2
    write(base / "raw_events_kafka/date=2026-05-01/events-0002.jsonl", record(3))
    rows = export()
    assert {(r.event_id, r.ingestion_source, r.source_file) for r in rows.collect()} == {
        ("e1", "direct_raw", "raw_events/date=2026-04-30/events-0001.jsonl"),
        ("e2", "direct_raw", "raw_events/date=2026-04-30/events-0001.jsonl"),
        ("e3", "kafka_consumer", "raw_events_kafka/date=2026-05-01/events-0002.jsonl"),
    }
    assert export().count() == 3
    assert spark.read.json(str(rejects)).select("problem", "line").collect()[0].line == "{broken"


def test_stream_equals_batch_and_a_repeated_batch_adds_nothing(spark, tmp_path):
    values = [envelope([EVENT, {"event_id": "e2"}]), "not json", envelope([]), envelope([{"event_id": "e3"}], received="2026-04-29T00:00:00Z")]
    messages(spark, *values).coalesce(1).write.parquet(str(tmp_path / "topic"))
    stream = spark.readStream.schema(MESSAGE).parquet(str(tmp_path / "topic"))
    folders = Folders(str(tmp_path / "dead"), raw=str(tmp_path / "raw"), bronze=str(tmp_path / "bronze"))
    batch = ingest.bronze_from_messages(ingest.explode_events(opened(spark, *values)))
    columns = ["event_id", "raw_event_json", "sdk_key", "received_at", "source_file"]

    def written():
        return sorted(files.read_bronze(spark, str(tmp_path / "absent"), folders.bronze).select(*columns).collect())

    def run(progress):
        consume(stream, folders, str(tmp_path / progress), available_now=True).awaitTermination()

    run("first")
    assert written() == sorted(batch.select(*columns).collect())
    assert spark.read.json(folders.dead_letters).count() == 2
    for commit in (tmp_path / "first/commits").iterdir():  # as if the run had failed after writing
        commit.unlink()
    run("first")
    assert written() == sorted(batch.select(*columns).collect())
    assert spark.read.json(folders.dead_letters).count() == 2
    raw = ingest.read_records(spark.read.text(folders.raw).select(F.col("value").alias("line"), F.lit("f").alias("file_key")))
    assert raw.filter("problem is null").count() == 3
    run("second")  # another run into the same folders leaves the first one's rows alone
    assert written() == sorted([*batch.select(*columns).collect()] * 2)
    assert spark.read.json(folders.dead_letters).count() == 4


def test_a_backlog_is_taken_in_bounded_batches(spark, tmp_path):
    for number in range(7):
        write(tmp_path / f"raw_events/date=2026-04-30/events-{number:04d}.jsonl", record(number))
    export_new_files(spark, str(tmp_path), str(tmp_path / "out"), str(tmp_path / "progress"), max_files=3).awaitTermination()
    assert len(list((tmp_path / "progress/commits").glob("[0-9]*"))) == 3
    assert files.read_bronze(spark, str(tmp_path / "out"), str(tmp_path / "none")).count() == 7
    days = list((tmp_path / "out").glob("date=*"))
    assert all(len(list(batch.glob("part-*"))) == 1 for day in days for batch in day.iterdir())


def test_topic_options_bound_each_batch():
    from eventmill.sources.topic import MAX_PER_TRIGGER, topic_options

    options = topic_options("host:1", "events.raw", "latest", MAX_PER_TRIGGER)
    assert options["maxOffsetsPerTrigger"] == "5000000" and options["subscribe"] == "events.raw"


def test_file_numbers_are_not_cut(spark):
    from eventmill.sources import derived

    numbers = spark.createDataFrame([(9_999_999,), (10_000_000,), (12_345_678,)], "event_id bigint").selectExpr(
        "event_id", "TIMESTAMP'2024-01-03 00:00:00' AS ts", "1 AS user_id", "'view' AS event_type", "1.0 AS value", "'{}' AS props")
    found = files.placed(files.with_key_parts(derived.raw_file_keys(numbers))).select("n", "seq", "file_key").collect()
    assert {r.n: r.seq for r in found} == {9_999_999: 9999, 10_000_000: 10000, 12_345_678: 12345}
    assert "events-10000.jsonl" in {r.n: r.file_key for r in found}[10_000_000]


def test_a_misplaced_file_is_a_failure(spark):
    found = files.with_key_parts(spark.createDataFrame([("raw_events/elsewhere/events-0001.jsonl",)], "file_key string"))
    with pytest.raises(Exception, match="misplaced raw file: raw_events/elsewhere"):
        files.placed(found).collect()


def test_the_manifest_needs_no_event_text(spark):
    from eventmill.plans import registry

    folder = Path("/root/testdata/sf0.001")
    if folder.exists():
        for name in ("file_manifest_pending", "delivery_pending"):
            assert "to_json" not in registry.queries()[name](spark, str(folder))._jdf.queryExecution().toString()


def test_stream_sinks_can_be_switched_off(spark, tmp_path):
    messages(spark, envelope([EVENT])).write.parquet(str(tmp_path / "topic"))
    stream = spark.readStream.schema(MESSAGE).parquet(str(tmp_path / "topic"))
    consume(stream, Folders(str(tmp_path / "dead"), bronze=str(tmp_path / "b")), str(tmp_path / "p"), available_now=True).awaitTermination()
    assert not (tmp_path / "raw").exists() and (tmp_path / "b").exists()


def test_file_list_and_pending(spark, tmp_path):
    for name in ("raw_events/date=2026-04-30/events-0001.jsonl", "raw_events/date=2026-04-30/events-0002.jsonl",
                 "raw_events_kafka/date=2026-04-30/events-0001.jsonl", "raw_events/misplaced/events-0003.jsonl"):
        write(tmp_path / name, record(1))
    roots = [str(tmp_path / root) for root in (*files.ROOT_TAGS, "absent")]
    found = files.list_raw_files(spark, roots)
    assert [r.file_key for r in files.misplaced(found).collect()] == ["raw_events/misplaced/events-0003.jsonl"]
    done = spark.createDataFrame(
        [("date=2026-04-30/events-0001.jsonl",), ("raw_events_kafka/date=2026-04-30/events-0001.jsonl",)], "file_key string")
    pending = files.pending_files(found.filter("day is not null"), done).collect()
    assert [(r.file_key, r.root, str(r.day), r.seq) for r in pending] == [
        ("raw_events/date=2026-04-30/events-0002.jsonl", "raw_events", "2026-04-30", 2)]


def test_pending_deliveries(spark):
    found = spark.createDataFrame([("direct", "a.jsonl"), ("direct", "b.jsonl"), ("kafka", "date=1/a.jsonl"), ("kafka", "date=1/b.jsonl")], "source string, path string")
    done = spark.createDataFrame([("a.jsonl",), ("data/bronze_batches_kafka/date=1/a.jsonl",), ("b2.jsonl",)], "file_key string")
    assert sorted(r.delivery_key for r in files.pending_deliveries(found, done).collect()) == [
        "data/bronze_batches_kafka/date=1/b.jsonl", "out/bronze_batches/b.jsonl"]


def test_bronze_drops_and_default_lineage(spark, tmp_path):
    write(tmp_path / "direct/x.jsonl", '{"event_id":"d","ingestion_source":null}', '{"event_id":5,"ingestion_source":"own"}')
    write(tmp_path / "stream/date=2026-04-30/bronze_events-0001.jsonl", '{"event_id":"s"}')
    rows = files.read_bronze(spark, str(tmp_path / "direct"), str(tmp_path / "stream"))
    assert rows.columns == BRONZE.names
    assert {(r.event_id, r.ingestion_source) for r in rows.collect()} == {
        ("d", "direct_raw"), ("5", "own"), ("s", "kafka_consumer_direct")}
    assert files.read_bronze(spark, str(tmp_path / "no"), str(tmp_path / "none")).count() == 0


def test_catalog_files(spark, tmp_path):
    header = "workspace_id,project_id,mall_name,product_id,product_name,category_id,category_name,unit_price,currency"
    write(tmp_path / "products.csv", header, "w,p,몰,prod_1,신발,c,신발,39900,KRW")
    row = catalog.read_products(spark, str(tmp_path / "products.csv")).first()
    assert (row.product_name, row.unit_price) == ("신발", 39900)
    header = "workspace_id,project_id,mall_name,campaign_id,campaign_name,promotion_id,promotion_name,placement,page_url,creative_id,creative_type,start_at,end_at,status"
    write(tmp_path / "promotions.csv", header, "w,p,몰,c,특가,p,배너,top,/,x,image,2026-04-01T00:00:00Z,2026-04-30T23:59:59Z,active")
    assert catalog.read_promotions(spark, str(tmp_path / "promotions.csv")).first().start_at.month == 4


def test_finished_batches_are_delivered_once(spark, tmp_path):
    from eventmill.streaming.deliver import deliver_new_files

    def deliver():
        for source in ("direct", "kafka"):
            deliver_new_files(spark, source, str(tmp_path / source), str(tmp_path / "drop" / source),
                              str(tmp_path / "progress" / source)).awaitTermination()
        rows = files.read_bronze(spark, str(tmp_path / "drop/direct"), str(tmp_path / "drop/kafka"))
        return sorted((r.event_id, r.ingestion_source) for r in rows.collect())

    write(tmp_path / "direct/bronze_events_1.jsonl", '{"event_id":"a"}')
    write(tmp_path / "kafka/date=2026-04-30/bronze_events-0001.jsonl", '{"event_id":"b"}', '{"event_id":"c"}')
    first = [("a", "direct_raw"), ("b", "kafka_consumer_direct"), ("c", "kafka_consumer_direct")]
    assert deliver() == first
    assert (tmp_path / "drop/kafka/date=2026-04-30").exists()
    write(tmp_path / "direct/bronze_events_2.jsonl", '{"event_id":"d"}')
    assert deliver() == [*first, ("d", "direct_raw")]
    assert deliver() == [*first, ("d", "direct_raw")]


def test_silver_from_the_stream_equals_silver_from_the_batch(spark, tmp_path):
    from eventmill.operators import silver

    event = {"event_id": "e", "event_type": "page_view", "event_time": "2026-04-30T10:00:00Z",
             "session_id": "s", "page_url": "/"}
    values = [
        envelope([{**event, "event_id": f"e{number % 7}", "session_id": f"s{number}", "page_url": "/" if number % 3 else ""}
                  for number in range(start, start + 5)])
        for start in range(0, 40, 5)
    ]
    messages(spark, *values).repartition(4).write.parquet(str(tmp_path / "topic"))
    stream = spark.readStream.schema(MESSAGE).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "topic"))
    folders = Folders(str(tmp_path / "dead"), bronze=str(tmp_path / "bronze"))
    consume(stream, folders, str(tmp_path / "progress"), available_now=True).awaitTermination()
    streamed = silver.survivors(files.read_bronze(spark, str(tmp_path / "absent"), folders.bronze))
    batch = silver.survivors(
        ingest.bronze_from_messages(ingest.explode_events(opened(spark, *values))).drop("date"))

    # Load times differ between micro-batches and may decide which copy is newest.
    def kept(rows):
        return sorted((r.event_id, r.error_code) for r in rows.collect())

    assert kept(streamed) == kept(batch) == [(f"e{number}", None) for number in range(7)]


def test_batches_are_filed_compressed_and_read_back(spark, tmp_path):
    from pyspark.sql import functions as F

    from eventmill.session import stored
    from eventmill.streaming.sinks import write_batch

    rows = spark.range(50).select(F.lit("2026-04-01").cast("date").alias("date"), F.format_string("line %d", "id").alias("value"))
    write_batch(rows, f"{tmp_path}/out", "b", "text")
    files = [p.name for p in (tmp_path / "out").rglob("part-*")]
    assert files and all(name.endswith(".gz") for name in files)
    assert {r.value for r in spark.read.text(f"{tmp_path}/out").collect()} == {f"line {n}" for n in range(50)}
    kept = stored(rows)
    assert kept.schema.simpleString() == rows.schema.simpleString() and sorted(kept.collect()) == sorted(rows.collect())
