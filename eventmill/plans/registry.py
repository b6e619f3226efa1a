"""Named queries over the driver tables: (spark, folder) to DataFrame.

All of them start from the whole `events` table, through the derivations of sources.derived.
Results are handed out with dates and times as text and decimals as doubles.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ..functions.device import browser_name, device_type, os_name
from ..functions.text import has_text, is_blank
from ..operators import census, funnel, health, ingest, lineage, promotion, serve, sessions, silver
from ..session import checkpointed, prepare, scratch_path, stored
from ..schemas import MESSAGE
from ..sources import derived, files
from ..sources.manifest import Manifest
from ..streaming.best_copy import keep_best_copies, read_best_copies
from ..streaming.consume import Folders, consume
from ..streaming.deliver import deliver_new_files
from ..streaming.export import export_new_files
from ..streaming.sinks import MAX_FILES_PER_BATCH
from ..streaming.lake import read_bronze_stream, stream_into_lake
from . import audit
from .layers import write_gold
from .refresh import Tables, create_databases, drop_lake, refresh, refresh_days

Query = Callable[[SparkSession, str], DataFrame]

# The moment taken for "now" where a result would otherwise depend on the clock.
LOAD_TIME = "2024-02-02T00:00:00Z"
SERVED_KEY = " shop_1 "
# How queries file raw and Bronze lines. A compressed file is read by one task, so none may be large.
FILED = {"compression": "gzip", "maxRecordsPerFile": 250_000}

_queries: dict[str, Query] = {}


def _query(function: Callable[[DataFrame], DataFrame]) -> Callable[[DataFrame], DataFrame]:
    """Register a function of the `events` table under its own name."""
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return serve.serialised(function(derived.read_events(prepare(spark), folder)))

    _queries[function.__name__] = run
    return function


def queries() -> dict[str, Query]:
    return dict(_queries)


def _load_time():
    return F.lit(LOAD_TIME).cast("timestamp")


def _survivors(events: DataFrame) -> DataFrame:
    return silver.survivors(derived.bronze_rows(events))


def _valid(events: DataFrame) -> DataFrame:
    return silver.valid_events(_survivors(events))


def _rollup(events: DataFrame) -> DataFrame:
    return promotion.promotion_rollup(_valid(events))


def _health_mart(events: DataFrame) -> DataFrame:
    bronze = derived.bronze_rows(events)
    return health.workspace_health(bronze, silver.survivors(bronze))


def _promotion_mart(events: DataFrame) -> DataFrame:
    return promotion.promotion_performance(_rollup(events))


def _funnel_mart(events: DataFrame) -> DataFrame:
    return funnel.funnel_of(checkpointed(funnel.campaign_events(_valid(events))))


#: What the streams' results are compared by.
_SURVIVOR = (
    "sdk_key", "event_id", "event_type", "session_id", "page_url", "ingestion_source", "source_file", "loaded_at", "error_code",
)


def _new_lake(spark: SparkSession) -> Tables:
    root = scratch_path(spark, "lake")
    return Tables(prefix=f"lake_{root[-8:]}_", root=root)


def _taken_from(tables: Tables, rows: DataFrame) -> DataFrame:
    """Rows of a lake of its own, stored apart before the lake goes."""
    found = checkpointed(rows)
    drop_lake(rows.sparkSession, tables)
    return found


# Bronze


@_query
def bronze_union_lineage(events: DataFrame) -> DataFrame:
    """Both drops as one table; a row that brings no lineage tag gets its drop's tag."""
    rows = derived.bronze_rows(events)
    direct = F.col("ingestion_source") == "direct_raw"
    untagged = F.when(~F.col("source_file").endswith("3"), F.col("ingestion_source"))
    drops = (
        files.with_lineage(rows.filter(keep).withColumn("ingestion_source", untagged), tag)
        for keep, tag in ((direct, files.DIRECT_TAG), (~direct, files.STREAM_TAG))
    )
    return reduce(DataFrame.unionByName, drops).drop("raw_event_json")


@_query
def bronze_source_census(events: DataFrame) -> DataFrame:
    return census.by_source(derived.bronze_rows(events))


@_query
def offset_audit(events: DataFrame) -> DataFrame:
    """Topic offsets that no Bronze row speaks of, and messages that two batches took in; some are replayed here."""
    replay = derived.bronze_rows(events.filter("event_id % 100 = 3")).withColumn("export_batch_id", F.lit("kafka_bronze_replay"))
    return lineage.offset_audit(checkpointed(lineage.offsets(derived.bronze_rows(events).union(replay))), block=1000)


@_query
def bronze_row_count(events: DataFrame) -> DataFrame:
    return census.row_count(derived.bronze_rows(events))


# Ingest


@_query
def envelope_admission(events: DataFrame) -> DataFrame:
    admitted = ingest.admit(derived.requests(events))
    return admitted.select("r", F.coalesce(F.size("events"), F.lit(0)).alias("event_count"), "rejection")


@_query
def envelope_normalise_reasons(events: DataFrame) -> DataFrame:
    opened = ingest.normalise(derived.messages(events), _load_time())
    return opened.select(
        "offset", "reason", "partition_date",
        F.when(F.col("reason").isNull(), F.col("received_at")).alias("received_at"),
        F.when(F.col("reason").isNull(), F.col("sdk_key")).alias("sdk_key"),
        F.when(F.col("reason").isNull(), F.size("events")).alias("event_count"),
    )


@_query
def envelope_explode_bronze(events: DataFrame) -> DataFrame:
    opened = ingest.normalise(derived.messages(events), _load_time())
    rows = ingest.bronze_from_messages(ingest.explode_events(opened))
    return rows.withColumns({
        name: F.get_json_object("raw_event_json", f"$.{name}")
        for name in ("promotion_id", "product_id", "device_type", "unit_price")
    }).drop("raw_event_json")


@_query
def envelope_dead_letters(events: DataFrame) -> DataFrame:
    letters = ingest.dead_letters(ingest.normalise(derived.messages(events), _load_time()))
    return letters.drop("payload")


@_query
def partition_date_census(events: DataFrame) -> DataFrame:
    opened = ingest.normalise(derived.messages(events), _load_time())
    return census.by_partition_day(ingest.raw_lines(ingest.explode_events(opened)))


@_query
def strict_parse_check(events: DataFrame) -> DataFrame:
    """Raw lines by file and problem; a strict export fails at the first problem."""
    records = ingest.read_records(derived.raw_lines(events).filter(has_text(F.trim("line"))))
    return records.groupBy("file_key", "problem").agg(F.count("*").alias("cnt"))


@_query
def raw_file_bronze(events: DataFrame) -> DataFrame:
    """Bronze rows of the usable raw lines."""
    records = ingest.read_records(derived.raw_lines(events).filter(has_text(F.trim("line"))))
    rows = ingest.bronze_from_records(records.filter("problem is null"), _load_time())
    return rows.drop("raw_event_json")


@_query
def file_manifest_pending(events: DataFrame) -> DataFrame:
    """Raw files not yet exported; some were recorded under keys without a root."""
    found = files.placed(files.with_key_parts(derived.raw_file_keys(events).select("file_key").distinct()))
    key, day = F.col("file_key"), F.col("day")
    recorded = F.when(day <= "2024-01-05", F.replace(key, F.lit("raw_events/"), F.lit(""))).otherwise(key)
    processed = found.filter(day <= "2024-01-10").select(recorded.alias("file_key"))
    return files.pending_files(found, processed)


@_query
def manifest_runs(events: DataFrame) -> DataFrame:
    """Raw files taken in two runs by a manifest, with days closed in between: files by run, root and day."""
    spark = events.sparkSession
    tables, base = _new_lake(spark), scratch_path(spark, "manifest")
    create_databases(spark, tables)
    manifest = Manifest(spark, f"{tables.prefix}bronze.raw_files")
    lines = files.with_key_parts(derived.raw_lines(events))
    taken = []
    for run, (since, until) in enumerate(((date(2000, 1, 1), date(2024, 1, 10)), (date(2024, 1, 10), date(2024, 12, 31)))):
        for root in files.ROOT_TAGS:
            new = lines.filter((F.col("root") == root) & (F.col("day") > F.lit(since)) & (F.col("day") <= F.lit(until)))
            new.select("line", F.col("day").alias("date")).write.mode("append").options(**FILED).partitionBy("date").text(f"{base}/{root}")
        found = checkpointed(manifest.pending(base, until))
        manifest.take(found)
        manifest.close(min(until, date(2024, 1, 8)))
        taken.append(found.select(F.lit(run).alias("run"), "root", "day").distinct())
    return _taken_from(tables, reduce(DataFrame.unionByName, taken))


@_query
def delivery_pending(events: DataFrame) -> DataFrame:
    """Bronze batch files not yet delivered."""
    raw = files.placed(files.with_key_parts(derived.raw_file_keys(events).select("file_key").distinct()))
    direct = F.col("root") == "raw_events"
    found = raw.select(
        "day",
        F.when(direct, "direct").otherwise("kafka").alias("source"),
        F.when(direct, F.format_string("bronze_events_%s_%04d.jsonl", F.col("day").cast("string"), "seq"))
        .otherwise(F.format_string("date=%s/bronze_events-%04d.jsonl", F.col("day").cast("string"), "seq"))
        .alias("path"),
    )
    prefix = F.when(F.col("source") == "direct", "out/bronze_batches/").otherwise("data/bronze_batches_kafka/")
    done = F.when(F.col("day") <= "2024-01-05", F.col("path")).otherwise(F.concat(prefix, "path"))
    delivered = found.filter(F.col("day") <= "2024-01-10").select(done.alias("file_key"))
    return files.pending_deliveries(found.drop("day"), delivered)


@_query
def file_stream_bronze(events: DataFrame) -> DataFrame:
    """Raw files written, exported by the file stream, and read back from the Bronze drop."""
    spark = events.sparkSession
    base = scratch_path(spark, "export")
    lines = files.with_key_parts(derived.raw_lines(events))
    for root in files.ROOT_TAGS:
        of_root = lines.filter(F.col("root") == root).select("line", F.col("day").alias("date"))
        of_root.write.options(**FILED).partitionBy("date").text(f"{base}/raw/{root}")
    export_new_files(
        spark, f"{base}/raw", f"{base}/bronze", f"{base}/progress", rejects=f"{base}/rejects"
    ).awaitTermination()
    exported = files.read_bronze(spark, f"{base}/bronze", f"{base}/none")
    return exported.groupBy("ingestion_source", F.split_part("source_file", F.lit("/"), F.lit(2)).alias("folder")).agg(
        F.count("*").alias("cnt"), F.count("event_id").alias("with_event_id")
    )


@_query
def raw_file_listing(events: DataFrame) -> DataFrame:
    """Raw files written, then listed: the roots and days that hold any; a misplaced file would fail."""
    spark = events.sparkSession
    base = scratch_path(spark, "listing")
    lines = files.with_key_parts(derived.raw_lines(events)).select("line", F.col("day").alias("date"), "root")
    for root in files.ROOT_TAGS:
        lines.filter(F.col("root") == root).drop("root").write.options(**FILED).partitionBy("date").text(f"{base}/{root}")
    found = files.placed(files.list_raw_files(spark, [f"{base}/{root}" for root in (*files.ROOT_TAGS, "absent")]))
    return found.filter("file_key is not null").select("root", "day").distinct()


@_query
def delivery_run_bronze(events: DataFrame) -> DataFrame:
    """Finished batch files of both sources delivered into the two drops, and read from there."""
    spark = events.sparkSession
    base = scratch_path(spark, "delivery")
    rows = derived.bronze_rows(events)
    direct = F.col("ingestion_source") == "direct_raw"
    rows.filter(direct).write.options(**FILED).json(f"{base}/direct")
    rows.filter(~direct).withColumn("date", F.substring("exported_at", 1, 10)).write.options(**FILED).partitionBy("date").json(f"{base}/kafka")
    for source in ("direct", "kafka"):
        deliver_new_files(
            spark, source, f"{base}/{source}", f"{base}/drop/{source}", f"{base}/progress/{source}").awaitTermination()
    return census.by_source(files.read_bronze(spark, f"{base}/drop/direct", f"{base}/drop/kafka"))


@_query
def serve_stored_health(events: DataFrame) -> DataFrame:
    """One workspace's list from the stored mart of a refreshed lake; only its newest days are read."""
    spark = events.sparkSession
    tables = refresh(spark, _new_lake(spark), bronze_rows=derived.bronze_rows(events))
    recent = spark.table(tables.health).filter("event_date >= DATE'2024-01-20'")
    return _taken_from(tables, serve.health_rows(recent, SERVED_KEY))


@_query
def topic_stream_bronze(events: DataFrame) -> DataFrame:
    """Messages consumed as a stream into all three sinks, counted per sink and day or reason."""
    spark = events.sparkSession
    base = scratch_path(spark, "consume")
    derived.messages(events).write.parquet(f"{base}/topic")
    stream = spark.readStream.schema(MESSAGE).option("maxFilesPerTrigger", MAX_FILES_PER_BATCH).parquet(f"{base}/topic")
    folders = Folders(f"{base}/dead", raw=f"{base}/raw", bronze=f"{base}/bronze")
    consume(stream, folders, f"{base}/progress", available_now=True, loaded_at=_load_time()).awaitTermination()
    raw = spark.read.text(f"{base}/raw").select(F.lit("raw").alias("sink"), F.col("date").cast("string").alias("key"))
    bronze = spark.read.schema("date string, event_id string").json(f"{base}/bronze").select(F.lit("bronze"), "date")
    dead = spark.read.schema("reason string").json(f"{base}/dead").select(F.lit("dead_letters"), "reason")
    return raw.union(bronze).union(dead).groupBy("sink", "key").agg(F.count("*").alias("cnt"))


# Silver


@_query
def silver_parsed(events: DataFrame) -> DataFrame:
    return silver.parse(derived.bronze_rows(events)).drop("raw_event_json", "row_fingerprint")


@_query
def error_code_census(events: DataFrame) -> DataFrame:
    return census.by_source_and_error(silver.classify(silver.parse(derived.bronze_rows(events))))


@_query
def all_errors_census(events: DataFrame) -> DataFrame:
    return census.by_message(silver.parse(derived.bronze_rows(events)))


@_query
def silver_valid(events: DataFrame) -> DataFrame:
    return _valid(events).drop("raw_event_json", "validated_at")


@_query
def silver_invalid(events: DataFrame) -> DataFrame:
    return silver.invalid_events(_survivors(events)).drop("raw_event_json", "detected_at")


@_query
def silver_one_pass_equiv(events: DataFrame) -> DataFrame:
    """Survivors of the single pass against those of one ranking per table, row by row."""
    # Read four times: stored, and only what the rankings and the comparison need of it.
    classified = checkpointed(silver.classify(silver.parse(derived.bronze_rows(events))).select(
        "event_id", "error_code", "loaded_at", "event_time", "source_file", "row_fingerprint"
    ))
    newest = [F.col(name).desc_nulls_last() for name in ("loaded_at", "event_time", "source_file", "row_fingerprint")]
    by_event = Window.partitionBy("event_id")

    def first(rows: DataFrame, *order) -> DataFrame:
        return rows.withColumn("at", F.row_number().over(by_event.orderBy(*order))).filter("at = 1").drop("at")

    keyed = classified.filter(has_text(F.col("event_id")))
    valid = first(keyed.filter("error_code is null"), *newest)
    invalid = first(keyed, F.col("error_code").isNotNull(), *newest).filter("error_code is not null")
    unkeyed = classified.filter(is_blank(F.col("event_id")) & F.col("error_code").isNotNull())
    columns = ("event_id", "error_code", "loaded_at", "event_time", "source_file")

    def counted(rows: DataFrame, one: int, two: int) -> DataFrame:
        return rows.select(*columns, F.lit(one).alias("one"), F.lit(two).alias("two"))

    both = reduce(DataFrame.unionByName, [
        counted(silver.first_per_event(classified), 1, 0),
        *(counted(rows, 0, 1) for rows in (valid, invalid, unkeyed)),
    ])
    per_row = both.groupBy(*columns).agg(F.sum("one").alias("one"), F.sum("two").alias("two"))
    outcome = F.when(F.col("error_code").isNull(), "valid").otherwise("invalid").alias("outcome")
    return per_row.groupBy(outcome).agg(
        F.sum("one").alias("one_pass_rows"),
        F.sum("two").alias("two_pass_rows"),
        F.count_if(F.col("one") != F.col("two")).alias("differences"),
    )


@_query
def silver_valid_source_census(events: DataFrame) -> DataFrame:
    return census.by_source(_valid(events))


@_query
def silver_invalid_error_census(events: DataFrame) -> DataFrame:
    return census.by_source_and_error(silver.invalid_events(_survivors(events)))


# Gold


@_query
def health_raw_agg(events: DataFrame) -> DataFrame:
    return health.raw_counts(derived.bronze_rows(events))


@_query
def health_valid_sessions(events: DataFrame) -> DataFrame:
    return health.valid_counts(health.event_counts(_survivors(events)))


@_query
def sessions_over_days(events: DataFrame) -> DataFrame:
    """Distinct sessions of all days from stored daily sketches, against the exact count: within two percent of it."""
    valid = checkpointed(_valid(events).select("event_date", "sdk_key", "session_id"))
    daily = checkpointed(sessions.session_sketches(valid))
    counted = sessions.session_counts(sessions.merged(daily, "sdk_key")).withColumnRenamed("sessions", "estimate")
    exact = valid.groupBy("sdk_key").agg(F.count_distinct("session_id").alias("exact_sessions"))
    close = F.abs(F.col("estimate") - F.col("exact_sessions")) <= 0.02 * F.col("exact_sessions")
    return exact.join(counted, "sdk_key").select("sdk_key", "exact_sessions", "events", close.alias("within_two_percent"))


@_query
def health_invalid_agg(events: DataFrame) -> DataFrame:
    return health.invalid_counts(health.event_counts(_survivors(events)))


@_query
def health_key_spine(events: DataFrame) -> DataFrame:
    bronze = derived.bronze_rows(events)
    return health.key_spine(health.raw_counts(bronze), health.event_counts(silver.survivors(bronze)))


@_query
def workspace_health(events: DataFrame) -> DataFrame:
    return _health_mart(events).drop("last_updated_at")


@_query
def promotion_agg(events: DataFrame) -> DataFrame:
    return promotion.promotion_counts(promotion.promotion_rollup(_valid(events)))


@_query
def post_click_agg(events: DataFrame) -> DataFrame:
    return promotion.after_click_counts(promotion.promotion_rollup(_valid(events)))


@_query
def promotion_key_spine(events: DataFrame) -> DataFrame:
    return promotion.key_spine(promotion.promotion_rollup(_valid(events)))


@_query
def promotion_performance(events: DataFrame) -> DataFrame:
    return _promotion_mart(events).drop("last_updated_at")


@_query
def promotion_performance_by_name(events: DataFrame) -> DataFrame:
    return promotion.promotion_performance(_rollup(events), match_names=True).drop("last_updated_at")


@_query
def promotion_performance_by_ids(events: DataFrame) -> DataFrame:
    """The report with m x m rows for m name variants; the roll-up, of a mart's size, is stored first."""
    stored = checkpointed(_rollup(events))
    return promotion.promotion_performance(stored, match_names=False).drop("last_updated_at")


@_query
def campaign_name_map(events: DataFrame) -> DataFrame:
    return funnel.campaign_names(funnel.campaign_events(_valid(events)))


@_query
def session_flags(events: DataFrame) -> DataFrame:
    return funnel.session_flags(funnel.campaign_events(_valid(events)))


@_query
def campaign_funnel(events: DataFrame) -> DataFrame:
    return _funnel_mart(events).drop("last_updated_at")


# Serving


@_query
def serve_health(events: DataFrame) -> DataFrame:
    return serve.health_rows(_health_mart(events), limit=serve.PAGE)


@_query
def serve_health_by_key(events: DataFrame) -> DataFrame:
    return serve.health_rows(_health_mart(events), SERVED_KEY)


@_query
def serve_promotion(events: DataFrame) -> DataFrame:
    return serve.promotion_rows(_promotion_mart(events), limit=serve.PAGE)


@_query
def serve_promotion_by_key(events: DataFrame) -> DataFrame:
    return serve.promotion_rows(_promotion_mart(events), SERVED_KEY)


@_query
def serve_funnel(events: DataFrame) -> DataFrame:
    return serve.funnel_rows(_funnel_mart(events), limit=serve.PAGE)


@_query
def serve_funnel_by_key(events: DataFrame) -> DataFrame:
    return serve.funnel_rows(_funnel_mart(events), SERVED_KEY)


@_query
def dashboard_health(events: DataFrame) -> DataFrame:
    return serve.dashboard_health(_health_mart(events), SERVED_KEY)


@_query
def dashboard_promotion(events: DataFrame) -> DataFrame:
    return serve.dashboard_promotion(_promotion_mart(events), SERVED_KEY)


@_query
def dashboard_funnel(events: DataFrame) -> DataFrame:
    return serve.dashboard_funnel(_funnel_mart(events), SERVED_KEY)


@_query
def health_latest_day(events: DataFrame) -> DataFrame:
    return serve.latest_day(serve.health_rows(_health_mart(events)))


@_query
def top_invalid(events: DataFrame) -> DataFrame:
    return serve.top_invalid(serve.health_rows(_health_mart(events)))


@_query
def top_ctr(events: DataFrame) -> DataFrame:
    return serve.top_ctr(serve.promotion_rows(_promotion_mart(events)), 10)


@_query
def top_funnel(events: DataFrame) -> DataFrame:
    return serve.top_funnel(serve.funnel_rows(_funnel_mart(events)), 20)


@_query
def health_totals(events: DataFrame) -> DataFrame:
    return serve.health_totals(serve.health_rows(_health_mart(events)))


@_query
def workspace_keys(events: DataFrame) -> DataFrame:
    return serve.workspace_keys(serve.health_rows(_health_mart(events)))


@_query
def rate_tiers_report(events: DataFrame) -> DataFrame:
    counts = ["promotion_view_sessions", "promotion_click_sessions"]
    badges = serve.rate_badges(serve.funnel_rows(_funnel_mart(events)), "view_to_click_rate", counts)
    return badges.select(
        "event_date", "sdk_key", "campaign_id", "rate_text", "rate_tier", *(f"{name}_text" for name in counts)
    )


@_query
def contract_violations(events: DataFrame) -> DataFrame:
    """Marts' rows that the serving contract would reject, as found per list; from one Silver pass."""
    bronze = derived.bronze_rows(events)
    stored = checkpointed(silver.survivors(bronze).drop("raw_event_json"))
    kept = stored.withColumn("raw_event_json", F.lit(None).cast("string"))  # no mart reads it
    valid = silver.valid_events(kept)
    lists = serve.dashboard(
        health.workspace_health(bronze, kept),
        promotion.promotion_performance(promotion.promotion_rollup(valid)),
        funnel.campaign_funnel(valid),
    )
    found = (
        serve.contract_violations(rows, serve.NULLABLE[name]).agg(
            F.lit(name).alias("list_name"), F.count("*").alias("violations")
        )
        for name, rows in lists.items()
    )
    return reduce(DataFrame.union, found)


@_query
def verify_health_order(events: DataFrame) -> DataFrame:
    return serve.by_day_and(_health_mart(events).drop("last_updated_at"), "raw_event_count")


@_query
def verify_promotion_order(events: DataFrame) -> DataFrame:
    return serve.by_day_and(_promotion_mart(events).drop("last_updated_at"), "promotion_views")


@_query
def verify_funnel_order(events: DataFrame) -> DataFrame:
    return serve.by_day_and(_funnel_mart(events).drop("last_updated_at"), "promotion_view_sessions")


@_query
def ua_enrichment(events: DataFrame) -> DataFrame:
    agent = F.col("user_agent")
    return derived.user_agents(events).select(
        "event_id", device_type(agent).alias("device_type"),
        os_name(agent).alias("os_name"), browser_name(agent).alias("browser_name"),
    )


@_query
def refresh_roundtrip(events: DataFrame) -> DataFrame:
    """A full refresh into tables of their own, and how many rows each table holds."""
    spark = events.sparkSession
    tables = refresh(spark, _new_lake(spark), bronze_rows=derived.bronze_rows(events))
    names = ("bronze", "valid", "invalid", "health", "promotion", "funnel")
    counts = [(name, spark.table(getattr(tables, name)).count()) for name in names]
    drop_lake(spark, tables)
    return spark.createDataFrame(counts, "table_name string, cnt bigint")


@_query
def refresh_days_repeated(events: DataFrame) -> DataFrame:
    """Seven tenths of the events refreshed, the rest taken in as increments, each handed in twice: the health mart."""
    spark = events.sparkSession
    tables = _new_lake(spark)
    tenth = F.col("event_id") % 10
    parts = [derived.bronze_rows(events.filter(of)) for of in (tenth < 7, tenth.between(7, 8), tenth > 8)]
    refresh(spark, tables, bronze_rows=parts[0])
    for part in parts[1:]:
        for _ in range(2):
            refresh_days(spark, tables, part)
    return _taken_from(tables, spark.table(tables.health).drop("last_updated_at"))


@_query
def silver_stream(events: DataFrame) -> DataFrame:
    """Bronze files streamed into the lake in three runs, copies of an event in different ones: both Silver tables."""
    spark = events.sparkSession
    tables, base = _new_lake(spark), scratch_path(spark, "arrivals")
    refresh(spark, tables, bronze_rows=derived.bronze_rows(events.filter("false")), layers=("bronze", "silver"))
    for run in range(3):
        derived.bronze_rows(events.filter(F.col("event_id") % 3 == run)).write.mode("append").options(**FILED).json(f"{base}/in")
        stream_into_lake(
            read_bronze_stream(spark, f"{base}/in"), tables, f"{base}/progress", available_now=True).awaitTermination()
    valid = spark.table(tables.valid).withColumn("error_code", F.lit(None).cast("string"))
    found = stored(valid.select(*_SURVIVOR).union(spark.table(tables.invalid).select(*_SURVIVOR)))
    drop_lake(spark, tables)
    return found


@_query
def best_copy_stream(events: DataFrame) -> DataFrame:
    """Bronze files streamed in three runs through the state that keeps each event's best copy: all survivors."""
    spark, base = events.sparkSession, scratch_path(events.sparkSession, "copies")
    for run in range(3):
        derived.bronze_rows(events.filter(F.col("event_id") % 3 == run)).write.mode("append").options(**FILED).json(f"{base}/in")
        keep_best_copies(read_bronze_stream(spark, f"{base}/in"), f"{base}/out", f"{base}/state").awaitTermination()
    return read_best_copies(spark, f"{base}/out").select(*_SURVIVOR)


@_query
def refresh_observed_counts(events: DataFrame) -> DataFrame:
    """Rows by layer, source and error code, as counted while a refresh wrote them."""
    spark = events.sparkSession
    tables = refresh(spark, _new_lake(spark), bronze_rows=derived.bronze_rows(events), layers=("bronze", "silver"))
    layers = (audit.observed(spark, tables, name).withColumn("layer", F.lit(name)) for name in ("bronze", "silver"))
    return _taken_from(tables, reduce(DataFrame.unionByName, layers))


@_query
def audit_findings(events: DataFrame) -> DataFrame:
    """What the audit has against mart versions that are written but not shown."""
    spark = events.sparkSession
    tables = refresh(spark, _new_lake(spark), bronze_rows=derived.bronze_rows(events), layers=("bronze", "silver"))
    return _taken_from(tables, audit.findings(spark, tables, write_gold(spark, tables)))
