"""Messages and raw lines to raw records, Bronze rows and dead letters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions.text import is_blank, stripped
from ..functions.times import partition_day
from ..schemas import BRONZE, RAW_LINE, conform
from ..sources.files import STREAM_TAG, lineage_tag

# Reasons for turning a request, a message or a raw line away.
NO_KEY, NO_EVENTS = "sdk_key is required", "events must contain at least one item"
TOO_MANY = "events must not exceed {limit} items per request"
INVALID_JSON, NOT_AN_OBJECT = "invalid json", "payload must be object"
MISSING_KEY, EVENTS_NOT_A_LIST = "missing sdk_key", "events must be a non-empty array"
NO_EVENT_OBJECT = "events array contains no valid event object"
LINE_INVALID_JSON, LINE_NOT_AN_OBJECT = "invalid json", "invalid record type"
LINE_WITHOUT_EVENT = "missing event object"
DEFAULT_MAX_EVENTS = 500

_LIFTED = T.StructType([
    T.StructField(name, T.StringType())
    for name in ("event_id", "event_type", "event_time", "session_id", "page_url")
])


def _is_object(value: Column | str, path: str = "$") -> Column:
    """Whether a variant holds an object at `path`: only an object can be read as a struct."""
    return F.try_variant_get(value, path, "struct<>").isNotNull()


def _length(array: str) -> Column:
    return F.coalesce(F.size(array), F.lit(-1))


def _stamp(moment: str) -> Column:
    return F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")


def admit(requests: DataFrame, max_events: int = DEFAULT_MAX_EVENTS) -> DataFrame:
    """Add `rejection` to requests (sdk_key, events array): NULL if admitted, else the reason."""
    size = _length("events")
    return requests.withColumn(
        "rejection",
        F.when(is_blank(stripped(F.col("sdk_key"))), NO_KEY)
        .when(size < 1, NO_EVENTS)
        .when(size > max_events, TOO_MANY.format(limit=max_events)),
    )


def normalise(messages: DataFrame, loaded_at: Column) -> DataFrame:
    """Read each message's envelope; `reason` says why a message cannot be used.

    Kinds of values are told apart on the parsed variant: the text of a string element may well
    look like an object. The events themselves are kept as the text they came in, so their key
    order survives.
    """
    opened = messages.withColumns({
        "loaded_at": loaded_at,
        "envelope": F.try_parse_json("value"),
        "texts": F.from_json("value", "events array<string>")["events"],
    }).withColumns({
        "elements": F.try_variant_get("envelope", "$.events", "array<variant>"),
        "texts": F.coalesce("texts", F.array().cast("array<string>")),
        "sdk_key": stripped(F.try_variant_get("envelope", "$.sdk_key", "string")),
        "received_at": stripped(F.try_variant_get("envelope", "$.received_at", "string")),
    })
    # Paired up outside the lambdas: an expression inside one is evaluated per element.
    pairs = F.filter(F.arrays_zip("elements", "texts"), lambda pair: _is_object(pair["elements"]))
    events = F.transform(pairs, lambda pair: F.coalesce(pair["texts"], F.to_json(pair["elements"])))
    reason = (
        F.when(F.col("envelope").isNull(), INVALID_JSON)
        .when(~_is_object("envelope"), NOT_AN_OBJECT)
        .when(is_blank(F.col("sdk_key")), MISSING_KEY)
        .when(_length("elements") < 1, EVENTS_NOT_A_LIST)
        .when(_length("events") < 1, NO_EVENT_OBJECT)
    )
    return (
        opened.withColumn("events", events)
        .withColumns({
            "reason": reason,
            "partition_date": partition_day(F.col("received_at"), F.col("loaded_at")),
            "received_at": F.when(is_blank(F.col("received_at")), _stamp("loaded_at"))
            .otherwise(F.col("received_at")),
        })
        .drop("envelope", "elements", "texts")
    )


def explode_events(normalised: DataFrame) -> DataFrame:
    """One row per event object of the usable messages; elements of other kinds are dropped.

    Unusable messages explode to a NULL row that is filtered out afterwards. A filter on
    `reason`, or the one Spark derives for a plain explode, would be moved ahead of the
    envelope parsing and repeat it.
    """
    usable = F.when(F.col("reason").isNull(), F.col("events"))
    return (
        normalised.withColumn("event", F.explode_outer(usable))
        .filter("event is not null")
        .drop("events", "reason", "value")
    )


def raw_lines(exploded: DataFrame) -> DataFrame:
    """Raw JSON lines to store, the event text put in as it is, filed by day as `date`."""
    head = F.to_json(F.struct("received_at", "sdk_key"))
    return exploded.select(
        F.concat(F.rtrim(head, F.lit("}")), F.lit(',"event":'), "event", F.lit("}")).alias("line"),
        F.col("partition_date").alias("date"),
    )


def _with_lifted(events: DataFrame) -> DataFrame:
    """Add the event fields Bronze carries as columns, from one parse of the event text."""
    opened = events.withColumn("lifted", F.from_json("event", _LIFTED))
    return opened.withColumns({name: F.col(f"lifted.{name}") for name in _LIFTED.names})


def source_of_message() -> Column:
    return F.concat(
        F.lit("kafka://"), "topic", F.lit("/partition="), "partition", F.lit("/offset="), "offset"
    )


def batch_label(prefix: str, moment: Column, number: int) -> Column:
    """`<prefix>_<UTC stamp>_<8 hex digits>`; the same again when a batch is repeated."""
    return F.concat(
        F.lit(f"{prefix}_"), F.date_format(moment, "yyyyMMdd'T'HHmmss'Z'"), F.lit(f"_{number:08x}")
    )


def bronze_from_messages(exploded: DataFrame, batch_number: int = 0) -> DataFrame:
    """Bronze rows of a stream batch, with the day they are filed under as `date`."""
    return _with_lifted(exploded).select(
        "received_at",
        "sdk_key",
        *_LIFTED.names,
        F.col("event").alias("raw_event_json"),
        _stamp("loaded_at").alias("exported_at"),
        batch_label("kafka_bronze", F.col("loaded_at"), batch_number).alias("export_batch_id"),
        source_of_message().alias("source_file"),
        F.lit(STREAM_TAG).alias("ingestion_source"),
        _stamp("loaded_at").alias("loaded_at"),
        F.col("partition_date").alias("date"),
    )


def dead_letters(normalised: DataFrame) -> DataFrame:
    """Messages that cannot be used, with the reason, filed by the day they failed."""
    return normalised.filter("reason is not null").select(
        _stamp("loaded_at").alias("failed_at"),
        "topic",
        "partition",
        "offset",
        "reason",
        F.col("value").alias("payload"),
        F.col("loaded_at").cast("date").alias("date"),
    )


def read_records(lines: DataFrame) -> DataFrame:
    """Raw lines (line, file_key) to records, with `problem` set where a line is no record."""
    problem = (
        F.when(F.col("record").isNull(), LINE_INVALID_JSON)
        .when(~_is_object("record"), LINE_NOT_AN_OBJECT)
        .when(~_is_object("record", "$.event"), LINE_WITHOUT_EVENT)
    )
    return (
        lines.withColumns({"record": F.try_parse_json("line"), "fields": F.from_json("line", RAW_LINE)})
        .withColumn("problem", problem)
        .withColumns({name: F.col(f"fields.{name}") for name in RAW_LINE.names})
        .drop("record", "fields")
    )


def strict(records: DataFrame) -> DataFrame:
    """Fail the job, naming the problem, the file and the line, if any line is no record."""
    complaint = F.concat("problem", F.lit(" in "), "file_key", F.lit(": "), "line")
    checked = F.when(F.col("problem").isNull(), F.col("event")).otherwise(F.raise_error(complaint))
    return records.withColumn("event", checked)


def bronze_from_records(records: DataFrame, exported_at: Column, batch_number: int = 0) -> DataFrame:
    """Bronze rows of raw file records."""
    moment = records.withColumn("exported_moment", exported_at)
    return conform(
        _with_lifted(moment).select(
            "received_at",
            "sdk_key",
            *_LIFTED.names,
            F.col("event").alias("raw_event_json"),
            _stamp("exported_moment").alias("exported_at"),
            batch_label("bronze", F.col("exported_moment"), batch_number).alias("export_batch_id"),
            F.col("file_key").alias("source_file"),
            lineage_tag(F.split_part("file_key", F.lit("/"), F.lit(1))).alias("ingestion_source"),
            _stamp("exported_moment").alias("loaded_at"),
        ),
        BRONZE,
    )
