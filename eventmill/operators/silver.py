"""Bronze rows to valid events and quarantined ones, in a single pass.

Copies of an event are ranked once: valid before invalid, then newest load, newest event time,
last source. The first of each group is the event's only survivor; it is a valid event or a
quarantined one depending on its own error code. One shuffle thus yields both tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.rules import error_message, first_error, validation_stage
from ..functions.text import is_blank
from ..schemas import BRONZE, PAYLOAD, SILVER_INVALID, SILVER_VALID, conform

# Fields Bronze carries both as a column and inside the payload.
_LIFTED = ("sdk_key", "event_id", "event_type", "event_time", "session_id", "page_url")
_WHOLE_NUMBERS = (
    "viewport_width", "viewport_height", "position_index", "click_x", "click_y", "quantity",
)
_PAYLOAD_TEXT = tuple(
    name for name in PAYLOAD.names
    if name not in _LIFTED and name not in _WHOLE_NUMBERS and name != "unit_price"
)


def _column_or_payload(name: str) -> str:
    """The Bronze column if it is not NULL (blank counts as given), else the payload field."""
    return f"trim(coalesce({name}, payload.{name}))"


def parse(bronze: DataFrame, also: tuple[str, ...] = ()) -> DataFrame:
    """Typed columns from the Bronze text columns and payload; unparseable values are NULL.

    The payload is parsed by one `from_json` per row, however many fields are read. `also`: further expressions
    over the Bronze columns.
    """
    return bronze.withColumn("payload", F.from_json("raw_event_json", PAYLOAD)).selectExpr(
        "try_cast(received_at AS timestamp) AS received_at",
        f"{_column_or_payload('sdk_key')} AS sdk_key",
        f"{_column_or_payload('event_id')} AS event_id",
        f"lower({_column_or_payload('event_type')}) AS event_type",
        f"{_column_or_payload('event_time')} AS event_time_text",
        f"try_cast({_column_or_payload('event_time')} AS timestamp) AS event_time",
        f"{_column_or_payload('session_id')} AS session_id",
        f"{_column_or_payload('page_url')} AS page_url",
        *(f"trim(payload.{name}) AS {name}" for name in _PAYLOAD_TEXT),
        *(f"try_cast(payload.{name} AS int) AS {name}" for name in _WHOLE_NUMBERS),
        "try_cast(payload.unit_price AS decimal(18,2)) AS unit_price",
        "raw_event_json",
        "export_batch_id",
        "trim(coalesce(ingestion_source, 'unknown')) AS ingestion_source",
        "source_file",
        "try_cast(loaded_at AS timestamp) AS loaded_at",
        # Fingerprint of the whole Bronze row: lets full ties be broken the same way every time
        # without shuffling the payload text of queries that do not ask for it.
        f"xxhash64({', '.join(BRONZE.names)}) AS row_fingerprint",
        *also,
    )


def classify(parsed: DataFrame) -> DataFrame:
    return parsed.withColumn("error_code", first_error())


def ranked(classified: DataFrame) -> DataFrame:
    """The surviving row of every event id, plus every row that has no event id.

    Spark keeps only each task's own best copy per event id before the shuffle (partial window
    group limit), so an id with any number of copies sends at most one row per task. Rows
    without an id cannot be duplicates of each other; each gets a group of its own, which
    spreads them evenly instead of piling them up under one blank key.
    """
    own_group = F.when(is_blank(F.col("event_id")), F.monotonically_increasing_id())
    newest_valid_first = Window.partitionBy("event_id", "own_group").orderBy(
        F.col("error_code").isNotNull(),
        F.col("loaded_at").desc_nulls_last(),
        F.col("event_time").desc_nulls_last(),
        F.col("source_file").desc_nulls_last(),
        F.col("row_fingerprint").desc(),
    )
    return (
        classified.withColumn("own_group", own_group)
        .withColumn("copy_rank", F.row_number().over(newest_valid_first))
        .filter("copy_rank = 1")
        .drop("copy_rank", "own_group")
    )


def first_per_event(classified: DataFrame) -> DataFrame:
    return ranked(classified).drop("row_fingerprint")


def survivors(bronze: DataFrame) -> DataFrame:
    return first_per_event(classify(parse(bronze)))


def valid_events(kept: DataFrame, validated_at: Column | None = None) -> DataFrame:
    stamped = kept.filter(F.col("error_code").isNull()).withColumns({
        "event_date": F.col("event_time").cast("date"),
        "validated_at": F.current_timestamp() if validated_at is None else validated_at,
    })
    return conform(stamped, SILVER_VALID)


def invalid_events(kept: DataFrame, detected_at: Column | None = None) -> DataFrame:
    """The quarantine; it keeps the event time as the text that was sent."""
    stamped = kept.filter(F.col("error_code").isNotNull()).withColumns({
        "event_time": F.col("event_time_text"),
        "error_message": error_message(F.col("error_code")),
        "validation_stage": validation_stage(F.col("error_code")),
        "detected_at": F.current_timestamp() if detected_at is None else detected_at,
    })
    return conform(stamped, SILVER_INVALID)
