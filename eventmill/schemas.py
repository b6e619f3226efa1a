"""Table layouts."""

from __future__ import annotations

from pyspark.sql import DataFrame, types as T

STRING, INT, BIGINT, DATE, TIMESTAMP = T.StringType(), T.IntegerType(), T.LongType(), T.DateType(), T.TimestampType()
PRICE = T.DecimalType(18, 2)
# Twenty digits: a click and millions of views give more than ten would hold.
RATIO = T.DecimalType(20, 4)


def _table(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields])


# Column names, order and types of the stored tables.
BRONZE = _table(
    ("received_at", STRING),
    ("sdk_key", STRING),
    ("event_id", STRING),
    ("event_type", STRING),
    ("event_time", STRING),
    ("session_id", STRING),
    ("page_url", STRING),
    ("raw_event_json", STRING),
    ("exported_at", STRING),
    ("export_batch_id", STRING),
    ("source_file", STRING),
    ("ingestion_source", STRING),
    ("loaded_at", STRING),
)

SILVER_VALID = _table(
    ("received_at", TIMESTAMP),
    ("event_date", DATE),
    ("sdk_key", STRING),
    ("event_id", STRING),
    ("event_type", STRING),
    ("event_time", TIMESTAMP),
    ("session_id", STRING),
    ("anonymous_id", STRING),
    ("user_id", STRING),
    ("page_url", STRING),
    ("referrer_url", STRING),
    ("page_title", STRING),
    ("page_type", STRING),
    ("device_type", STRING),
    ("os_name", STRING),
    ("browser_name", STRING),
    ("viewport_width", INT),
    ("viewport_height", INT),
    ("country", STRING),
    ("language", STRING),
    ("promotion_id", STRING),
    ("promotion_name", STRING),
    ("campaign_id", STRING),
    ("campaign_name", STRING),
    ("placement", STRING),
    ("creative_id", STRING),
    ("creative_type", STRING),
    ("position_index", INT),
    ("click_target_url", STRING),
    ("click_x", INT),
    ("click_y", INT),
    ("product_id", STRING),
    ("product_name", STRING),
    ("category_id", STRING),
    ("category_name", STRING),
    ("quantity", INT),
    ("unit_price", PRICE),
    ("currency", STRING),
    ("source_promotion_id", STRING),
    ("source_campaign_id", STRING),
    ("raw_event_json", STRING),
    ("export_batch_id", STRING),
    ("ingestion_source", STRING),
    ("source_file", STRING),
    ("loaded_at", TIMESTAMP),
    ("validated_at", TIMESTAMP),
)

SILVER_INVALID = _table(
    ("received_at", TIMESTAMP),
    ("sdk_key", STRING),
    ("event_id", STRING),
    ("event_type", STRING),
    ("event_time", STRING),
    ("session_id", STRING),
    ("page_url", STRING),
    ("raw_event_json", STRING),
    ("error_code", STRING),
    ("error_message", STRING),
    ("validation_stage", STRING),
    ("ingestion_source", STRING),
    ("source_file", STRING),
    ("loaded_at", TIMESTAMP),
    ("detected_at", TIMESTAMP),
)

WORKSPACE_HEALTH = _table(
    ("event_date", DATE),
    ("sdk_key", STRING),
    ("raw_event_count", BIGINT),
    ("valid_event_count", BIGINT),
    ("invalid_event_count", BIGINT),
    ("invalid_event_ratio", RATIO),
    ("distinct_sessions", BIGINT),
    ("latest_event_time", TIMESTAMP),
    ("latest_loaded_at", TIMESTAMP),
    ("freshness_minutes", INT),
    ("last_updated_at", TIMESTAMP),
)

PROMOTION_PERFORMANCE = _table(
    ("event_date", DATE),
    ("sdk_key", STRING),
    ("campaign_id", STRING),
    ("campaign_name", STRING),
    ("promotion_id", STRING),
    ("promotion_name", STRING),
    ("placement", STRING),
    ("device_type", STRING),
    ("promotion_views", BIGINT),
    ("promotion_clicks", BIGINT),
    ("ctr", RATIO),
    ("unique_view_sessions", BIGINT),
    ("unique_click_sessions", BIGINT),
    ("product_views_after_click", BIGINT),
    ("add_to_cart_after_click", BIGINT),
    ("product_view_rate_after_click", RATIO),
    ("add_to_cart_rate_after_click", RATIO),
    ("last_updated_at", TIMESTAMP),
)

CAMPAIGN_FUNNEL = _table(
    ("event_date", DATE),
    ("sdk_key", STRING),
    ("campaign_id", STRING),
    ("campaign_name", STRING),
    ("promotion_view_sessions", BIGINT),
    ("promotion_click_sessions", BIGINT),
    ("product_view_sessions", BIGINT),
    ("add_to_cart_sessions", BIGINT),
    ("view_to_click_rate", RATIO),
    ("click_to_product_view_rate", RATIO),
    ("click_to_add_to_cart_rate", RATIO),
    ("last_updated_at", TIMESTAMP),
)

# Columns handed out by the serving queries, and which of them may be NULL.
HEALTH_SERVED = [
    "event_date",
    "sdk_key",
    "raw_event_count",
    "valid_event_count",
    "invalid_event_count",
    "invalid_event_ratio",
    "distinct_sessions",
    "latest_event_time",
    "freshness_minutes",
]
PROMOTION_SERVED = [
    "event_date",
    "sdk_key",
    "campaign_id",
    "campaign_name",
    "promotion_id",
    "promotion_name",
    "placement",
    "promotion_views",
    "promotion_clicks",
    "ctr",
    "product_views_after_click",
    "add_to_cart_after_click",
    "product_view_rate_after_click",
    "add_to_cart_rate_after_click",
]
FUNNEL_SERVED = [
    "event_date",
    "sdk_key",
    "campaign_id",
    "campaign_name",
    "promotion_view_sessions",
    "promotion_click_sessions",
    "product_view_sessions",
    "add_to_cart_sessions",
    "view_to_click_rate",
    "click_to_product_view_rate",
    "click_to_add_to_cart_rate",
]
HEALTH_NULLABLE = {"freshness_minutes"}
PROMOTION_NULLABLE = {"campaign_name", "promotion_name", "placement"}
FUNNEL_NULLABLE = {"campaign_name"}

# The payload fields Silver reads. Every one is taken as text first.
PAYLOAD = _table(
    ("sdk_key", STRING),
    ("event_id", STRING),
    ("event_type", STRING),
    ("event_time", STRING),
    ("session_id", STRING),
    ("page_url", STRING),
    ("anonymous_id", STRING),
    ("user_id", STRING),
    ("referrer_url", STRING),
    ("page_title", STRING),
    ("page_type", STRING),
    ("device_type", STRING),
    ("os_name", STRING),
    ("browser_name", STRING),
    ("viewport_width", STRING),
    ("viewport_height", STRING),
    ("country", STRING),
    ("language", STRING),
    ("promotion_id", STRING),
    ("promotion_name", STRING),
    ("campaign_id", STRING),
    ("campaign_name", STRING),
    ("placement", STRING),
    ("creative_id", STRING),
    ("creative_type", STRING),
    ("position_index", STRING),
    ("click_target_url", STRING),
    ("click_x", STRING),
    ("click_y", STRING),
    ("product_id", STRING),
    ("product_name", STRING),
    ("category_id", STRING),
    ("category_name", STRING),
    ("quantity", STRING),
    ("unit_price", STRING),
    ("currency", STRING),
    ("source_promotion_id", STRING),
    ("source_campaign_id", STRING),
)

# A raw JSONL line; the event object is kept as its JSON text.
RAW_LINE = _table(
    ("received_at", STRING),
    ("sdk_key", STRING),
    ("event", STRING),
)

# A message taken from the event topic.
MESSAGE = _table(
    ("topic", STRING),
    ("partition", INT),
    ("offset", BIGINT),
    ("value", STRING),
)


def conform(df: DataFrame, table: T.StructType) -> DataFrame:
    """Project `df` onto a declared table: its column order, its types, nothing else."""
    return df.selectExpr(
        *(f"CAST({field.name} AS {field.dataType.simpleString()}) AS {field.name}" for field in table.fields)
    )
