"""Event validation rules as data, and the column expressions built from them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F

from .text import has_text, is_blank

# Event types, required fields, error codes, messages and stages. The order of
# RULES is the checking order, the first rule that matches names the error.
EVENT_TYPES = ("page_view", "promotion_view", "promotion_click", "product_view", "add_to_cart")
PROMOTION_TYPES = ("promotion_view", "promotion_click")
PRODUCT_TYPES = ("product_view", "add_to_cart")
PROMOTION_FIELDS = ("promotion_id", "promotion_name", "campaign_id", "placement")
PRODUCT_FIELDS = ("product_id",)
RULES = (
    ("MISSING_SDK_KEY", "sdk_key is required", "COMMON_REQUIRED"),
    ("MISSING_EVENT_ID", "event_id is required", "COMMON_REQUIRED"),
    ("MISSING_EVENT_TYPE", "event_type is required", "COMMON_REQUIRED"),
    (
        "INVALID_EVENT_TYPE",
        "event_type must be one of page_view,promotion_view,promotion_click,product_view,add_to_cart",
        "EVENT_TYPE",
    ),
    ("MISSING_EVENT_TIME", "event_time is required", "COMMON_REQUIRED"),
    ("INVALID_EVENT_TIME_FORMAT", "event_time must be parseable timestamp", "COMMON_FORMAT"),
    ("MISSING_SESSION_ID", "session_id is required", "COMMON_REQUIRED"),
    ("MISSING_PAGE_URL", "page_url is required", "COMMON_REQUIRED"),
    (
        "MISSING_PROMOTION_REQUIRED_FIELDS",
        "promotion_id,promotion_name,campaign_id,placement are required for promotion events",
        "EVENT_SPECIFIC",
    ),
    (
        "MISSING_PRODUCT_ID",
        "product_id is required for product_view/add_to_cart",
        "EVENT_SPECIFIC",
    ),
)
UNKNOWN_MESSAGE, UNKNOWN_STAGE = "unknown validation error", "UNKNOWN"
ALWAYS_REQUIRED = ("sdk_key", "event_type", "event_time", "session_id", "page_url")

# Parsed events carry the event time both as sent and as a timestamp.
_TEXT_OF = {"event_time": "event_time_text"}


def _any_blank(fields: tuple[str, ...]) -> Column:
    return reduce(Column.__or__, (is_blank(F.col(field)) for field in fields))


def _broken() -> dict[str, Column]:
    """When each rule is broken, over the columns of parsed events."""
    kind = F.col("event_type")
    return {
        "MISSING_SDK_KEY": is_blank(F.col("sdk_key")),
        "MISSING_EVENT_ID": is_blank(F.col("event_id")),
        "MISSING_EVENT_TYPE": is_blank(kind),
        "INVALID_EVENT_TYPE": ~kind.isin(*EVENT_TYPES),
        "MISSING_EVENT_TIME": is_blank(F.col(_TEXT_OF["event_time"])),
        "INVALID_EVENT_TIME_FORMAT": F.col("event_time").isNull(),
        "MISSING_SESSION_ID": is_blank(F.col("session_id")),
        "MISSING_PAGE_URL": is_blank(F.col("page_url")),
        "MISSING_PROMOTION_REQUIRED_FIELDS":
            kind.isin(*PROMOTION_TYPES) & _any_blank(PROMOTION_FIELDS),
        "MISSING_PRODUCT_ID": kind.isin(*PRODUCT_TYPES) & _any_blank(PRODUCT_FIELDS),
    }


def first_error() -> Column:
    """Code of the first broken rule, NULL for a valid event."""
    broken = _broken()
    return F.coalesce(*(F.when(broken[code], F.lit(code)) for code, _, _ in RULES))


def _looked_up(code: Column, position: int, default: str) -> Column:
    found = [F.when(code == rule[0], F.lit(rule[position])) for rule in RULES]
    return F.coalesce(*found, F.lit(default))


def error_message(code: Column) -> Column:
    return _looked_up(code, 1, UNKNOWN_MESSAGE)


def validation_stage(code: Column) -> Column:
    return _looked_up(code, 2, UNKNOWN_STAGE)


def all_errors() -> Column:
    """Every missing field of an event as an array of messages, in checking order.

    This is the sender-side check: it asks for neither an event id nor a known type.
    """
    common = [
        F.when(is_blank(F.col(_TEXT_OF.get(field, field))), F.lit(f"{field} is required"))
        for field in ALWAYS_REQUIRED
    ]
    specific = [
        F.when(
            F.col("event_type").isin(*kinds) & is_blank(F.col(field)),
            F.concat("event_type", F.lit(f": {field} is required")),
        )
        for kinds, fields in ((PROMOTION_TYPES, PROMOTION_FIELDS), (PRODUCT_TYPES, PRODUCT_FIELDS))
        for field in fields
    ]
    return F.array_compact(F.array(*common, *specific))


def is_type(*kinds: str) -> Column:
    return F.col("event_type").isin(*kinds)


def usable_key() -> Column:
    """Rows that can be booked on a workspace and a day."""
    return F.col("event_date").isNotNull() & has_text(F.trim("sdk_key"))
