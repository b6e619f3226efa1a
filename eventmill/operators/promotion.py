"""Promotion performance: views, clicks and what followed a click, per day and promotion.

Two properties of the report are kept on purpose:

* Rows are keyed by names as well as ids. By default each has the counts of its own names, so a
  promotion seen under m name variants on a day yields m rows. The report this one stands in for
  matches rows to counts by ids only, which yields m x m rows; `match_names=False` gives that form.
* What followed a click is known by promotion and device, not by placement. It appears on a row
  of its own (NULL placement) and again on every placement row of that promotion and device.
  Never add those columns up across placements.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.numbers import safe_ratio
from ..functions.rules import PRODUCT_TYPES, PROMOTION_TYPES, is_type, usable_key
from ..functions.text import has_text, or_unknown
from ..schemas import PROMOTION_PERFORMANCE, conform

PROMOTION = ("event_date", "sdk_key", "campaign_id", "promotion_id", "device_type")
NAMES = ("campaign_name", "promotion_name")
KEYS = (
    "event_date", "sdk_key", "campaign_id", "campaign_name",
    "promotion_id", "promotion_name", "placement", "device_type",
)
SHOWN = ("promotion_views", "promotion_clicks", "unique_view_sessions", "unique_click_sessions")
FOLLOWED = ("product_views_after_click", "add_to_cart_after_click")


def promotion_rollup(valid: DataFrame) -> DataFrame:
    """All counts the report needs, from one scan of the valid events.

    Promotion events are keyed by their own campaign and promotion, names and placement;
    product events by the campaign and promotion they came from, without names and with a NULL
    placement. The latter marks them: a promotion event's placement is never NULL here.

    Counting per session first and per key second gives exact distinct sessions without
    tripling the rows for two distinct counts, and with map-side combining at both levels.
    """
    shown = is_type(*PROMOTION_TYPES)
    rows = valid.filter(is_type(*PROMOTION_TYPES, *PRODUCT_TYPES) & usable_key()).select(
        "event_date",
        F.trim("sdk_key").alias("sdk_key"),
        F.trim(F.when(shown, F.col("campaign_id")).otherwise(F.col("source_campaign_id"))).alias("campaign_id"),
        F.when(shown, F.trim("campaign_name")).alias("campaign_name"),
        F.trim(F.when(shown, F.col("promotion_id")).otherwise(F.col("source_promotion_id"))).alias("promotion_id"),
        F.when(shown, F.trim("promotion_name")).alias("promotion_name"),
        F.when(shown, or_unknown(F.col("placement"))).alias("placement"),
        or_unknown(F.col("device_type")).alias("device_type"),
        F.when(shown, F.trim("session_id")).alias("session_id"),
        "event_type",
    ).filter(has_text(F.col("campaign_id")) & has_text(F.col("promotion_id")))

    per_session = rows.groupBy(*KEYS, "session_id").agg(
        F.count_if(is_type("promotion_view")).alias("promotion_views"),
        F.count_if(is_type("promotion_click")).alias("promotion_clicks"),
        F.count_if(is_type("product_view")).alias("product_views_after_click"),
        F.count_if(is_type("add_to_cart")).alias("add_to_cart_after_click"),
    )
    in_session = F.col("session_id").isNotNull()
    return per_session.groupBy(*KEYS).agg(
        *(F.sum(name).alias(name) for name in ("promotion_views", "promotion_clicks", *FOLLOWED)),
        F.count_if(in_session & (F.col("promotion_views") > 0)).alias("unique_view_sessions"),
        F.count_if(in_session & (F.col("promotion_clicks") > 0)).alias("unique_click_sessions"),
    )


def promotion_counts(rollup: DataFrame) -> DataFrame:
    return rollup.filter("placement is not null").select(*KEYS, *SHOWN)


def after_click_counts(rollup: DataFrame) -> DataFrame:
    return rollup.filter("placement is null").select(*PROMOTION, *FOLLOWED)


def key_spine(rollup: DataFrame) -> DataFrame:
    """The report's row keys. The roll-up has one row per key, so no distinct is needed."""
    return rollup.select(*KEYS)


def _equal(names: tuple[str, ...], left: str, right: str) -> Column:
    """Equality on columns that are never NULL, null-safe on those that may be."""
    may_be_null = {"placement", *NAMES}
    pairs = (
        F.col(f"{left}.{name}").eqNullSafe(F.col(f"{right}.{name}"))
        if name in may_be_null else F.col(f"{left}.{name}") == F.col(f"{right}.{name}")
        for name in names
    )
    return reduce(Column.__and__, pairs)


def _counts_by_ids(rollup: DataFrame) -> DataFrame:
    """Every row key with the counts of all its name variants, a row for each."""
    joined = key_spine(rollup).alias("k").join(
        promotion_counts(rollup).alias("p"), _equal((*PROMOTION, "placement"), "k", "p"), "left"
    ).join(after_click_counts(rollup).alias("a"), _equal(PROMOTION, "k", "a"), "left")
    return joined.select(
        *(F.col(f"k.{name}").alias(name) for name in (*PROMOTION, "placement")),
        *(F.coalesce(f"k.{name}", f"p.{name}").alias(name) for name in NAMES),
        *(F.coalesce(f"p.{name}", F.lit(0)).alias(name) for name in SHOWN),
        *(F.coalesce(f"a.{name}", F.lit(0)).alias(name) for name in FOLLOWED),
    )


def _counts_by_names(rollup: DataFrame) -> DataFrame:
    """Every row of the roll-up with what followed a click on its promotion and device.

    That stands on the one row of the promotion without placement; a window hands it to the others,
    so the roll-up is read once. A window holds the names and placements of one promotion on one day.
    """
    whole = Window.partitionBy(*PROMOTION)
    return rollup.select(*KEYS, *SHOWN, *(F.max(name).over(whole).alias(name) for name in FOLLOWED))


def promotion_performance(rollup: DataFrame, match_names: bool = True) -> DataFrame:
    """The report from a roll-up; one that is stored, if names are not matched (it is then read three times)."""
    counted = _counts_by_names(rollup) if match_names else _counts_by_ids(rollup)
    views, clicks = F.col("promotion_views"), F.col("promotion_clicks")
    return conform(
        counted.withColumns({
            "ctr": safe_ratio(clicks, views),
            "product_view_rate_after_click": safe_ratio(F.col("product_views_after_click"), clicks),
            "add_to_cart_rate_after_click": safe_ratio(F.col("add_to_cart_after_click"), clicks),
            "last_updated_at": F.current_timestamp(),
        }),
        PROMOTION_PERFORMANCE,
    )
