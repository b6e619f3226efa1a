"""Campaign funnel: sessions that reached each step, per day and campaign.

Steps are flags of a session on a day, without an order in time; rates may exceed 1, and a
session that spans midnight counts on both days.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.numbers import safe_ratio
from ..functions.rules import PRODUCT_TYPES, PROMOTION_TYPES, is_type, usable_key
from ..functions.text import UNKNOWN, has_text, null_if_blank
from ..schemas import CAMPAIGN_FUNNEL, conform

KEYS = ("event_date", "sdk_key", "campaign_id")
STEPS = (*PROMOTION_TYPES, *PRODUCT_TYPES)


def campaign_events(valid: DataFrame) -> DataFrame:
    """Events that belong to a campaign: their own one, else the one they came from."""
    usable = is_type(*STEPS) & usable_key() & has_text(F.trim("session_id"))
    return valid.filter(usable).select(
        "event_date",
        F.trim("sdk_key").alias("sdk_key"),
        F.coalesce(
            null_if_blank(F.col("campaign_id")), null_if_blank(F.col("source_campaign_id"))
        ).alias("campaign_id"),
        F.trim("session_id").alias("session_id"),
        "event_type",
        null_if_blank(F.col("campaign_name")).alias("campaign_name"),
    ).filter("campaign_id is not null")


def campaign_names(events: DataFrame) -> DataFrame:
    """One name per campaign and day: the last in text order."""
    return events.filter("campaign_name is not null").groupBy(*KEYS).agg(
        F.max("campaign_name").alias("campaign_name")
    )


def session_flags(events: DataFrame) -> DataFrame:
    """Steps each session reached, by a hash aggregate of flags.

    A hot campaign is split over its sessions here, and a hot session shrinks to one row per
    task before the shuffle; what is left per campaign is summed map-side in the next step.
    """
    return events.groupBy(*KEYS, "session_id").agg(
        *(F.max(is_type(step).cast("int")).alias(f"has_{step}") for step in STEPS)
    )


def campaign_funnel(valid: DataFrame) -> DataFrame:
    return funnel_of(campaign_events(valid))


def funnel_of(events: DataFrame) -> DataFrame:
    """The mart from stored campaign events, which are read twice, by a few columns each time.

    Names are a small aggregate of their own: carried along, their text would make every step sort.
    """
    counted = session_flags(events).groupBy(*KEYS).agg(
        *(F.sum(f"has_{step}").alias(f"{step}_sessions") for step in STEPS)
    )
    reached = counted.join(campaign_names(events), list(KEYS), "left").withColumn(
        "campaign_name", F.coalesce("campaign_name", F.lit(UNKNOWN))
    )
    clicks = F.col("promotion_click_sessions")
    return conform(
        reached.withColumns({
            "view_to_click_rate": safe_ratio(clicks, F.col("promotion_view_sessions")),
            "click_to_product_view_rate": safe_ratio(F.col("product_view_sessions"), clicks),
            "click_to_add_to_cart_rate": safe_ratio(F.col("add_to_cart_sessions"), clicks),
            "last_updated_at": F.current_timestamp(),
        }),
        CAMPAIGN_FUNNEL,
    )
