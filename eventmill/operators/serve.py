"""Reads of the marts: filtered and cut lists, rankings, totals, report lines.

A list holds all rows of the (filtered) mart unless a page of `limit` rows is asked for; rankings and
totals work on the list they are given. Each list and ranking has a total order, so results do not
depend on how the mart happens to be stored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from ..functions.numbers import grouped_integer, number_or_zero, percent_text, rate_tier, safe_ratio
from ..functions.times import iso_text
from ..schemas import (
    FUNNEL_NULLABLE, FUNNEL_SERVED, HEALTH_NULLABLE, HEALTH_SERVED, PROMOTION_NULLABLE, PROMOTION_SERVED,
)

# Rows per page of a list, rows per ranking.
PAGE, RANK_DEFAULT = 500, 5


def _at_least_one(rows: int) -> int:
    if rows < 1:
        raise ValueError(f"{rows} rows were asked for")
    return rows


def _then(order: list[Column], columns: list[str], used: tuple[str, ...]) -> list[Column]:
    """The order, made total by the other columns: a tie that is left is between equal rows."""
    return [*order, *(F.col(name).asc_nulls_last() for name in columns if name not in used)]


def _newest(mart: DataFrame, columns: list[str], sdk_key: str | None, limit: int | None) -> DataFrame:
    key = (sdk_key or "").strip()
    rows = mart.filter(F.col("sdk_key") == key) if key else mart
    newest_first = [F.col("event_date").desc_nulls_last()]
    ordered = rows.select(*columns).orderBy(*_then(newest_first, columns, ("event_date",)))
    return ordered if limit is None else ordered.limit(_at_least_one(limit))


def health_rows(mart: DataFrame, sdk_key: str | None = None, limit: int | None = None) -> DataFrame:
    return _newest(mart, HEALTH_SERVED, sdk_key, limit)


def promotion_rows(mart: DataFrame, sdk_key: str | None = None, limit: int | None = None) -> DataFrame:
    """Device type is not among the columns, so rows may look alike."""
    return _newest(mart, PROMOTION_SERVED, sdk_key, limit)


def funnel_rows(mart: DataFrame, sdk_key: str | None = None, limit: int | None = None) -> DataFrame:
    return _newest(mart, FUNNEL_SERVED, sdk_key, limit)


def dashboard_health(mart: DataFrame, sdk_key: str | None = None, limit: int | None = None) -> DataFrame:
    order = _then([F.desc_nulls_last("event_date")], HEALTH_SERVED, ("event_date",))
    return health_rows(mart, sdk_key, limit).orderBy(*order)


def dashboard_promotion(mart: DataFrame, sdk_key: str | None = None, limit: int | None = None) -> DataFrame:
    newest = [F.desc_nulls_last("event_date"), F.desc_nulls_last("ctr")]
    return promotion_rows(mart, sdk_key, limit).orderBy(*_then(newest, PROMOTION_SERVED, ("event_date", "ctr")))


def dashboard_funnel(mart: DataFrame, sdk_key: str | None = None, limit: int | None = None) -> DataFrame:
    newest = [F.desc_nulls_last("event_date"), F.desc_nulls_last("promotion_view_sessions")]
    return funnel_rows(mart, sdk_key, limit).orderBy(
        *_then(newest, FUNNEL_SERVED, ("event_date", "promotion_view_sessions")))


def by_day_and(mart: DataFrame, measure: str) -> DataFrame:
    """A whole mart, newest day first and largest measure first within it."""
    newest = [F.desc_nulls_last("event_date"), F.desc_nulls_last(measure)]
    return mart.orderBy(*_then(newest, mart.columns, ("event_date", measure)))


def dashboard(
    health: DataFrame, promotion: DataFrame, funnel: DataFrame,
    sdk_key: str | None = None, limit: int | None = None,
) -> dict[str, DataFrame]:
    """The three lists of one dashboard load, each in display order."""
    return {
        "health": dashboard_health(health, sdk_key, limit),
        "promotion": dashboard_promotion(promotion, sdk_key, limit),
        "funnel": dashboard_funnel(funnel, sdk_key, limit),
    }


def serialised(rows: DataFrame) -> DataFrame:
    """Dates and times as ISO text, decimals as doubles."""
    def plain(field: T.StructField) -> str:
        name = f"`{field.name}`"
        if isinstance(field.dataType, T.TimestampType):
            return f"{iso_text(name)} AS {name}"
        if isinstance(field.dataType, T.DateType):
            return f"CAST({name} AS string) AS {name}"
        if isinstance(field.dataType, T.DecimalType):
            return f"CAST({name} AS double) AS {name}"
        return name

    return rows.selectExpr(*(plain(field) for field in rows.schema.fields))


def _count_text(name: str) -> Column:
    return number_or_zero(F.col(name)).cast("bigint")


def latest_day(rows: DataFrame) -> DataFrame:
    """Health rows of the newest day in a list, with their report text."""
    newest = rows.agg(F.max("event_date").alias("newest"))  # one row
    line = F.format_string(
        "- sdk_key: %s\n  raw=%d, valid=%d, invalid=%d\n  invalid_ratio=%s, sessions=%d",
        F.coalesce("sdk_key", F.lit("-")),
        _count_text("raw_event_count"), _count_text("valid_event_count"), _count_text("invalid_event_count"),
        percent_text(F.col("invalid_event_ratio")), _count_text("distinct_sessions"),
    )
    return (
        rows.join(F.broadcast(newest), F.col("event_date").eqNullSafe(F.col("newest")))
        .drop("newest")
        .withColumn("line", line)
    )


def _ranked(rows: DataFrame, k: int, by: list[Column], then: list[str]) -> DataFrame:
    order = [column.desc_nulls_last() for column in by] + [F.col(name).asc_nulls_last() for name in then]
    top = rows.orderBy(*order).limit(_at_least_one(k))
    return top.withColumn("place", F.row_number().over(Window.partitionBy().orderBy(*order)))


def top_invalid(rows: DataFrame, k: int = RANK_DEFAULT) -> DataFrame:
    """Days and keys with the highest share of invalid events."""
    ranked = _ranked(
        rows, k,
        [number_or_zero(F.col("invalid_event_ratio")), _count_text("invalid_event_count"), F.col("event_date")],
        ["sdk_key"],
    )
    return ranked.withColumn("line", F.format_string(
        "%d. %s | %s | ratio=%s | invalid=%d",
        "place", F.col("event_date").cast("string"), "sdk_key",
        percent_text(F.col("invalid_event_ratio")), _count_text("invalid_event_count"),
    ))


def top_ctr(rows: DataFrame, k: int = RANK_DEFAULT) -> DataFrame:
    """Promotions with the highest click-through rate."""
    rest = [name for name in PROMOTION_SERVED if name not in ("ctr", "promotion_clicks", "event_date")]
    ranked = _ranked(
        rows, k, [number_or_zero(F.col("ctr")), _count_text("promotion_clicks"), F.col("event_date")], rest
    )
    return ranked.withColumn("line", F.format_string(
        "%d. %s / %s | ctr=%s | clicks=%d views=%d",
        "place", F.coalesce("campaign_id", F.lit("-")), F.coalesce("promotion_id", F.lit("-")),
        percent_text(F.col("ctr")), _count_text("promotion_clicks"), _count_text("promotion_views"),
    ))


def top_funnel(rows: DataFrame, k: int = RANK_DEFAULT) -> DataFrame:
    """The newest days' campaigns with the most viewing sessions."""
    ranked = _ranked(
        rows, k, [F.col("event_date"), _count_text("promotion_view_sessions")], ["sdk_key", "campaign_id"]
    )
    return ranked.withColumn("line", F.format_string(
        "%d. %s | %s | view=%d click=%d pv=%d atc=%d\n"
        "   rates: view→click=%s, click→pv=%s, click→atc=%s",
        "place", F.col("event_date").cast("string"), F.coalesce("campaign_id", F.lit("-")),
        *(_count_text(f"{step}_sessions") for step in
          ("promotion_view", "promotion_click", "product_view", "add_to_cart")),
        percent_text(F.col("view_to_click_rate")),
        percent_text(F.col("click_to_product_view_rate")),
        percent_text(F.col("click_to_add_to_cart_rate")),
    ))


def health_totals(rows: DataFrame) -> DataFrame:
    counts = ("raw_event_count", "valid_event_count", "invalid_event_count")
    totals = rows.agg(*(F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in counts))
    return totals.withColumn(
        "invalid_event_ratio", safe_ratio(F.col("invalid_event_count"), F.col("raw_event_count"))
    )


def workspace_keys(rows: DataFrame) -> DataFrame:
    return rows.select("sdk_key").distinct().orderBy("sdk_key")


def rate_badges(rows: DataFrame, rate: str, counts: list[str]) -> DataFrame:
    """Display text of a rate and of counts, and the rate's tier."""
    return rows.withColumns({
        "rate_text": percent_text(F.col(rate)),
        "rate_tier": rate_tier(number_or_zero(F.col(rate))),
        **{f"{name}_text": grouped_integer(F.col(name)) for name in counts},
    })


def contract_violations(rows: DataFrame, nullable: set[str]) -> DataFrame:
    """Served rows with a NULL in a column that must have a value, and how many such columns."""
    required = [name for name in rows.columns if name not in nullable]
    missing = reduce(Column.__add__, (F.col(name).isNull().cast("int") for name in required))
    return rows.withColumn("missing_fields", missing).filter("missing_fields > 0")


NULLABLE = {"health": HEALTH_NULLABLE, "promotion": PROMOTION_NULLABLE, "funnel": FUNNEL_NULLABLE}

