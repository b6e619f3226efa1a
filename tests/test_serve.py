from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from eventmill.functions.device import browser_name, device_type, os_name
from eventmill.functions.numbers import grouped_integer, percent_text, rate_tier
from eventmill.operators import serve
from eventmill.schemas import CAMPAIGN_FUNNEL, PROMOTION_PERFORMANCE, WORKSPACE_HEALTH


def mart(spark, layout, *rows):
    """Mart rows from keyword dicts; counts default to 0, rates to 0, the rest to NULL."""
    def default(field):
        kind = field.dataType.simpleString()
        return Decimal("0.0000") if kind.startswith("decimal") else 0 if kind == "bigint" else None

    return spark.createDataFrame(
        [tuple(row.get(field.name, default(field)) for field in layout) for row in rows], layout)


def health(spark, *rows):
    filled = [{"latest_event_time": dt.datetime(2026, 4, 1), **row} for row in rows]
    return mart(spark, WORKSPACE_HEALTH, *filled)


def day(number):
    return dt.date(2026, 4, number)


def test_list_is_newest_first_cut_and_filtered(spark):
    rows = health(spark, *({"event_date": day(n), "sdk_key": key} for n in (1, 2, 3) for key in ("a", "b")))
    assert [r.event_date.day for r in serve.health_rows(rows, limit=3).collect()] == [3, 3, 2]
    assert [r.sdk_key for r in serve.health_rows(rows, " a ").collect()] == ["a"] * 3
    assert serve.health_rows(rows, "   ").count() == 6
    with pytest.raises(ValueError):
        serve.health_rows(rows, limit=0)


def test_latest_day_lines(spark):
    rows = health(
        spark, {"event_date": day(1), "sdk_key": "a"},
        {"event_date": day(2), "sdk_key": "a", "raw_event_count": 1000, "valid_event_count": 9, "invalid_event_count": 1,
         "invalid_event_ratio": Decimal("0.1234"), "distinct_sessions": 4},
    )
    found = serve.latest_day(serve.health_rows(rows)).collect()
    assert [r.line for r in found] == ["- sdk_key: a\n  raw=1000, valid=9, invalid=1\n  invalid_ratio=12.34%, sessions=4"]


def test_rankings(spark):
    rows = health(
        spark, {"event_date": day(1), "sdk_key": "a", "invalid_event_ratio": Decimal("0.5"), "invalid_event_count": 2},
        {"event_date": day(2), "sdk_key": "b", "invalid_event_ratio": Decimal("0.5"), "invalid_event_count": 3},
        {"event_date": day(3), "sdk_key": "c", "invalid_event_ratio": Decimal("0.1"), "invalid_event_count": 9},
    )
    top = serve.top_invalid(serve.health_rows(rows), 2).orderBy("place").collect()
    assert [r.line for r in top] == [
        "1. 2026-04-02 | b | ratio=50.00% | invalid=3", "2. 2026-04-01 | a | ratio=50.00% | invalid=2"]
    assert serve.top_invalid(serve.health_rows(rows), 99).count() == 3
    promo = mart(spark, PROMOTION_PERFORMANCE, {"event_date": day(1), "sdk_key": "a", "campaign_id": "c", "promotion_id": "p",
                                               "ctr": Decimal("0.25"), "promotion_clicks": 1, "promotion_views": 4})
    assert serve.top_ctr(serve.promotion_rows(promo)).first().line == "1. c / p | ctr=25.00% | clicks=1 views=4"
    steps = mart(spark, CAMPAIGN_FUNNEL, {"event_date": day(1), "sdk_key": "a", "campaign_id": "c", "promotion_view_sessions": 2,
                                          "promotion_click_sessions": 1, "view_to_click_rate": Decimal("0.5")})
    assert serve.top_funnel(serve.funnel_rows(steps)).first().line == (
        "1. 2026-04-01 | c | view=2 click=1 pv=0 atc=0\n   rates: view→click=50.00%, click→pv=0.00%, click→atc=0.00%")


def test_totals_keys_and_contract(spark):
    rows = health(
        spark, {"event_date": day(1), "sdk_key": "b", "raw_event_count": 3, "invalid_event_count": 1},
        {"event_date": None, "sdk_key": "a"},
    )
    listed = serve.health_rows(rows)
    totals = serve.health_totals(listed).first()
    assert (totals.raw_event_count, totals.invalid_event_ratio) == (3, Decimal("0.3333"))
    assert [r.sdk_key for r in serve.workspace_keys(listed).collect()] == ["a", "b"]
    broken = serve.contract_violations(listed, serve.NULLABLE["health"]).collect()
    assert [(r.sdk_key, r.missing_fields) for r in broken] == [("a", 1)]
    assert serve.health_totals(listed.limit(0)).first().invalid_event_ratio == 0


def test_dashboard_orders(spark):
    promo = mart(spark, PROMOTION_PERFORMANCE, *(
        {"event_date": day(n), "sdk_key": "a", "campaign_id": "c", "promotion_id": "p", "ctr": Decimal(c)}
        for n, c in ((1, "0.9"), (2, "0.1"), (2, "0.3"))))
    listed = serve.dashboard(health(spark, {"event_date": day(1), "sdk_key": "a"}), promo, mart(spark, CAMPAIGN_FUNNEL, {}))
    assert set(listed) == {"health", "promotion", "funnel"}
    assert [float(r.ctr) for r in listed["promotion"].collect()] == [0.3, 0.1, 0.9]


def test_tiers_and_texts(spark):
    rows = spark.createDataFrame([(0.5,), (0.4999,), (0.2,), (0.1999,)], "r double")
    found = rows.select(rate_tier(F.col("r")).alias("t"), percent_text(F.col("r")).alias("p")).collect()
    assert [(r.t, r.p) for r in found] == [("high", "50.00%"), ("mid", "49.99%"), ("mid", "20.00%"), ("low", "19.99%")]
    one = spark.range(1).select(grouped_integer(F.lit(1234567)).alias("g"), percent_text(F.lit(None).cast("decimal(10,4)")).alias("n")).first()
    assert (one.g, one.n) == ("1,234,567", "0.00%")


def test_iso_text_is_what_python_prints(spark):
    moments = [dt.datetime(2026, 4, 1), dt.datetime(2026, 4, 1, 1, 2, 3, 45), dt.datetime(2026, 4, 1, 0, 0, 0, 100000)]
    rows = serve.serialised(spark.createDataFrame([(m,) for m in moments], "t timestamp"))
    assert [r.t for r in rows.collect()] == [m.isoformat() for m in moments]


def test_serialised_types(spark):
    row = serve.serialised(serve.health_rows(health(spark, {"event_date": day(1), "sdk_key": "a"}))).first()
    assert (row.event_date, row.latest_event_time, row.invalid_event_ratio) == ("2026-04-01", "2026-04-01T00:00:00", 0.0)


def test_user_agents(spark):
    agents = [
        ("Mozilla/5.0 (iPhone; CPU iPhone OS 17_0 like Mac OS X) Version/17.0 Mobile/15E148 Safari/604.1", "mobile", "macOS", "Safari"),
        ("Mozilla/5.0 (Linux; Android 14) Chrome/120.0 Mobile Safari/537.36", "mobile", "Android", "Chrome"),
        ("Mozilla/5.0 (Windows NT 10.0) Chrome/120.0 Safari/537.36 Edg/120.0", "desktop", "Windows", "Edge"),
        ("Mozilla/5.0 (X11; Linux x86_64) Firefox/120.0", "desktop", "Linux", "Firefox"),
        ("", "desktop", None, None), (None, "desktop", None, None),
    ]
    rows = spark.createDataFrame([(a[0],) for a in agents], "ua string")
    ua = F.col("ua")
    found = rows.select(device_type(ua).alias("d"), os_name(ua).alias("o"), browser_name(ua).alias("b")).collect()
    assert [(r.d, r.o, r.b) for r in found] == [a[1:] for a in agents]


def test_lists_totals_and_rankings_cover_the_whole_mart(spark):
    rows = spark.range(1200).selectExpr(
        "DATE'2026-01-01' + CAST(id % 30 AS INT) AS event_date", "format_string('k%04d', id) AS sdk_key", "1L AS raw_event_count",
        "0L AS valid_event_count", "1L AS invalid_event_count", "CAST(1 AS DECIMAL(20,4)) AS invalid_event_ratio", "0L AS distinct_sessions",
        "TIMESTAMP'2026-01-01' AS latest_event_time", "TIMESTAMP'2026-01-01' AS latest_loaded_at", "0 AS freshness_minutes",
        "TIMESTAMP'2026-01-01' AS last_updated_at")
    listed = serve.health_rows(rows)
    assert listed.count() == 1200 and serve.health_totals(listed).first().raw_event_count == 1200
    assert serve.workspace_keys(listed).count() == 1200
    assert serve.top_invalid(listed, 100).count() == 100
    assert serve.latest_day(listed).count() == 40
    with pytest.raises(ValueError):
        serve.top_invalid(listed, 0)
    promo = mart(spark, PROMOTION_PERFORMANCE, *({"event_date": day(1), "sdk_key": f"k{n}", "campaign_id": "c", "promotion_id": "p"} for n in range(600)))
    assert serve.top_ctr(serve.promotion_rows(promo), 100).count() == 100
    assert serve.promotion_rows(promo).count() == 600


def test_orders_are_total(spark):
    rows = health(spark, *({"event_date": day(1), "sdk_key": f"k{n}", "raw_event_count": 3} for n in range(50))).repartition(7)
    for ordered in (serve.dashboard_health(rows), serve.by_day_and(rows, "raw_event_count"), serve.health_rows(rows)):
        assert [r.sdk_key for r in ordered.collect()] == sorted(f"k{n}" for n in range(50))
