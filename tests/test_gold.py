from __future__ import annotations

from decimal import Decimal

from pyspark.sql import functions as F

from eventmill.operators import funnel, health, promotion, silver

PROMO = {"promotion_id": "p", "promotion_name": "P", "campaign_id": "c", "placement": "top"}


def events(*specs):
    """Bronze rows with an id each, from (type, session, payload, extra columns)."""
    rows = []
    for number, (kind, session, payload, *extra) in enumerate(specs):
        rows.append({"event_id": f"e{number}", "event_type": kind, "session_id": session,
                     "payload": payload, **(extra[0] if extra else {})})
    return rows


def valid(bronze, *specs):
    return silver.valid_events(silver.survivors(bronze(*events(*specs))))


def report(bronze, *specs, **options):
    rollup = promotion.promotion_rollup(valid(bronze, *specs)).persist()
    return promotion.promotion_performance(rollup, **options)


def test_distinct_sessions_and_counts(bronze):
    row = report(
        bronze, ("promotion_view", "s1", PROMO), ("promotion_view", "s1", PROMO), ("promotion_view", "s2", PROMO),
        ("promotion_click", "s1", PROMO),
    ).first()
    assert (row.promotion_views, row.promotion_clicks, row.unique_view_sessions, row.unique_click_sessions) == (3, 1, 2, 1)
    assert (row.ctr, row.device_type) == (Decimal("0.3333"), "(unknown)")


def test_name_variants_multiply(bronze):
    specs = [("promotion_view", "s1", {**PROMO, "campaign_name": name}) for name in ("A", "B")]
    rows = report(bronze, *specs, match_names=False).collect()
    assert sorted(r.campaign_name for r in rows) == ["A", "A", "B", "B"]
    assert [r.campaign_name for r in report(bronze, *specs).orderBy("campaign_name").collect()] == ["A", "B"]


def test_missing_name_takes_the_matched_one(bronze):
    specs = ("promotion_view", "s1", {**PROMO, "campaign_name": "A"}), ("promotion_view", "s1", PROMO)
    rows = report(bronze, *specs, match_names=False).collect()
    assert sorted(str(r.campaign_name) for r in rows) == ["A", "A", "A", "None"]


def test_what_followed_a_click_shows_on_its_own_row_and_on_each_placement(bronze):
    after = {"product_id": "x", "source_promotion_id": "p", "source_campaign_id": "c"}
    rows = report(
        bronze, ("promotion_view", "s1", PROMO), ("promotion_click", "s1", {**PROMO, "placement": "side"}),
        ("product_view", "s1", after), ("add_to_cart", "s1", after), ("add_to_cart", "s2", after),
    ).collect()
    by_placement = {r.placement: (r.product_views_after_click, r.add_to_cart_after_click) for r in rows}
    assert by_placement == {"top": (1, 2), "side": (1, 2), None: (1, 2)}
    assert {r.placement: r.add_to_cart_rate_after_click for r in rows}["side"] == Decimal("2.0000")


def test_followed_without_promotion_row_and_device_must_match(bronze):
    after = {"product_id": "x", "source_promotion_id": "q", "source_campaign_id": "c"}
    rows = report(
        bronze, ("product_view", "s1", after),
        ("promotion_view", "s1", {**PROMO, "device_type": "mobile"}),
        ("product_view", "s1", {**after, "source_promotion_id": "p", "device_type": "desktop"}),
        ("product_view", "s1", {"product_id": "x"}),
    ).collect()
    found = {(r.promotion_id, r.placement, r.device_type): r.product_views_after_click for r in rows}
    assert found == {("q", None, "(unknown)"): 1, ("p", "top", "mobile"): 0, ("p", None, "desktop"): 1}


def test_funnel_flags_rates_and_days(bronze):
    product = {"product_id": "x", "source_campaign_id": "c"}
    rows = funnel.campaign_funnel(valid(
        bronze, ("promotion_click", "s1", {**PROMO, "campaign_name": "A"}), ("promotion_click", "s1", PROMO),
        ("product_view", "s1", product), ("product_view", "s2", product),
        ("promotion_view", "s1", {**PROMO, "campaign_name": "B"}, {"event_time": "2026-05-01T00:00:00Z"}),
        ("page_view", "s3", {}), ("product_view", "s4", {"product_id": "x"}),
    )).orderBy("event_date").collect()
    first, second = rows
    assert (first.promotion_view_sessions, first.promotion_click_sessions, first.product_view_sessions) == (0, 1, 2)
    assert (first.view_to_click_rate, first.click_to_product_view_rate) == (Decimal("0.0000"), Decimal("2.0000"))
    assert (first.campaign_name, second.campaign_name, second.promotion_view_sessions) == ("A", "B", 1)


def test_funnel_reads_the_events_for_flags_and_for_names(bronze):
    plan = funnel.campaign_funnel(valid(bronze, ("page_view", "s", {})))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan ") == 2


def test_health_counts_copies_only_as_raw(bronze):
    rows = bronze(
        {"event_id": "a"}, {"event_id": "a"}, {"event_id": "b", "session_id": "s2"},
        {"event_id": "c", "page_url": ""}, {"event_id": "d", "event_time": "garbage"}, {"sdk_key": " "},
    )
    row = health.workspace_health(rows, silver.survivors(rows)).first()
    assert (row.raw_event_count, row.valid_event_count, row.invalid_event_count, row.distinct_sessions) == (5, 2, 2, 2)
    assert (row.invalid_event_ratio, row.freshness_minutes) == (Decimal("0.4000"), 60)


def test_health_null_day_keeps_row_without_count(bronze):
    rows = bronze({"event_time": "garbage", "received_at": "garbage"})
    row = health.workspace_health(rows, silver.survivors(rows)).first()
    assert (row.event_date, row.sdk_key, row.raw_event_count, row.invalid_event_count) == (None, "k1", 0, 0)
    assert row.latest_event_time is None and row.freshness_minutes is None


def test_health_raw_side_ignores_the_payload(bronze):
    rows = bronze({"sdk_key": None, "payload": {"sdk_key": "from payload"}})
    row = health.workspace_health(rows, silver.survivors(rows)).first()
    assert (row.sdk_key, row.raw_event_count, row.valid_event_count) == ("from payload", 0, 1)
    assert row.invalid_event_ratio == Decimal("0.0000") and row.latest_event_time is not None


def test_negative_freshness_is_cut_toward_zero(bronze):
    rows = bronze({"event_time": "2026-04-30T11:01:30Z"})
    assert health.workspace_health(rows, silver.survivors(rows)).first().freshness_minutes == -1


def test_ratio_rounds_half_up(spark):
    from eventmill.functions.numbers import safe_ratio

    rows = spark.createDataFrame([(1, 32), (2, 3), (1, 0), (0, 5)], "a long, b long")
    found = [str(r.r) for r in rows.select(safe_ratio(F.col("a"), F.col("b")).alias("r")).collect()]
    assert found == ["0.0313", "0.6667", "0.0000", "0.0000"]


def test_a_ratio_beyond_a_million_is_no_failure(spark):
    from eventmill.functions.numbers import safe_ratio

    row = spark.createDataFrame([(2_000_000, 1), (1, 0)], "a bigint, b bigint").select(safe_ratio(F.col("a"), F.col("b")).alias("r"))
    assert [r.r for r in row.collect()] == [Decimal("2000000.0000"), Decimal("0.0000")]
    rollup = spark.range(1).selectExpr(
        "DATE'2026-04-01' AS event_date", "'k' AS sdk_key", "'c' AS campaign_id", "'n' AS campaign_name", "'p' AS promotion_id",
        "'P' AS promotion_name", "'top' AS placement", "'d' AS device_type", "1L AS promotion_views", "2000000L AS promotion_clicks",
        "1L AS unique_view_sessions", "1L AS unique_click_sessions", "0L AS product_views_after_click", "0L AS add_to_cart_after_click")
    assert promotion.promotion_performance(rollup).first().ctr == 2_000_000


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_the_funnel_counts_by_hash(bronze):
    kept = valid(bronze, ("promotion_view", "s1", PROMO))
    flags = funnel.session_flags(funnel.campaign_events(kept))
    assert "SortAggregate" not in _plan(flags) and _plan(flags).count("HashAggregate") == 2
    # The whole mart sorts for the campaign's name alone: before and after that one's shuffle.
    assert _plan(funnel.campaign_funnel(kept)).count("SortAggregate") <= 2


def test_the_promotion_report_reads_the_rollup_once(spark, bronze):
    plan = _plan(promotion.promotion_performance(promotion.promotion_rollup(valid(bronze, ("promotion_view", "s1", PROMO)))))
    assert "Join" not in plan and plan.count("Scan ") == 1
