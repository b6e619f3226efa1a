from __future__ import annotations

import random

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import Window, functions as F

from eventmill.functions.rules import RULES
from eventmill.operators import census, silver
from eventmill.schemas import BRONZE, SILVER_INVALID, SILVER_VALID

PROMO = {"promotion_id": "p", "promotion_name": "P", "campaign_id": "c", "placement": "top"}

BROKEN = {
    "MISSING_SDK_KEY": {"sdk_key": " "},
    "MISSING_EVENT_ID": {"event_id": ""},
    "MISSING_EVENT_TYPE": {"event_type": ""},
    "INVALID_EVENT_TYPE": {"event_type": "checkout"},
    "MISSING_EVENT_TIME": {"event_time": None},
    "INVALID_EVENT_TIME_FORMAT": {"event_time": "garbage"},
    "MISSING_SESSION_ID": {"session_id": ""},
    "MISSING_PAGE_URL": {"page_url": "   "},
    "MISSING_PROMOTION_REQUIRED_FIELDS": {"event_type": "promotion_view", "payload": {**PROMO, "placement": " "}},
    "MISSING_PRODUCT_ID": {"event_type": "add_to_cart"},
}


def codes(rows):
    return [row.error_code for row in silver.classify(silver.parse(rows)).select("error_code").collect()]


def test_one_row_per_error_code(bronze):
    found = codes(bronze(*BROKEN.values()))
    assert sorted(found) == sorted(BROKEN)
    assert [code for code, _, _ in RULES] == list(BROKEN)


def test_first_broken_rule_wins(bronze):
    assert codes(bronze({"sdk_key": None, "event_id": None, "event_type": "checkout"})) == ["MISSING_SDK_KEY"]
    assert codes(bronze({"event_time": "garbage", "page_url": None})) == ["INVALID_EVENT_TIME_FORMAT"]


def test_blank_column_hides_payload_but_null_does_not(bronze):
    payload = {"session_id": "from payload"}
    assert codes(bronze({"session_id": None, "payload": payload})) == [None]
    assert codes(bronze({"session_id": "", "payload": payload})) == ["MISSING_SESSION_ID"]


def test_only_spaces_are_trimmed(bronze):
    assert codes(bronze({"page_url": "\t"})) == [None]


@pytest.mark.parametrize("text,ok", [
    ("2026-04-30T10:00:00Z", True), ("2026-04-30T10:00:00+09:00", True), ("2026-04-30T10:00:00.123456Z", True),
    ("2026-04-30", True), ("  2026-04-30 10:00:00 ", True), ("garbage", False), ("2026-13-01", False),
])
def test_event_time_formats(bronze, text, ok):
    assert codes(bronze({"event_time": text})) == [None if ok else "INVALID_EVENT_TIME_FORMAT"]


def test_typed_fields_and_unparseable_numbers(bronze):
    row = silver.parse(bronze({
        "event_type": " PAGE_VIEW ",
        "payload": {"quantity": "1.5", "click_x": 7, "unit_price": "39900.125", "page_title": " T ", "extra": 1},
    })).first()
    assert (row.event_type, row.quantity, row.click_x, row.page_title) == ("page_view", None, 7, "T")
    assert str(row.unit_price) == "39900.13"


def test_payload_that_is_not_json_leaves_fields_null(bronze):
    row = silver.parse(bronze({"payload": "not json"})).first()
    assert row.promotion_id is None and row.event_id == "e1"


def test_valid_copy_beats_newer_invalid_copy(bronze):
    kept = silver.survivors(bronze(
        {"source_file": "old valid"},
        {"source_file": "new invalid", "loaded_at": "2026-05-01T00:00:00Z", "page_url": ""},
    ))
    assert [(r.source_file, r.error_code) for r in kept.collect()] == [("old valid", None)]


def test_newest_invalid_copy_is_kept(bronze):
    kept = silver.survivors(bronze(
        {"page_url": "", "source_file": "a"},
        {"page_url": "", "source_file": "b", "loaded_at": "2026-05-01T00:00:00Z"},
    ))
    assert [r.source_file for r in kept.collect()] == ["b"]


@pytest.mark.parametrize("better", [
    {"loaded_at": "2026-05-01T00:00:00Z"}, {"event_time": "2026-04-30T10:00:01Z"}, {"source_file": "g"},
])
def test_order_among_valid_copies(bronze, better):
    kept = silver.survivors(bronze({"session_id": "worse"}, {"session_id": "better", **better}))
    assert [r.session_id for r in kept.collect()] == ["better"]


def test_rows_without_event_id_are_all_kept(bronze):
    kept = silver.survivors(bronze(*[{"event_id": None}] * 3, {"event_id": " "}, {}))
    assert kept.filter("error_code = 'MISSING_EVENT_ID'").count() == 4
    assert silver.valid_events(kept).count() == 1


def test_layouts_messages_and_stages(bronze):
    kept = silver.survivors(bronze({}, {"event_id": "e2", "event_time": "garbage"}))
    valid, invalid = silver.valid_events(kept), silver.invalid_events(kept)
    assert [(f.name, f.dataType) for f in valid.schema] == [(f.name, f.dataType) for f in SILVER_VALID]
    assert [(f.name, f.dataType) for f in invalid.schema] == [(f.name, f.dataType) for f in SILVER_INVALID]
    row = invalid.first()
    assert (row.event_time, row.error_message, row.validation_stage) == (
        "garbage", "event_time must be parseable timestamp", "COMMON_FORMAT")


def test_all_errors_lists_every_complaint_of_an_event(bronze):
    rows = bronze({"sdk_key": "", "event_id": "", "event_time": "", "event_type": "promotion_click",
                   "payload": {"promotion_id": "p"}})
    found = {row.complaint for row in census.by_message(silver.parse(rows)).collect()}
    assert found == {
        "sdk_key is required", "event_time is required", "promotion_click: promotion_name is required",
        "promotion_click: campaign_id is required", "promotion_click: placement is required",
    }


def test_hot_event_id_is_cut_down_before_the_shuffle(bronze):
    plan = silver.survivors(bronze({}))._jdf.queryExecution().executedPlan().toString()
    before_shuffle = plan[plan.index("Exchange"):]
    assert "WindowGroupLimit" in before_shuffle, "copies must be ranked per task before they are shuffled"
    assert plan.count("Exchange") == 1


def _two_passes(rows):
    """The same result by definition: one ranking per table."""
    classified = silver.classify(silver.parse(rows))
    newest = [F.col(c).desc_nulls_last() for c in ("loaded_at", "event_time", "source_file", "row_fingerprint")]
    by_event = Window.partitionBy("event_id")
    keyed = classified.filter("coalesce(event_id, '') <> ''")
    valid = keyed.filter("error_code is null").withColumn("at", F.row_number().over(by_event.orderBy(*newest)))
    everything = keyed.withColumn(
        "at", F.row_number().over(by_event.orderBy(F.col("error_code").isNotNull(), *newest)))
    invalid = everything.filter("at = 1 and error_code is not null").unionByName(
        classified.filter("coalesce(event_id, '') = '' and error_code is not null").withColumn("at", F.lit(1)))
    return valid.filter("at = 1"), invalid


def _bag(rows):
    columns = ("event_id", "error_code", "session_id", "loaded_at", "event_time", "source_file")
    return sorted(map(str, rows.select(*columns).collect()))


copies = st.lists(
    st.fixed_dictionaries({
        "event_id": st.sampled_from(["e1", "e2", "e3", "", None]),
        "page_url": st.sampled_from(["/", ""]),
        "session_id": st.sampled_from(["s1", "s2"]),
        "event_time": st.sampled_from(["2026-04-30T10:00:00Z", "2026-04-30T10:00:01Z", "garbage"]),
        "loaded_at": st.sampled_from(["2026-04-30T11:00:00Z", "2026-05-01T11:00:00Z", None]),
        "source_file": st.sampled_from(["a", "b", None]),
    }),
    min_size=1, max_size=25,
)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=copies, seed=st.integers(0, 99))
def test_one_pass_equals_two_passes_in_any_input_order(bronze, rows, seed):
    kept = silver.survivors(bronze(*rows))
    valid, invalid = _two_passes(bronze(*rows))
    assert _bag(kept.filter("error_code is null")) == _bag(valid)
    assert _bag(kept.filter("error_code is not null")) == _bag(invalid)
    shuffled = rows[:]
    random.Random(seed).shuffle(shuffled)
    assert _bag(silver.survivors(bronze(*shuffled).repartition(3))) == _bag(kept)


def test_bronze_layout_is_text_only():
    assert {field.dataType.simpleString() for field in BRONZE} == {"string"}
