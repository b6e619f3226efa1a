"""Bronze rows, messages and raw lines derived from a plain `events` table.

`events(event_id, ts, user_id, event_type, value, props)` has unique, clean rows. The
derivation is deterministic and puts in everything the layers above must deal with: two ingest
paths, copies of events, every kind of invalid event, blank and missing fields, name variants,
malformed messages and broken lines. Rows come and go by residues of the event number `n`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..schemas import BRONZE, conform
from .topic import envelope_text

TOPIC = "events.raw"

# What each event becomes: n is its number, k the number in its props, u its user.
_NUMBERED = (
    "event_id AS n",
    "CAST(get_json_object(props, '$.k') AS INT) AS k",
    "date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'\") AS iso",
    "dayofmonth(ts) AS dd",
    "user_id AS u",
    "CASE event_type WHEN 'view' THEN 'promotion_view' WHEN 'click' THEN 'promotion_click'"
    " WHEN 'signup' THEN 'page_view' WHEN 'error' THEN 'product_view'"
    " WHEN 'purchase' THEN 'add_to_cart' END AS t",
    "value",
)
_PROMO = "t IN ('promotion_view', 'promotion_click')"
_PRODUCT = "t IN ('product_view', 'add_to_cart')"
_CLICK, _CART = "t = 'promotion_click'", "t = 'add_to_cart'"

# Fields Bronze carries as columns of their own.
_LIFTED = {
    "received_at": "IF(n % 131 = 0, 'unknown', iso)",
    "sdk_key": "CASE WHEN n % 97 = 0 THEN NULL WHEN n % 89 = 0 THEN '  ' ELSE 'shop_' || (u % 5) END",
    "event_id": "IF(n % 83 <> 0, 'evt_' || IF(n % 50 IN (1, 3), n - 1, n), NULL)",
    "event_type": "CASE WHEN n % 79 = 0 THEN 'checkout' WHEN n % 73 = 0 THEN ''"
                  " WHEN n % 7 = 0 THEN ' ' || upper(t) || ' ' ELSE t END",
    "event_time": "CASE WHEN n % 71 = 0 THEN 'garbage' WHEN n % 67 = 0 THEN NULL ELSE iso END",
    "session_id": "CASE WHEN n % 61 = 0 THEN '' WHEN n % 11 <> 0 THEN 'sess_' || u || '_' || dd END",
    "page_url": "IF(n % 59 <> 0, '/p/' || k, NULL)",
}

# Fields found only in the event payload.
_PAYLOAD = {
    "anonymous_id": "'anon_' || u",
    "user_id": "IF(n % 3 = 0, 'user_' || u, NULL)",
    "referrer_url": "IF(n % 5 <> 0, '/from/' || k, NULL)",
    "page_title": "' Page ' || k",
    "page_type": f"CASE WHEN {_PRODUCT} THEN 'product' WHEN {_PROMO} THEN 'campaign' ELSE 'home' END",
    "device_type": "CASE u % 3 WHEN 0 THEN 'desktop' WHEN 1 THEN 'mobile' ELSE '' END",
    "os_name": "IF(u % 2 = 0, 'Windows', 'macOS')",
    "browser_name": "IF(u % 4 = 0, 'Chrome', 'Safari')",
    "viewport_width": "1000 + k",
    "viewport_height": "600 + k",
    "country": "IF(u % 7 = 0, 'KR', 'US')",
    "language": "IF(u % 7 = 0, 'ko', 'en')",
    "promotion_id": f"IF({_PROMO}, 'promo_' || (k % 6), NULL)",
    "promotion_name": f"IF({_PROMO}, 'Promotion ' || (k % 6), NULL)",
    "campaign_id": f"IF({_PROMO}, 'camp_' || (k % 3), NULL)",
    "campaign_name": f"IF({_PROMO} AND n % 6 <> 0, 'Campaign ' || (k % 3), NULL)",
    "placement": f"IF({_PROMO} AND n % 53 <> 0, IF(k % 2 = 0, 'main_hero', 'category_top'), NULL)",
    "creative_id": f"IF({_PROMO}, 'creative_' || (k % 4), NULL)",
    "creative_type": f"IF({_PROMO}, IF(k % 4 = 0, 'video', 'image'), NULL)",
    "position_index": f"IF({_PROMO}, k % 5, NULL)",
    "click_target_url": f"IF({_CLICK}, '/go/' || k, NULL)",
    "click_x": f"IF({_CLICK}, n % 400, NULL)",
    "click_y": f"IF({_CLICK}, n % 300, NULL)",
    "product_id": f"IF({_PRODUCT} AND n % 47 <> 0, 'prod_' || k, NULL)",
    "product_name": f"IF({_PRODUCT}, 'Product ' || k, NULL)",
    "category_id": f"IF({_PRODUCT}, 'cat_' || (k % 8), NULL)",
    "category_name": f"IF({_PRODUCT}, 'Category ' || (k % 8), NULL)",
    "quantity": "IF(n % 43 = 0, '1.5', CAST(1 + k % 3 AS STRING))",
    "unit_price": "value",
    "currency": f"IF({_CART}, 'KRW', NULL)",
    "source_promotion_id": f"IF({_PRODUCT} AND n % 4 <> 0, 'promo_' || (k % 6), NULL)",
    "source_campaign_id": f"IF({_PRODUCT} AND n % 4 <> 0, 'camp_' || (k % 3), NULL)",
}
_CLEAN_SESSION = {"session_id": "'sess_' || u || '_' || dd"}

_USER_AGENTS = (
    "Mozilla/5.0 (Windows NT 10.0; Win64; x64) AppleWebKit/537.36 Chrome/{v}.0.0.0 Safari/537.36",
    "Mozilla/5.0 (Macintosh; Intel Mac OS X 10_15_7) AppleWebKit/605.1.15 Version/{v}.0 Safari/605.1.15",
    "Mozilla/5.0 (Linux; Android 14; Pixel 8) AppleWebKit/537.36 Chrome/{v}.0.0.0 Mobile Safari/537.36",
    "Mozilla/5.0 (iPhone; CPU iPhone OS 17_0 like Mac OS X) AppleWebKit/605.1.15 Version/{v}.0 Mobile/15E148 Safari/604.1",
    "Mozilla/5.0 (X11; Linux x86_64; rv:{v}.0) Gecko/20100101 Firefox/{v}.0",
    "Mozilla/5.0 (Windows NT 10.0; Win64; x64) AppleWebKit/537.36 Chrome/{v}.0.0.0 Safari/537.36 Edg/{v}.0.0.0",
    "Mozilla/5.0 (Android 13; Tablet; rv:{v}.0) Gecko/{v}.0 Firefox/{v}.0",
    "curl/{v}.0",
    "",
)

# One request of this many events, then ordinary ones, out of every block of events.
_BLOCK, _BIG_REQUEST, _REQUEST = 1200, 600, 20
_REQUESTS_PER_BLOCK = 1 + (_BLOCK - _BIG_REQUEST) // _REQUEST


def read_events(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/events.parquet")


def _struct(fields: dict[str, str]) -> str:
    return "named_struct(" + ", ".join(f"'{name}', {text}" for name, text in fields.items()) + ")"


def bronze_rows(events: DataFrame) -> DataFrame:
    """Bronze as both ingest paths together leave it."""
    loaded = "IF(n % 5 < 3, '2024-02-01T00:00:00Z', '2024-02-01T06:00:00Z')"
    return conform(
        events.selectExpr(*_NUMBERED).selectExpr(
            *(f"{text} AS {name}" for name, text in _LIFTED.items()),
            f"to_json({_struct(_CLEAN_SESSION | _PAYLOAD)}) AS raw_event_json",
            f"{loaded} AS exported_at",
            "IF(n % 5 < 3, 'bronze_20240201T000000Z_00000000', 'kafka_bronze_20240201T060000Z_00000000')"
            " AS export_batch_id",
            "IF(n % 5 < 3, 'raw_events/part-' || (n % 8),"
            " 'kafka://events.raw/partition=' || (n % 4) || '/offset=' || n) AS source_file",
            "IF(n % 5 < 3, 'direct_raw', 'kafka_consumer_direct') AS ingestion_source",
            f"{loaded} AS loaded_at",
        ),
        BRONZE,
    )


def event_objects(events: DataFrame) -> DataFrame:
    """Whole event objects as a sender sends them: (n, iso, u, event)."""
    lifted = {name: text for name, text in _LIFTED.items() if name not in ("received_at", "sdk_key")}
    return events.selectExpr(*_NUMBERED).selectExpr("n", "iso", "u", f"{_struct(lifted | _PAYLOAD)} AS event")


def requests(events: DataFrame) -> DataFrame:
    """Requests of at most 600 events each: (r, received_at, sdk_key, events)."""
    number = (
        f"CAST((n DIV {_BLOCK}) * {_REQUESTS_PER_BLOCK} + IF(n % {_BLOCK} < {_BIG_REQUEST}, 0,"
        f" 1 + (n % {_BLOCK} - {_BIG_REQUEST}) DIV {_REQUEST}) AS BIGINT)"
    )
    grouped = event_objects(events).withColumn("r", F.expr(number)).groupBy("r").agg(
        F.min("iso").alias("iso"), F.min("u").alias("u"), F.collect_list("event").alias("events")
    )
    return grouped.selectExpr(
        "r",
        "CASE WHEN r % 17 = 0 THEN ' ' WHEN r % 19 = 0 THEN 'yesterday'"
        " WHEN r % 7 = 0 THEN substring(iso, 1, 19) || '+09:00' ELSE iso END AS received_at",
        "IF(r % 31 = 0, ' ', ' shop_' || (u % 5)) AS sdk_key",
        "CASE WHEN r % 43 = 0 THEN slice(events, 1, 0) WHEN r % 37 <> 0 THEN events END AS events",
    )


def messages(events: DataFrame) -> DataFrame:
    """Topic messages for the requests, some of them malformed."""
    enveloped = requests(events).select(
        "r", envelope_text(F.col("received_at"), F.col("sdk_key"), F.col("events")).alias("envelope")
    )
    return enveloped.selectExpr(
        f"'{TOPIC}' AS topic",
        "CAST(r % 4 AS INT) AS partition",
        "r AS offset",
        """CASE WHEN r % 23 = 0 THEN 'not json {'
             WHEN r % 29 = 0 THEN '[{"sdk_key":"shop_0"}]'
             WHEN r % 41 = 0 THEN '{"sdk_key":"shop_1","events":{"event_id":"evt_1"}}'
             WHEN r % 47 = 0 THEN '{"sdk_key":"shop_2","events":[5,"{x"]}'
             ELSE replace(envelope, '"events":[', IF(r % 13 = 0, '"events":[5,"{fake",null,', '"events":['))
             END AS value""",
    )


_FILE_KEY = (
    "IF(n % 5 < 3, 'raw_events', 'raw_events_kafka') || '/date=' || substring(iso, 1, 10)"
    " || '/events-' || format_string('%04d', n DIV 1000) || '.jsonl' AS file_key"
)


def raw_file_keys(events: DataFrame) -> DataFrame:
    """The key of the raw file that each event's line stands in, as a listing would name it."""
    return events.selectExpr(*_NUMBERED).selectExpr("n", _FILE_KEY)


def raw_lines(events: DataFrame) -> DataFrame:
    """Raw file lines and the key of the file each stands in, some lines broken or blank."""
    record = "to_json(named_struct('received_at', iso, 'sdk_key', 'shop_' || (u % 5), 'event', event))"
    line = """CASE WHEN n % 101 = 0 THEN substring(record, 1, 40) WHEN n % 103 = 0 THEN '[' || record || ']'
        WHEN n % 107 = 0 THEN '{"received_at":"2024-01-01T00:00:00Z","sdk_key":"shop_0"}'
        WHEN n % 109 = 0 THEN '{"sdk_key":"shop_0","event":"{}"}' WHEN n % 113 = 0 THEN '  ' ELSE record END AS line"""
    # One-element explode: keeps the uses of a record, and a later filter on the line, from repeating all of it.
    records = event_objects(events).selectExpr("n", "iso", f"explode(array({record})) AS record")
    return records.selectExpr("n", line, _FILE_KEY)


def user_agents(events: DataFrame) -> DataFrame:
    """A user-agent text per event."""
    version = "CAST(100 + CAST(get_json_object(props, '$.k') AS INT) AS STRING)"
    agents = "array(" + ", ".join(f"'{text}'" for text in _USER_AGENTS) + ")"
    return events.selectExpr(
        "event_id",
        f"replace(element_at({agents}, CAST(event_id % {len(_USER_AGENTS)} AS INT) + 1), '{{v}}', {version})"
        " AS user_agent",
    )
