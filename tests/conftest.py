from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from eventmill.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    work = tmp_path_factory.mktemp("spark")
    session = build_session(
        "tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.python.sql.dataFrameDebugging.enabled": "false",
            "spark.checkpoint.dir": str(work / "shared"),
            "spark.sql.warehouse.dir": str(work / "warehouse"),
            "spark.driver.memory": "6g",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def bronze(spark):
    """Make Bronze rows from keyword arguments; what is not given takes a valid default."""
    import json

    from eventmill.schemas import BRONZE

    defaults = {
        "received_at": "2026-04-30T10:00:00Z", "sdk_key": "k1", "event_id": "e1", "event_type": "page_view",
        "event_time": "2026-04-30T10:00:00Z", "session_id": "s1", "page_url": "/", "exported_at": None,
        "export_batch_id": "b", "source_file": "f", "ingestion_source": "direct_raw",
        "loaded_at": "2026-04-30T11:00:00Z",
    }

    def make(*rows: dict):
        filled = []
        for row in rows:
            row = dict(row)
            payload = row.pop("payload", {})
            raw = payload if isinstance(payload, str) else json.dumps(payload)
            whole = {**defaults, **row, "raw_event_json": raw}
            filled.append(tuple(whole[name] for name in BRONZE.names))
        return spark.createDataFrame(filled, BRONZE)

    return make
