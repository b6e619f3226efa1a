"""Times the headline queries, and the layers over stored rows; prints one JSON line.

`queries` holds seconds per query at the given scale: a registered query starts from the plain `events`
table and thus includes deriving Bronze from it. The table, one small file, is first stored in as many files as
there are cores, as a larger table would be; read as one file, all work before the first shuffle is one task.
Every query runs once to warm up and then `BENCH_RUNS` times (default two); the best run counts. `value` is
their sum; no query is part of another.

`layers` is about scale: Bronze of `BENCH_ROWS` rows (default two million) is stored first, then Silver and
each mart are built from stored rows, as a refresh does, once each. It gives seconds, and rows of the layer's
input per second and core. `refresh_days` is an increment of a hundredth of the events on top of them.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import functions as F  # noqa: E402

from eventmill.plans import refresh  # noqa: E402
from eventmill.plans.registry import queries  # noqa: E402
from eventmill.session import build_session, scratch_path  # noqa: E402
from eventmill.sources import derived  # noqa: E402

HEADLINE = (
    "bronze_union_lineage", "envelope_normalise_reasons", "envelope_explode_bronze", "raw_file_bronze",
    "silver_valid", "silver_invalid", "all_errors_census", "workspace_health", "promotion_performance",
    "campaign_funnel", "ua_enrichment",
)


def many_events(events, rows: int, tasks: int):
    """The events over again under other numbers and users, until there are `rows` of them, in `tasks` parts."""
    known = events.count()
    times = max(1, -(-rows // known))
    repeated = events.repartition(tasks, "event_id").withColumn("turn", F.explode(F.sequence(F.lit(0), F.lit(times - 1))))
    return repeated.withColumns({
        "event_id": F.col("event_id") + F.col("turn") * F.lit(10 * known),
        "user_id": F.col("user_id") + F.col("turn") * F.lit(1_000_000),
    }).drop("turn"), known * times


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    rows = int(os.environ.get("BENCH_ROWS", "2000000"))
    spark = build_session(
        "bench", f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "12g",
            "spark.python.sql.dataFrameDebugging.enabled": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")

    def timed(action, times: int) -> float:
        best = None
        for run in range(times + 1):
            start = time.perf_counter()
            action()
            taken = time.perf_counter() - start
            if run or not times:
                best = taken if best is None else min(best, taken)
        return round(best, 3)

    def drain(df) -> None:
        df.write.format("noop").mode("overwrite").save()

    parted = scratch_path(spark, "bench-tables")
    derived.read_events(spark, folder).repartition(int(cpus)).write.parquet(f"{parted}/events.parquet")
    seconds = {name: timed(lambda: drain(queries()[name](spark, parted)), runs) for name in HEADLINE}

    tables = refresh.Tables(prefix="bench_", root=scratch_path(spark, "bench"))
    refresh.create_databases(spark, tables)
    events, known = many_events(derived.read_events(spark, folder), rows, 4 * int(cpus))
    refresh.build_bronze(derived.bronze_rows(events), tables)
    layers = {}
    for name, build in (
        ("silver", refresh.build_silver), ("health", refresh.build_health), ("promotion", refresh.build_promotion),
        ("funnel", refresh.build_funnel),
    ):
        taken = timed(lambda: build(spark, tables), 0)
        layers[name] = {"sec": taken, "rows_per_sec_per_core": round(known / taken / int(cpus))}
    more = derived.bronze_rows(events.filter("event_id % 100 = 7")).withColumn("loaded_at", F.lit("2024-02-03T00:00:00Z"))
    layers["refresh_days"] = {"sec": timed(lambda: refresh.refresh_days(spark, tables, more), 0)}
    refresh.drop_lake(spark, tables)

    print(json.dumps({
        "metric": "headline_total", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds,
        "layers": layers, "layer_rows": known, "sf": Path(folder).name.removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
