"""Headline timings: one warm-up, then the median of several runs into a sink that drops the rows.

Prints one JSON line. Environment: BENCH_SF_DIR, BENCH_CPUS, BENCH_REPEATS.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from siltstone.catalog import ENTRIES  # noqa: E402
from siltstone.catalog.base import Tables  # noqa: E402
from siltstone.plans.workload import run_workload  # noqa: E402
from siltstone.session import build_session  # noqa: E402
from siltstone.sources.generate import json_rows_for  # noqa: E402

HEADLINE = [
    "cdc_scd2_spans",
    "cdc_scd1_latest",
    "cdc_composite_sequence",
    "cdc_change_feed",
    "cdc_commit_summary",
    "flow_patient_history",
    "flow_patient_quarantine",
    "rel_silver_orders",
    "rel_sales_by_city",
    "rel_rank_rows",
    "source_json_quality",
    "json_records",
    "json_flatten",
    "json_track_keys",
    "dq_expect",
    "dq_quarantine",
    "std_standardize",
    "obs_schema_history",
    "obs_schema_diff",
    "cdc_digest_feed",
    "cdc_state_scd1",
    "cdc_state_scd2",
    "cdc_stream_scd2",
    "rel_mart_from_changes",
]
# Streams run a dozen jobs each; one timed run after the warm-up is enough.
ONCE = ("cdc_state_scd1", "cdc_state_scd2", "cdc_stream_scd2", "rel_mart_from_changes")


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 4))
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    spark = build_session(
        "siltstone-bench",
        f"local[{cpus}]",
        {"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "8g", "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds: dict[str, float] = {}
    tables = Tables(spark, folder)
    # Stored tables have many row groups; the test tables have one, which a single core would read.
    spread = tables.scratch("bench-tables")
    for path in sorted(os.listdir(folder)):
        if path.endswith(".parquet"):
            spark.read.parquet(f"{folder}/{path}").repartition(int(cpus)).write.parquet(f"{spread}/{path}")
    stored = tables.scratch("bench-rows")
    json_rows_for(tables("events"), "event_id").repartition(int(cpus)).write.parquet(stored)
    workload = run_workload(spark.read.parquet(stored), tables.scratch("bench"), repeats=repeats, warm_up=True)
    for row in workload.collect():
        seconds[f"{row.benchmark}_{row.method}"] = round(row.duration_sec, 4)
    for name in HEADLINE:
        times = []
        for attempt in range(2 if name in ONCE else repeats + 1):
            start = time.perf_counter()
            ENTRIES[name].build(spark, spread).write.format("noop").mode("overwrite").save()
            if attempt:
                times.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(times), 4)
    scale = os.path.basename(folder.rstrip("/")).removeprefix("sf")
    print(
        json.dumps(
            {"metric": "total_median_seconds", "value": round(sum(seconds.values()), 4), "unit": "sec", "queries": seconds, "sf": scale}
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
