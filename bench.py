"""Times the headline queries on the tables of $BENCH_SF_DIR and prints one JSON line.

Each query runs once to warm up and then three times; the median counts. `value` is the sum
over the queries.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from registry.queries import all_queries  # noqa: E402
from tidemark.session import build_session  # noqa: E402

HEADLINE = [
    "closures_latest_per_day",
    "closures_gap_dedupe",
    "closure_reopen_pairs",
    "unified_accounts",
    "current_account_status",
    "open_accounts_by_date",
    "user_activity_by_date",
    "active_user_rate",
    "active_user_rate_as_of",
    "lifecycle_by_week",
    "check_relationships",
    "check_summary",
    "incremental_closures_state",
    "incremental_mart_rebuild",
]
RUNS = 3


def seconds(action) -> float:
    start = time.perf_counter()
    action()
    return time.perf_counter() - start


def median_seconds(action) -> float:
    action()
    return round(statistics.median(seconds(action) for _ in range(RUNS)), 3)


def consume(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    spark = build_session("bench", master=f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus if cpus.isdigit() else "8",
        "spark.driver.memory": os.environ.get("BENCH_MEMORY", "12g"),
    })
    spark.sparkContext.setLogLevel("ERROR")
    queries = all_queries()
    timed = {name: median_seconds(lambda: consume(queries[name](spark, folder)))
             for name in HEADLINE}
    print(json.dumps({
        "metric": "headline_total",
        "value": round(sum(timed.values()), 3),
        "unit": "sec",
        "queries": timed,
        "sf": os.path.basename(folder).removeprefix("sf"),
        "events": spark.read.parquet(f"{folder}/events.parquet").count(),
        "cpus": cpus,
        "spark": spark.version,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
