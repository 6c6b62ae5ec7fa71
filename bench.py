"""Times the headline queries and prints one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the local cores. Each query runs once
cold and three times warm; ``queries`` holds the warm medians, ``value`` their sum.
Results are written to Spark's no-op sink, so every row and column is produced.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from lamina.session import local_session  # noqa: E402
from workload.queries import QUERIES  # noqa: E402

HEADLINE = [
    "query_where_date",
    "query_window",
    "query_window_open_end",
    "query_order_topk",
    "query_count",
    "query_statistics",
    "query_object_ids",
    "query_typed_and_decoded",
    "query_pages",
    "envelope_filter",
    "reproject_mercator",
    "truncate_utf8",
    "to_integer",
    "diff_updates",
    "diff_deletes",
    "dup_key_gate",
    "upsert_snapshot",
    "sync_results",
    "append_snapshot",
    "edits_no_rollback",
    "edits_rollback",
    "batch_packing",
    "pages_round_trip",
    "edit_responses",
    "error_text",
    "attach_query",
    "attach_update",
    "attach_delete_requests",
]
WARM_RUNS = 3


def timed(spark, folder: str, name: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8)
    cold, warm = {}, {}
    for name in HEADLINE:
        cold[name] = round(timed(spark, folder, name), 3)
        runs: list[float] = []
        while len(runs) < WARM_RUNS:
            runs.append(timed(spark, folder, name))
        warm[name] = round(statistics.median(runs), 3)
    print(
        json.dumps(
            {
                "metric": "sum of warm median seconds",
                "value": round(sum(warm.values()), 3),
                "unit": "sec",
                "queries": warm,
                "cold": cold,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
                "cores": cpus,
                "spark": spark.version,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
