"""Time the headline queries; prints one JSON line.

A query's time covers building its plan, eager passes included, and running it into a sink that drops the rows. Each
runs twice and the second run counts, so that JVM warm-up does not.
"""

from __future__ import annotations

import json
import os
import time

from loadwitness.registry import QUERIES
from loadwitness.session import local_session

HEADLINE = [
    "symmetric_difference",
    "symmetric_difference_multiset",
    "row_count_check",
    "uniqueness_check",
    "not_null_check",
    "validation_suite",
    "load_verdicts",
    "row_hash",
    "latest_flow_status",
    "step_node_left",
    "step_status_rollup",
    "node_execution",
    "child_workflow",
    "discrepancy_counts",
    "discrepancy_preview",
    "detailed_log",
    "schema_verdict",
    "test_execution",
    "discrepancy_report",
    "report_header",
]


def run(spark, name: str, folder: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), app="bench")
    times = {}
    for name in HEADLINE:
        run(spark, name, folder)
        times[name] = round(run(spark, name, folder), 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
