"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the table folder, ``BENCH_CPUS`` the local cores. Each query
runs a few times against a sink that discards rows; the best time counts, so that the
first compilation in the process does not.
"""

from __future__ import annotations

import json
import os
import time

from rosterflow.queries import QUERIES
from rosterflow.session import local_session

HEADLINE = [
    "validation_issues",
    "unpivot_pairs",
    "unpivot_measures",
    "full_join_coalesce",
    "left_join_flag",
    "membership_invalid",
    "keep_first",
    "duplicate_warnings",
    "current_status",
    "claim_pending",
    "provider_rows",
    "county_table",
    "td_standard_table",
    "min_standard_table",
    "io_roundtrip_csv",
    "stream_intake",
]
RUNS = 3


def seconds(spark, name: str, folder: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, "rosterflow-bench", cpus)
    spark.sparkContext.setLogLevel("ERROR")
    timings = {name: round(min(seconds(spark, name, folder) for _ in range(RUNS)), 3) for name in HEADLINE}
    report = {
        "metric": "total_seconds",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(report))


if __name__ == "__main__":
    main()
