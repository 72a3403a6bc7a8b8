"""Time the headline queries; prints one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the local cores.  Each query
runs once to warm up code generation and Python workers, then twice; the better
time counts.  Building the query is part of the time, since it includes the
search for busy routes.
"""

from __future__ import annotations

import json
import os
import sys
import time

from waycast.plans.catalog import CATALOG
from waycast.session import build_session

HEADLINE = [
    "alerts_replay", "alerts_replay_single_route", "alerts_replay_per_user", "alerts_changed_only",
    "alert_scenario_counts", "request_best_match", "departed_alerts", "active_alerts", "request_lifetimes",
    "best_timeline", "best_per_route", "timetable_latest", "timetable_intervals", "decode_events",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(cores=cores, shuffle_partitions=int(cores) if cores.isdigit() else 8)
    chosen = sys.argv[1:] or HEADLINE
    seconds = {}
    for name in chosen:
        runs = []
        for _ in range(3):
            start = time.perf_counter()
            CATALOG[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
        seconds[name] = round(min(runs[1:]), 3)
    spark.stop()
    print(json.dumps({
        "metric": "total seconds of the headline queries", "value": round(sum(seconds.values()), 3),
        "unit": "sec", "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
