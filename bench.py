"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default: all cores),
BENCH_QUERIES (comma list, default: the headline ones), BENCH_WARM=1 for a
second, warm pass that is reported under "warm".
"""

from __future__ import annotations

import json
import os
import time

from curbflow.checks.queries import QUERIES
from curbflow.session import build_session

HEADLINE = (
    "ping_lift_reads",
    "lift_case_cascade",
    "street_proximity",
    "ping_segments",
    "street_completion",
    "trip_weighted_completion",
    "trip_lift_update",
    "full_rollup",
    "trip_stops_build",
    "fix_percentage",
)


def timed(spark, name: str, folder: str) -> float:
    started = time.perf_counter()
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - started, 3)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "*")
    names = [name for name in os.environ.get("BENCH_QUERIES", "").split(",") if name] or list(HEADLINE)
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": "16" if cpus == "*" else str(2 * int(cpus)),
            "spark.driver.memory": "12g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    cold = {name: timed(spark, name, folder) for name in names}
    report = {
        "metric": "headline_queries_total",
        "value": round(sum(cold.values()), 3),
        "unit": "sec",
        "queries": cold,
        "sf": folder.rstrip("/").rsplit("sf", 1)[-1],
    }
    if os.environ.get("BENCH_WARM") == "1":
        report["warm"] = {name: timed(spark, name, folder) for name in names}
    print(json.dumps(report))
    spark.stop()


if __name__ == "__main__":
    main()
