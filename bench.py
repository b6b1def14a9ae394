"""Benchmark: headline queries over $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints one JSON line: {"metric", "value", "unit", "queries", "sf"}. Each
query is timed end to end (building the plan, any eager staging writes,
and a full execution into Spark's no-op sink), after one untimed warm-up
run of the flagship query on the smallest data.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from portolan.plans.registry import QUERIES  # noqa: E402
from portolan.session import build_session  # noqa: E402

HEADLINE = [
    "arrivals_typed", "dedup_full_row", "fact_arrivals", "dim_time", "dim_ports", "dim_cities",
    "dim_temperatures", "young_arrivals", "oldest", "port_types", "top_cities", "weekday_counts",
    "match_rate_by_month", "dq_unique_keys", "union_months_distinct", "star_load",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(f"local[{cpus}]", app="portolan-bench", shuffle_partitions=int(cpus),
                          extra={"spark.driver.memory": "16g"})
    spark.sparkContext.setLogLevel("ERROR")
    smoke = os.path.join(os.path.dirname(sf_dir), "sf0.001")
    if os.path.isdir(smoke):
        QUERIES["weekday_counts"](spark, smoke).write.format("noop").mode("overwrite").save()
    times: dict[str, float | None] = {}
    for key in HEADLINE:
        t0 = time.perf_counter()
        try:
            QUERIES[key](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times[key] = round(time.perf_counter() - t0, 3)
        except Exception as ex:  # noqa: BLE001 - report the failure, keep timing the rest
            print(f"bench: {key} failed: {type(ex).__name__}: {str(ex)[:300]}", file=sys.stderr)
            times[key] = None
    m = re.search(r"sf([0-9.]+)$", sf_dir)
    print(json.dumps({
        "metric": "headline_total_sec",
        "value": round(sum(t for t in times.values() if t is not None), 3),
        "failed": [k for k, t in times.items() if t is None],
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else sf_dir,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
