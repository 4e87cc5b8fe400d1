"""Benchmark: run the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is built and executed in full with a ``noop`` write (no driver
collection) after a JIT warm-up of every headline query at sf0.001; prints
ONE JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from gridtide.plans import catalog  # noqa: E402
from gridtide.session import local_session  # noqa: E402

HEADLINE = [
    "season_rule_report",
    "make_full",
    "calendar_complete",
    "generic_flags",
    "half_hour_slots",
    "validate_rows",
    "clean_all",
    "outlier_previous",
    "outlier_previous_global",
    "iqr_fences",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, shuffle_partitions=int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", "16")))
    # Warm up the JVM (JIT) on the smallest scale next to the bench data, then
    # time every query on the requested scale.
    warm_dir = os.path.join(os.path.dirname(sf_dir), "sf0.001")
    if os.path.isdir(warm_dir) and warm_dir != sf_dir:
        for name in HEADLINE:
            catalog.QUERIES[name](spark, warm_dir).write.format("noop").mode("overwrite").save()
    catalog.QUERIES["device_list"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    timings = {}
    for name in HEADLINE:
        # construction is inside the timing: a query may materialise a stage eagerly
        t0 = time.perf_counter()
        df = catalog.QUERIES[name](spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()
        timings[name] = round(time.perf_counter() - t0, 3)
    sf = os.path.basename(sf_dir).removeprefix("sf")
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "sf": sf,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
