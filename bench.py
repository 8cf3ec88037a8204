"""Benchmark of the headline jobs.

Runs each query fully (a ``noop`` write: every row is produced, nothing is
collected to the driver) on local[$BENCH_CPUS] at $BENCH_SF_DIR and prints one
JSON line: {"metric", "value", "unit", "queries", "sf"}.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "prepare_report",  # flagship: clean -> dedupe -> render -> lengths -> split -> stats
    "dedupe_exact",  # B4 + C1
    "near_dup_pairs",  # C3
    "pack_sequences",  # F1 (includes tokenize, vocabulary, encode)
    "score_table",  # I6
    "contamination_check",  # I12
    "serving_metrics",  # L1
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE

    from tunesmith.plans import catalog
    from tunesmith.session import local_session, ship_package

    spark = local_session(cores=cpus, shuffle_partitions=max(int(cpus) * 2, 8) if cpus.isdigit() else 16, app="tunesmith-bench")
    ship_package(spark)
    # warm-up: JVM, Python workers and code generation
    catalog.QUERIES["scan_parquet"](spark, sf_dir).write.format("noop").mode("overwrite").save()

    times = {}
    for name in names:
        t0 = time.perf_counter()
        catalog.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    sf = float(m.group(1)) if m else None
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times, "sf": sf}))
    spark.stop()


if __name__ == "__main__":
    main()
