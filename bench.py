"""Time the headline queries and print one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
Each query runs once to warm up and then twice; the faster run counts. Results go
to Spark's noop sink, so every column of every row is computed.
"""

from __future__ import annotations

import json
import os
import re
import time

from pyspark.sql import SparkSession

HEADLINE = [
    "merge_sources", "merge_remarks", "merge_national_ids", "format_address", "map_citizenship",
    "map_nationality", "pep_entities", "format_birth_dates", "pivot_other_ids", "consolidate",
    "consolidate_dedup", "build_watchlist", "master_view", "filter_view", "run_summary",
]


def main() -> None:
    from checks.queries import REGISTRY

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.optimizer.windowGroupLimitThreshold", "2000")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")

    def seconds(name: str) -> float:
        started = time.perf_counter()
        REGISTRY[name][0](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - started

    times = {}
    for name in HEADLINE:
        seconds(name)
        times[name] = round(min(seconds(name), seconds(name)), 3)
    sf = re.search(r"sf([\d.]+)", sf_dir)
    print(json.dumps({
        "metric": "total_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": float(sf.group(1)) if sf else sf_dir,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
