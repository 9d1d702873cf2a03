"""Time the registered queries and print one JSON line.

``BENCH_SF_DIR`` and ``BENCH_CPUS`` choose the tables and cores. Each query runs twice over its
whole result (``noop`` sink); ``queries`` holds the second, warm time and ``cold`` the first. A
query that raises is reported under ``failed``, not timed.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

from harness.queries import QUERIES


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or list(QUERIES)
    spark = (SparkSession.builder.master(f"local[{cpus}]").appName("bench")
             .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "8g"))
             .config("spark.ui.enabled", "false")
             .config("spark.sql.shuffle.partitions", cpus)
             .config("spark.sql.session.timeZone", "UTC").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{sf_dir}/events.parquet").count()
    cold, warm, failed = {}, {}, {}
    for name in names:
        for times in (cold, warm):
            begin = time.perf_counter()
            try:
                QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            except Exception as error:  # the other queries still get their figures
                failed[name] = f"{type(error).__name__}: {str(error)[:200]}"
                break
            times[name] = round(time.perf_counter() - begin, 3)
    print(json.dumps({
        "metric": "total_query_seconds", "value": round(sum(warm.values()), 3), "unit": "sec",
        "queries": warm, "failed": failed, "cold": cold, "cold_total": round(sum(cold.values()), 3),
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"), "cpus": int(cpus),
        "spark": spark.version}))


if __name__ == "__main__":
    main()
