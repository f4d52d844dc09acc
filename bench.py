"""Time the registered queries; prints one JSON line.

BENCH_SF_DIR: folder of the test tables, BENCH_CPUS: local threads.
Each query runs once to warm up (code generation, file cache) and is then timed; its whole result
is computed and dropped. Stream queries share one run of the stream, which is timed as `stream_run`.
"""

from __future__ import annotations

import json
import logging
import os
import sys
import time

from pyspark.sql import SparkSession

from tillwright.plans import catalog


def seconds(action) -> float:
    start = time.perf_counter()
    action()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    only = set(sys.argv[1:])
    logging.getLogger("py4j").setLevel(logging.ERROR)
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("tillwright-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "16g")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")

    timings = {}
    for name, query in catalog.queries().items():
        shared = name.startswith("stream_") and name not in ("stream_late_file", "stream_repeats")
        if shared or (only and name not in only):
            continue

        def run(query=query):
            query(spark, sf_dir).write.format("noop").mode("overwrite").save()

        run()
        timings[name] = round(seconds(run), 3)
    if not only or "stream_run" in only:
        timings["stream_run"] = round(seconds(lambda: catalog.StreamRun(spark, sf_dir)), 3)

    print(
        json.dumps(
            {
                "metric": "total_query_time",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "sf": os.path.basename(sf_dir).removeprefix("sf"),
                "cpus": int(cpus),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
