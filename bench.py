"""Times every query at one scale and prints one JSON line.

BENCH_SF_DIR names the folder of tables, BENCH_CPUS the local threads,
BENCH_QUERIES an optional comma-separated choice of queries, BENCH_RUNS how often
each is run (the best time counts).
"""

from __future__ import annotations

import json
import os
import sys
import time

from fieldtally.plans.registry import QUERIES
from fieldtally.session import build_session


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    chosen = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q] or list(QUERIES)
    spark = build_session(f"local[{cpus}]", "fieldtally-bench", **{
        "spark.sql.shuffle.partitions": cpus,
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": os.environ.get("BENCH_MEMORY", "8g"),
        # Each table is one file with one row group, so one task reads it. Shuffled
        # rows are spread over all threads again rather than kept with that task.
        "spark.sql.adaptive.localShuffleReader.enabled": "false",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "128k",
    })
    spark.sparkContext.setLogLevel("ERROR")
    # The first query pays for starting the JVM's code generation; keep that out.
    QUERIES["combined_species"](spark, folder).write.format("noop").mode("overwrite").save()

    seconds: dict[str, float] = {}
    for name in chosen:
        times = []
        for _ in range(int(os.environ.get("BENCH_RUNS", "2"))):
            start = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        seconds[name] = round(min(times), 3)
        print(f"{name}: {seconds[name]}", file=sys.stderr)
    spark.stop()
    print(json.dumps({
        "metric": "total time of all queries, best run of each", "value": round(sum(seconds.values()), 3),
        "unit": "sec", "queries": seconds,
        "sf": float(os.path.basename(folder).removeprefix("sf") or 0)}))


if __name__ == "__main__":
    main()
