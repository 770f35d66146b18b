"""Time the queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Every query is executed in full (all columns, all rows) into Spark's no-op sink; the ones
that write files write them.  Each is run once to warm up and then timed; the better of
two timings counts.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402

from recordloom.plans.queries import PARTITIONS_SETTING, QUERIES, table  # noqa: E402

# Steps whose documents per second are reported next to the seconds.
RATED = {
    "requests": "chat_messages",
    "generation": "generate_template",
    "check": "valid_split",
    "parse": "parsed_records",
    "sink": "jsonl_round_trip",
    "end_to_end": "category_difficulty",
}


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    wanted = sys.argv[1:] or list(QUERIES)
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        # The tables are single row groups; deal their rows over all cores.
        .config(PARTITIONS_SETTING, cpus)
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")

    def once(name: str) -> float:
        started = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - started

    seconds: dict[str, float] = {}
    for name in wanted:
        once(name)
        seconds[name] = round(min(once(name), once(name)), 3)
    n = table(spark, folder, "documents").count()
    rates = {
        f"{step}_rows_per_sec": round(n / seconds[name])
        for step, name in RATED.items()
        if name in seconds
    }
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
                "documents": n,
                "rates": rates,
            }
        )
    )


if __name__ == "__main__":
    main()
