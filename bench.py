"""Time the headline queries on one machine; prints one JSON line.

BENCH_SF_DIR   folder with the test tables (default /root/testdata/sf0.1)
BENCH_CPUS     local cores (default 8)
BENCH_REPEATS  timed runs per query after one warm-up (default 3, the median counts)
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tagseries.plans.suite import QUERIES  # noqa: E402
from tagseries.session import local_session  # noqa: E402

HEADLINE = [
    "raw_range",
    "raw_latest",
    "raw_only_changes",
    "raw_limit_long",
    "raw_wide",
    "raw_align",
    "raw_series_nested",
    "dedupe_last_write",
    "dedupe_hot_instants",
    "agg_mean",
    "agg_all_functions",
    "agg_minmax",
    "agg_mixed_requests",
    "agg_percentile",
    "agg_fill_linear",
    "path_normalize",
    "onboard_new",
    "asset_points",
    "ingest_matrix",
    "op_metrics",
    "stream_ingest",
    "store_rewritten_instant",
    "latest_stored",
]


def counters(spark) -> tuple[int, int]:
    """(rows read from tables, bytes written to shuffles) by all stages so far."""
    none = spark.sparkContext._gateway.new_array(spark._jvm.double, 0)
    stages = spark.sparkContext._jsc.sc().statusStore().stageList(None, False, False, none, None)
    found = [stages.apply(i) for i in range(stages.size())]
    return sum(x.inputRecords() for x in found), sum(x.shuffleWriteBytes() for x in found)


def run(spark, name: str, sf_dir: str) -> float:
    """Seconds until every row of the result has been computed."""
    begin = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - begin


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    names = sys.argv[1:] or HEADLINE
    spark = local_session("bench", cpus=cpus, partitions=int(cpus) if cpus.isdigit() else 8)
    seconds, details = {}, {}
    for name in names:
        run(spark, name, sf_dir)
        before = counters(spark)
        seconds[name] = round(statistics.median(run(spark, name, sf_dir) for _ in range(repeats)), 3)
        rows, shuffled = ((b - a) // repeats for a, b in zip(before, counters(spark), strict=True))
        details[name] = {"rows": rows, "rows_per_sec": round(rows / seconds[name]), "shuffle_bytes": shuffled}
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "details": details,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
