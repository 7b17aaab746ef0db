"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR   folder of the test tables   (default /root/testdata/sf0.1)
BENCH_CPUS     local cores                 (default all)
BENCH_RUNS     timed runs per query        (default 5, after one that does not count; the median counts)
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from popledger import get_session  # noqa: E402
from popledger.registry import QUERIES  # noqa: E402
from popledger.registry.base import release  # noqa: E402

HEADLINE = [
    "agg_claims", "cost_util", "members", "riskscr_service", "inpatient_metrics", "snf_readmissions", "roster_overlap",
    "spans_merged", "member_elig", "group_split", "metrics_key_value",
]


def main() -> None:
    path = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    runs = int(os.environ.get("BENCH_RUNS", "5"))
    spark = get_session(
        "popledger-bench", master=f"local[{cpus}]", shuffle_partitions=int(cpus) if cpus.isdigit() else 8,
        extra={"spark.driver.memory": "16g", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    timings: dict[str, float] = {}
    only = sys.argv[1:]
    for name in only or HEADLINE:
        taken = []
        for _ in range(1 + runs):
            start = time.perf_counter()
            QUERIES[name](spark, path).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - start)
            release(spark)
        taken = taken[1:]
        timings[name] = round(statistics.median(taken), 3)
        print(name, timings[name], file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "headline_total_seconds", "value": round(sum(timings.values()), 3), "unit": "sec", "queries": timings,
        "sf": os.path.basename(path.rstrip("/")), "cpus": cpus, "runs": runs,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
