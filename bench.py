"""Time the headline queries; prints one JSON line.

    BENCH_SF_DIR   data folder           (default /root/testdata/sf0.1)
    BENCH_CPUS     local executor threads (default: all cores)
    BENCH_RUNS     timed runs per query, after one warm-up (default 3, the median counts)
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from stratamart.queries import REGISTRY
from stratamart.session import build_session

HEADLINES = [
    "Q1_customer_360", "Q2_product_performance", "Q3_revenue_daily", "Q4_order_fulfillment",
    "Q5_executive_kpis", "Q6_customer_segments", "Q7_category_performance", "Q8_fulfillment_sla",
    "W1_latest_line", "D1_column_profile", "D9_partition_stats", "D13_constraint_report",
    "D19_job_summary", "G3_trace", "G5_usage_lineage", "P13_token_table", "T3_stream_refresh",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS") or os.cpu_count() or 8)
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = sys.argv[1:] or HEADLINES
    spark = build_session("bench", f"local[{cpus}]", cpus, **{"spark.driver.memory": "16g",
                                                              "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in names:
        took = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            REGISTRY[name].run(spark, sf_dir).write.format("noop").mode("overwrite").save()
            took.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(took[1:]), 3)
    print(json.dumps({"metric": "total seconds over the headline queries, median of warm runs",
                      "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds,
                      "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"), "cpus": cpus}))
    spark.stop()


if __name__ == "__main__":
    main()
