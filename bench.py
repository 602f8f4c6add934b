"""Time the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

``python bench.py all`` times every query.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pulsegrid.plans import QUERIES
from pulsegrid.session import build_session

HEADLINE = [
    "time_distribution_count",
    "time_distribution_amount",
    "distribution_report_count",
    "message_bytes",
    "condition_filter",
    "or_filter",
    "kpi_panel",
    "order_statistics",
    "median_by_brand",
    "bucketed_median",
    "rank_by_count",
    "rank_by_sum",
    "filtered_rank_report",
    "filter_lattice_totals",
    "filter_lattice_rankings",
    "top_words",
    "listed_words",
    "inner_join",
    "cogroup",
    "subtract_keeping_duplicates",
    "top_per_group",
    "power_summary",
    "power_by_month",
    "appliance_usage",
    "minute_profile",
    "degrees",
    "oldest_follower",
    "average_precision",
    "key_range_scan",
    "stream_running_counts",
    "stream_sliding_totals",
    "stream_window_median",
    "classifier_holdout",
    "als_recommendations",
    "kmeans_nearest_members",
]


def timed(spark, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - start, 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("bench", f"local[{cpus}]", spark__sql__shuffle__partitions=cpus, spark__driver__memory="12g")
    spark.sparkContext.setLogLevel("OFF")
    names = list(QUERIES) if "all" in sys.argv[1:] else HEADLINE
    timed(spark, "message_count", sf_dir)  # starts the executors and reads the footers once
    seconds = {name: timed(spark, name, sf_dir) for name in names}
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
