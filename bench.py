"""Time the headline queries and print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) names the tables, BENCH_CPUS the
number of local threads. A query's time includes planning, any lookups it makes
while planning, and writing every result column to the no-op sink; it is the
best of BENCH_RUNS runs (default 2), after one short warm-up of the session.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import SparkSession  # noqa: E402

from workload.queries import QUERIES  # noqa: E402

HEADLINE = (
    "panel_user_day",
    "combo_ratio",
    "trailing_stats",
    "trailing_stats_rolling",
    "trailing_stats_events",
    "trailing_many_windows",
    "period_ratio_rolling",
    "streak_above_rolling",
    "streak_increasing_months",
    "loc_bins_rolling",
    "val_bins_rolling",
    "category_share_rolling",
    "presence_pattern_months",
    "numeric_profile_lineitem",
    "range_profile_lineitem",
    "category_profile_lineitem",
    "pick_extreme_rows",
    "keyword_match_text",
    "worst_status_summary",
    "discover_features",
    "discover_rolling",
    "replay_features",
    "online_requests",
    "data_check",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    chosen = os.environ.get("BENCH_QUERIES")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="bench-checkpoint-"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["panel_filter"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times = {}
    for name in chosen.split(",") if chosen else HEADLINE:
        best = None
        for _ in range(runs):
            started = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            spent = time.perf_counter() - started
            best = spent if best is None else min(best, spent)
        times[name] = round(best, 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": Path(sf_dir).name,
            }
        )
    )


if __name__ == "__main__":
    main()
