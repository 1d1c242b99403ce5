"""Wall time of the headline queries, warm, median of three.

``BENCH_SF_DIR`` names the tables (default sf0.1), ``BENCH_CPUS`` the local cores.
Prints one JSON line.  ``python bench.py name ...`` runs only these queries.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import SparkSession

from querybook import QUERIES

HEADLINES = [
    "hist_union",
    "hist_comparison_calendar",
    "win_prev_month",
    "win_balance_propagation",
    "win_values_as_of",
    "win_variation_kpis",
    "state_prev_observed",
    "latest_row_per_key",
    "latest_group_max",
    "total_by_group_sums",
    "flags_rollup",
    "events_by_period",
    "business_day_previous",
    "money_convert_by_day",
    "flow_monthly_balance_dense",
    "position_value",
    "objective_seasonal_split",
    "shape_star",
    "plan_customer_status",
    "plan_balance_fact",
    "plan_activity_score",
]
RUNS = 3


def session(cpus: int) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def timed(spark: SparkSession, sf_dir: str, name: str) -> float:
    began = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - began


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", os.cpu_count() or 8))
    spark = session(cpus)
    times = {}
    for name in sys.argv[1:] or HEADLINES:
        timed(spark, sf_dir, name)
        runs = [timed(spark, sf_dir, name) for _ in range(RUNS)]
        times[name] = round(statistics.median(runs), 4)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_warm_median_of_3",
                "value": round(sum(times.values()), 4),
                "unit": "sec",
                "queries": times,
                "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
                "cpus": cpus,
            }
        )
    )


if __name__ == "__main__":
    main()
