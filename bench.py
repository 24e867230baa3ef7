"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) names the tables, BENCH_CPUS the
number of local threads. The list runs once untimed, then BENCH_RUNS
(default 2) times; the best full evaluation of each query counts.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))

HEADLINE = [
    "salary_distribution",
    "salary_distribution_fan_out",
    "review_trend",
    "performance_trends",
    "top_performers",
    "attrition_risk",
    "risk_summary",
    "fact_snapshot",
    "fct_employee_snapshot",
    "monthly_snapshot",
    "close_history",
    "surrogate_keys",
    "uniquify",
    "distinct_pairs",
    "scd2_merge",
    "dim_employee",
    "dim_departments_headcount",
    "dim_date",
    "extract_assignments",
    "leave_patterns",
    "dq_unique",
    "dq_foreign_key",
    "warehouse_build",
]


def main() -> None:
    from workload import QUERIES

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    names = sys.argv[1:] or HEADLINE
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("tenura-bench")
        .config("spark.sql.shuffle.partitions", cpus if cpus.isdigit() else "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    times = {name: [] for name in names}
    for _ in range(runs + 1):
        for name in names:
            started = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times[name].append(time.perf_counter() - started)
    seconds = {name: round(min(measured[1:]), 3) for name, measured in times.items()}
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(sf_dir).name.removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
