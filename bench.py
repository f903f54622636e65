"""Headline queries, timed: one warm-up each, then the median of three runs.

Prints one JSON line. ``BENCH_SF_DIR`` names the folder, ``BENCH_CPUS`` the
local cores, ``BENCH_QUERIES`` (optional) a comma-separated choice.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from granary import session  # noqa: E402
from granary.catalogue import QUERIES  # noqa: E402

HEADLINE = (
    "facts_sales monthly_sales top_products vip_customers category_performance daily_sales "
    "executive_summary monthly_sales_by_order vip_customers_by_order "
    "category_performance_by_subtotal dim_products dim_customers dim_date incremental_sales "
    "upsert_facts dedup_latest outliers_iqr clean_text rfm_segments sales_by_period sales_trend "
    "rank_in_category regional_rollup financials"
).split()
RUNS = 3


def run_once(query, spark, folder: str) -> float:
    start = time.perf_counter()
    query(spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    chosen = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q] or HEADLINE
    quiet = {"spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "8g"}
    spark = session.create("granary bench", f"local[{cpus}]", int(cpus), quiet)
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in chosen:
        run_once(QUERIES[name], spark, folder)
        runs = [run_once(QUERIES[name], spark, folder) for _ in range(RUNS)]
        seconds[name] = round(statistics.median(runs), 3)
    spark.stop()
    line = {
        "metric": "sum of median query times",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": Path(folder).name.removeprefix("sf"),
        "cpus": int(cpus),
    }
    print(json.dumps(line))


if __name__ == "__main__":
    main()
