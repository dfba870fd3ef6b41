"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the folder of tables, ``BENCH_CPUS`` the local cores, ``BENCH_RUNS`` the runs per
query. The reported time of a query is the median of its runs in one session with the cache cleared
between runs; the first, cold run is one of them.
"""

import json
import os
import statistics
import time
from pathlib import Path

from pyspark.sql import SparkSession

from rentlens.catalog import ENTRIES

HEADLINE = [
    "w1_seasonality",
    "w2_train_rf",
    "w3_review_demand",
    "w4_calendar_revenue",
    "w5_full_pipeline",
    "q01_top_bottom",
    "q02_seasonality",
    "q04_host_type",
    "q05_pareto",
    "q07_top_revenue",
    "q09_yoy",
    "q11_municipality",
    "boxplot_stats",
    "dedupe_by_key",
    "apply_encoding",
]


def run_once(spark: SparkSession, name: str, folder: str) -> float:
    spark.catalog.clearCache()
    start = time.perf_counter()
    ENTRIES[name].run(spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("rentlens-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    times = {name: statistics.median(run_once(spark, name, folder) for _ in range(runs)) for name in HEADLINE}
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 4),
                "unit": "sec",
                "queries": {name: round(seconds, 4) for name, seconds in times.items()},
                "sf": Path(folder).name.removeprefix("sf"),
                "runs": runs,
            }
        )
    )


if __name__ == "__main__":
    main()
