"""Scaling of timed workloads over the number of workers."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import numeric
from ..operators.distributions import with_quantiles


def run_statistics(runs: DataFrame, by: Sequence[str] = ("workload", "workers"), value: str = "wall_secs") -> DataFrame:
    """Runs, median, fastest and slowest time per configuration."""
    known = runs.where(F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double")))
    measures = [F.count("*").alias("n"), F.min(value).alias("min_wall_secs"), F.max(value).alias("max_wall_secs")]
    stats = with_quantiles(known, by, measures, value, {"median_wall_secs": 0.5}, method="linear")
    columns = ("median_wall_secs", "min_wall_secs", "max_wall_secs")
    return stats.select(*by, F.col("n").alias("runs"), *[F.round(F.col(c).cast("double"), 4).alias(c) for c in columns])


def _against(stats: DataFrame, baseline: Column, workers: str) -> DataFrame:
    speedup = F.round(numeric.ratio(baseline, "median_wall_secs"), 4)
    return stats.withColumns(
        {"speedup": speedup, "efficiency": F.round(numeric.ratio(numeric.ratio(baseline, "median_wall_secs"), workers), 4)}
    )


def scaling_summary(runs: DataFrame) -> DataFrame:
    """Speed-up and efficiency against the one-worker run of the workload, empty where there is none."""
    stats = run_statistics(runs)
    one_worker = F.max(F.when(F.col("workers") == 1, F.col("median_wall_secs")))
    baseline = one_worker.over(Window.partitionBy("workload"))
    out = _against(stats.withColumn("baseline", F.nullif(baseline, F.lit(0.0))), F.col("baseline"), "workers")
    return out.drop("baseline").orderBy("workload", "workers")


def scaling_from_smallest(
    runs: DataFrame, series: str = "platform", size: str = "parallelism", value: str = "wall_secs"
) -> DataFrame:
    """The same against the smallest size measured in each series."""
    stats = run_statistics(runs, (series, size), value)
    baseline = F.min_by("median_wall_secs", size).over(Window.partitionBy(series))
    return _against(stats.withColumn("baseline", baseline), F.col("baseline"), size).drop("baseline").orderBy(series, size)


def fastest_configuration(summary: DataFrame) -> DataFrame:
    """Fastest size of each workload, the smaller one among equals."""
    best = F.min(F.struct("median_wall_secs", "workers"))
    return (
        summary.groupBy("workload")
        .agg(best.alias("best"))
        .select(
            "workload",
            F.concat(F.col("best.workers").cast("string"), F.lit(" workers")).alias("best_config"),
            F.col("best.median_wall_secs").alias("median_wall_secs"),
        )
    )


def wide_by_workers(summary: DataFrame, workloads: Sequence[str], value: str = "median_wall_secs") -> DataFrame:
    """Workers by workload."""
    return summary.groupBy("workers").pivot("workload", list(workloads)).agg(F.first(value)).orderBy("workers")
