"""Value distributions: exact quantiles, histograms, box plots, threshold counts."""

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import numeric
from .order_statistics import ValueCounts, same_group


def value_counts(df: DataFrame, value: str, by: Sequence[str] = ()) -> DataFrame:
    """Rows per distinct known value; all further work on values runs on this reduced table."""
    return df.where(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count("*").alias("n"))


def join_groups(left: DataFrame, right: DataFrame, by: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on groups, the NULL group included; the columns of the left side, then those that the right adds."""
    added = [c for c in right.columns if c not in by]
    joined = left.alias("l").join(right.alias("r"), same_group("l", "r", list(by)), how)
    return joined.select("l.*", *[F.col(f"r.`{c}`") for c in added])


def exact_quantiles(
    df: DataFrame,
    value: str,
    points: Mapping[str, float],
    by: Sequence[str] = (),
    method: str = "linear",
) -> DataFrame:
    """Exact quantiles per group, one column per named point, plus the group's size ``n``; see ``order_statistics``."""
    return ValueCounts(df, value, by).summary(points, method)


def merge_groups(by: Sequence[str], *tables: DataFrame) -> DataFrame:
    """Put summaries of the same groups side by side. Groups whose key is NULL match each other."""
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)
    return stacked.groupBy(*by).agg(*[F.max(c).alias(c) for c in stacked.columns if c not in by])


def with_quantiles(
    df: DataFrame,
    by: Sequence[str],
    measures: Sequence[Column],
    value: str,
    points: Mapping[str, float],
    sketch: int | None = None,
    method: str = "lower",
    distinct: Mapping[str, str] | None = None,
) -> DataFrame:
    """Aggregates of each group beside quantiles of a value (lower ones: values that occur) and numbers of different values of
    other columns (``distinct``: name and column).

    Exact, unless ``sketch`` asks for one-pass sketches of that accuracy. Either way the source is read once.
    """
    if sketch is not None:
        counts = [F.count_distinct(c).alias(name) for name, c in (distinct or {}).items()]
        table = df.groupBy(*by).agg(*measures, *counts, numeric.sketch_quantiles(value, list(points.values()), sketch).alias("q"))
        return table.withColumns({name: F.col("q")[i] for i, name in enumerate(points)}).drop("q")
    kind = df.schema[value].dataType if method == "lower" else "double"
    asked = list(measures) or [F.count("*").alias("_rows")]
    table = ValueCounts(df, value, by, asked, distinct).summary(points, method, "_known").drop("_known", "_rows")
    return table.withColumns({name: F.col(name).cast(kind) for name in points})


def medians(df: DataFrame, by: Sequence[str], value: str = "price") -> DataFrame:
    """Exact interpolated median and size per group."""
    return exact_quantiles(df, value, {f"median_{value}": 0.5}, by)


def sketch_table(
    df: DataFrame,
    value: str = "price",
    points: Mapping[str, float] | None = None,
    by: Sequence[str] = ("city",),
    digits: int = 2,
    sketch: int | None = None,
) -> DataFrame:
    """Several quantiles, one column each."""
    # The quantiles of the standard price table.
    points = points or {"q25": 0.25, "median_q50": 0.5, "q75": 0.75, "q90": 0.9, "q95": 0.95, "q99": 0.99}
    table = with_quantiles(df, by, [], value, points, sketch)
    return table.select(*by, *[F.round(name, digits).alias(name) for name in points]).orderBy(*by)


def quartile_stats(
    df: DataFrame, value: str, by: Sequence[str] = ("city",), digits: int = 1, sketch: int | None = None
) -> DataFrame:
    """Rounded mean, median and quartiles."""
    points = {"median": 0.5, "q1": 0.25, "q3": 0.75}
    table = with_quantiles(df, by, [F.round(numeric.exact_avg(value), digits).alias("mean")], value, points, sketch)
    return table.select(*by, "mean", *[F.round(name, digits).alias(name) for name in points]).orderBy(*by)


def price_summary(
    df: DataFrame,
    value: str = "price",
    by: Sequence[str] = ("city",),
    below: float | None = 2000,
    sketch: int | None = None,
) -> DataFrame:
    """Size, mean, extremes, deviation and percentiles of the values in (0, below)."""
    # The percentiles of the summary.
    points = {"p25": 0.25, "median": 0.5, "p75": 0.75, "p90": 0.9, "p95": 0.95, "p99": 0.99}
    valid = F.col(value) > 0
    if below is not None:
        valid = valid & (F.col(value) < below)
    measures = [
        F.count("*").alias("n"),
        F.round(numeric.exact_avg(value), 2).alias("avg"),
        F.round(F.min(value), 2).alias("min"),
        F.round(F.max(value), 2).alias("max"),
        F.round(F.stddev_samp(value), 2).alias("std"),
    ]
    table = with_quantiles(df.where(valid), by, measures, value, points, sketch)
    return table.withColumns({name: F.round(name, 2) for name in points}).orderBy(*by)


def price_by_category(
    df: DataFrame,
    by: Sequence[str] = ("city", "room_type"),
    value: str = "price",
    below: float = 2000,
    sketch: int | None = None,
) -> DataFrame:
    """Mean, median and size per category over values in (0, below)."""
    rows = df.where((F.col(value) > 0) & (F.col(value) < below))
    measures = [F.round(numeric.exact_avg(value), 2).alias("avg_price"), F.count("*").alias("n")]
    table = with_quantiles(rows, by, measures, value, {"median_price": 0.5}, sketch)
    table = table.select(*by, "avg_price", F.round("median_price", 2).alias("median_price"), "n")
    return table.orderBy(by[0], F.col("median_price").desc(), *by[1:])


def thresholds_wide(
    df: DataFrame,
    by: Sequence[str] = ("city", "room_type"),
    value: str = "price",
    thresholds: Sequence[float] = (100, 250, 500),
    key: str = "id",
    sketch: int | None = None,
) -> DataFrame:
    """Values above each threshold per group, counted and as a share, with median and maximum."""
    measures = [
        F.count(key).alias("n_listings"),
        F.max(value).alias("max_price"),
        *[F.sum((F.col(value) > t).cast("int")).alias(f"n_above_{t}") for t in thresholds],
    ]
    stats = with_quantiles(df, by, measures, value, {"median_price": 0.5}, sketch)
    stats = stats.select(*by, "n_listings", "median_price", "max_price", *[f"n_above_{t}" for t in thresholds])
    shares = {f"pct_above_{t}": numeric.ratio(f"n_above_{t}", "n_listings") for t in thresholds}
    return stats.withColumns(shares).orderBy(*by)


def thresholds_long(
    df: DataFrame, thresholds: Sequence[float], by: Sequence[str] = ("city",), value: str = "price", below: float | None = None
) -> DataFrame:
    """One row per group and threshold with values above it. Without groups every threshold has its
    row, with groups only those that are exceeded."""
    valid = F.col(value) > 0
    if below is not None:
        valid = valid & (F.col(value) < below)
    counts = df.where(valid).groupBy(*by).agg(
        F.count("*").alias("total"),
        F.array(
            *[
                F.struct(F.lit(t).alias("threshold"), F.count_if(F.col(value) > t).alias("outlier_count"))
                for t in thresholds
            ]
        ).alias("above"),
    )
    out = counts.select(*by, "total", F.inline("above"))
    if by:
        out = out.where(F.col("outlier_count") > 0)
    pct = F.round(numeric.percent("outlier_count", "total"), 2)
    return out.withColumn("percentage", pct).orderBy("threshold", *by)


def histogram(
    df: DataFrame,
    value: str = "price",
    by: Sequence[str] = ("city",),
    bins: int = 55,
    above: float = 0,
    below: float = 500,
    density: bool = False,
) -> DataFrame:
    """Equal-width bins between the smallest and largest value of each group, empty bins left out.

    Only values inside (above, below) count. The last bin includes its upper edge. Values are counted
    before they are matched with their group's range, so the match moves distinct values only.
    """
    counts = value_counts(df.where((F.col(value) > above) & (F.col(value) < below)), value, by)
    ranges = counts.groupBy(*by).agg(F.min(value).alias("low"), F.max(value).alias("high"), F.sum("n").alias("total"))
    if by:
        joined = join_groups(counts, ranges, by)
    else:
        whole = ranges.select(F.struct("low", "high", "total")).scalar()
        joined = counts.withColumns({c: whole[c] for c in ("low", "high", "total")})
    width = (F.col("high") - F.col("low")) / F.lit(float(bins))
    place = F.least(F.floor(F.try_divide(F.col(value) - F.col("low"), width)), F.lit(bins - 1))
    out = (
        joined.withColumn("bin", F.coalesce(place, F.lit(0)).cast("int"))
        .groupBy(*by, "bin")
        .agg(F.sum("n").alias("n"), F.first(width).alias("width"), F.first("low").alias("low"), F.first("total").alias("total"))
    )
    columns = [*by, "bin", (F.col("low") + F.col("bin") * F.col("width")).alias("left_edge"), "n"]
    if density:
        columns.append(F.try_divide(F.col("n").cast("double"), F.col("total") * F.col("width")).alias("density"))
    return out.select(*columns)


def rounded_histogram(df: DataFrame, value: str = "price", power: int = 1, k: int = 40) -> DataFrame:
    """Counts by value rounded half-even to a power of ten, the k lowest levels."""
    return (
        df.where(F.col(value).isNotNull())
        .groupBy(F.bround(value, -power).alias("level"))
        .agg(F.count("*").alias("n"))
        .orderBy("level")
        .limit(k)
    )


def boxplot(
    df: DataFrame, value: str = "price", by: Sequence[str] = ("city",), reach: float = 1.5
) -> DataFrame:
    """Quartiles, whiskers at the last values within ``reach`` quartile distances, values beyond."""
    counted = ValueCounts(df, value, by)
    quartiles = counted.summary({"q1": 0.25, "median": 0.5, "q3": 0.75})
    span = F.lit(float(reach)) * (F.col("q3") - F.col("q1"))
    v = F.col("_v")
    inside = v.between(F.col("q1") - span, F.col("q3") + span)
    joined = join_groups(counted.values().withColumnRenamed("_n", "copies"), quartiles, by)
    stats = joined.groupBy(*by, "n", "q1", "median", "q3").agg(
        F.min(F.when(inside, v)).alias("low"),
        F.max(F.when(inside, v)).alias("high"),
        F.sum(F.when(~inside, F.col("copies")).otherwise(F.lit(0))).alias("n_fliers"),
    )
    return stats.select(
        *by,
        "n",
        "q1",
        "median",
        "q3",
        # A whisker never ends inside the box.
        F.least("low", "q1").alias("whisker_low"),
        F.greatest("high", "q3").alias("whisker_high"),
        "n_fliers",
    )


def quartile_bucket(df: DataFrame, value: str = "price", cap: float | None = None) -> DataFrame:
    """Label every row by the quartile of the selection it falls in; rows above twice the cap go first."""
    rows = df if cap is None else df.where(F.col(value) <= 2 * cap)
    edges = exact_quantiles(rows, value, {"q1": 0.25, "q2": 0.5, "q3": 0.75})
    edge = edges.select(F.struct("q1", "q2", "q3")).scalar()
    label = (
        F.when(F.col(value) <= edge["q1"], "lowest")
        .when(F.col(value) <= edge["q2"], "second")
        .when(F.col(value) <= edge["q3"], "third")
        .otherwise("highest")
    )
    return rows.withColumn("quartile", label)


def hash_sample(df: DataFrame, key: str = "id", percent: int = 5, seed: int = 42) -> DataFrame:
    """The same rows on every run: those whose key falls in the sampled buckets."""
    return df.where(numeric.hash_bucket(key, seed=seed) < percent)


def exact_sample(df: DataFrame, k: int, by: Sequence[str] = ("city",), key: str = "id", seed: int = 42) -> DataFrame:
    """min(k, size) rows of each group: those with the smallest hash of their key, the same under any layout.

    Rows of one key count singly, in no order between them. For k up to Spark's limit for partial ranks (1000) every task
    keeps the first k rows of a group before rows are shuffled, so a group sends at most k rows per task.
    """
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.col(f"`{key}`").cast("string")))
    place = Window.partitionBy(*by).orderBy(digest.asc_nulls_last(), F.col(f"`{key}`"))
    return df.withColumn("_place", F.row_number().over(place)).where(F.col("_place") <= k).drop("_place")
