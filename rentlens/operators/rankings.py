"""Groups compared and ranked within a parent.

Every window here runs over group summaries, whose number is bounded by the dimension, never over
fact rows.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import numeric
from .distributions import with_quantiles


def keep_first(df: DataFrame, parent: Sequence[str], order: Sequence[Column], k: int, rank="rank") -> DataFrame:
    """The first k rows of each parent, numbered."""
    window = Window.partitionBy(*parent).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(window)).where(F.col(rank) <= k)


def top_bottom(
    df: DataFrame,
    parent: str = "city",
    group: Sequence[str] = ("neighbourhood_group", "neighbourhood"),
    value: str = "price",
    key: str = "id",
    k: int = 10,
    min_n: int = 10,
    sketch: int | None = None,
) -> DataFrame:
    """The k groups with the highest and the k with the lowest median per parent.

    Both ranks come from one pass; a group that is in both lists has a row in each. Equal medians
    rank by group name.
    """
    by = [parent, *group]
    measures = [numeric.exact_avg(value).alias("mean_price"), F.count(key).alias("n_listings")]
    stats = with_quantiles(df, by, measures, value, {"median_price": 0.5}, sketch)
    stats = stats.where(F.col("n_listings") >= min_n).select(*by, "median_price", "mean_price", "n_listings")
    names = [F.col(g).asc() for g in group]
    down = Window.partitionBy(parent).orderBy(F.col("median_price").desc(), *names)
    up = Window.partitionBy(parent).orderBy(F.col("median_price").asc(), *names)
    places = F.array(
        F.struct(F.lit("top").alias("bucket"), F.row_number().over(down).alias("rank")),
        F.struct(F.lit("bottom").alias("bucket"), F.row_number().over(up).alias("rank")),
    )
    return (
        stats.withColumn("places", places)
        .select(*stats.columns, F.inline("places"))
        .where(F.col("rank") <= k)
        .orderBy(parent, "bucket", "rank")
    )


def top_by_total(
    df: DataFrame,
    parent: str = "city",
    group: Sequence[str] = ("neighbourhood_group", "neighbourhood"),
    value: str = "estimated_revenue_365",
    price: str = "price",
    key: str = "id",
    k: int = 10,
    sketch: int | None = None,
) -> DataFrame:
    """The k groups with the largest total of a value per parent."""
    measures = [
        numeric.exact_sum(value).alias("total_estimated_revenue"),
        numeric.exact_avg(value).alias("avg_estimated_revenue"),
        F.count(key).alias("n_listings"),
    ]
    stats = with_quantiles(df.where(F.col(value).isNotNull()), [parent, *group], measures, price, {"median_price": 0.5}, sketch)
    order = [F.col("total_estimated_revenue").desc(), *[F.col(g).asc() for g in group]]
    return keep_first(stats, [parent], order, k).orderBy(parent, "rank")


def top_mean(
    df: DataFrame,
    parent: str = "city",
    group: str = "neighbourhood",
    value: str = "price",
    below: float = 2000,
    min_n: int = 30,
    k: int = 10,
) -> DataFrame:
    """The k groups with the highest mean among those of some size, over values in (0, below)."""
    stats = (
        df.where((F.col(value) > 0) & (F.col(value) < below))
        .groupBy(parent, group)
        .agg(F.round(numeric.exact_avg(value), 2).alias("avg_price"), F.count("*").alias("n"))
        .where(F.col("n") >= min_n)
    )
    return keep_first(stats, [parent], [F.col("avg_price").desc(), F.col(group).asc()], k)


def share_of_parent(
    df: DataFrame,
    parent: str = "city",
    group: str = "room_type",
    key: str | None = "id",
    n_name: str = "n_listings",
    scale: float = 1.0,
) -> DataFrame:
    """Size of each group and its share of the parent."""
    whole = Window.partitionBy(parent)
    return (
        df.groupBy(parent, group)
        .agg((F.count(key) if key else F.count("*")).alias(n_name))
        .withColumn("share", numeric.ratio(F.lit(scale) * F.col(n_name), F.sum(n_name).over(whole)))
        .orderBy(F.col(parent), F.col("share").desc(), F.col(group))
    )


def top_share(
    df: DataFrame, parent: str = "city", group: str = "neighbourhood", k: int = 6, label: Column | None = None
) -> DataFrame:
    """The k largest groups of each parent with their percentage of it."""
    shares = share_of_parent(df, parent, group, None, "n", 100.0)
    out = keep_first(shares, [parent], [F.col("n").desc(), F.col(group).asc()], k)
    return out if label is None else out.withColumn("label", label)


def group_with_fallback(
    df: DataFrame,
    parent: str = "city",
    level_1: str = "neighbourhood_group",
    level_2: str = "neighbourhood",
    k: int = 15,
) -> DataFrame:
    """Rows per level-1 group; a parent that names none lists its k largest level-2 groups instead."""
    named = F.nullif(F.col(level_1), F.lit(""))
    counts = df.groupBy(parent, named.alias("l1"), F.col(level_2).alias("l2")).agg(F.count("*").alias("n"))
    uses_level_1 = F.max(F.col("l1").isNotNull()).over(Window.partitionBy(parent))
    labelled = (
        counts.withColumn("by_level_1", uses_level_1)
        .where(~F.col("by_level_1") | F.col("l1").isNotNull())
        .groupBy(parent, "by_level_1", F.when(F.col("by_level_1"), F.col("l1")).otherwise(F.col("l2")).alias("label"))
        .agg(F.sum("n").alias("n"))
    )
    largest = Window.partitionBy(parent).orderBy(F.col("n").desc(), F.col("label").asc())
    return (
        labelled.withColumn("rank", F.row_number().over(largest))
        .where(F.col("by_level_1") | (F.col("rank") <= k))
        .select(parent, F.when(F.col("by_level_1"), 1).otherwise(2).alias("level"), "label", "n", "rank")
    )


def mean_by_group_top(df: DataFrame, group: str, metric: str, k: int = 20) -> DataFrame:
    """Mean of a metric per group, the k highest first."""
    return (
        df.groupBy(group)
        .agg(numeric.exact_avg(metric).alias(f"mean_{metric}"))
        .orderBy(F.col(f"mean_{metric}").desc_nulls_last(), F.col(group).asc())
        .limit(k)
    )


def corr_by_group(
    df: DataFrame,
    x: str = "reviews_per_month",
    y: str = "price",
    by: Sequence[str] = ("city", "neighbourhood_group", "neighbourhood"),
    key: str = "id",
    min_n: int = 20,
) -> DataFrame:
    """Correlation per group of some size, strongest first; NULL for groups without variation."""
    return (
        df.where(F.col(x).isNotNull())
        .groupBy(*by)
        .agg(numeric.guarded_corr(x, y).alias("corr"), F.count(key).alias("n_listings"))
        .where(F.col("n_listings") >= min_n)
        .orderBy(F.col("corr").desc_nulls_last(), *by)
    )
