"""How unevenly items are spread over entities (listings over hosts).

Entities of one size are interchangeable, so the curve is built from the number of entities per
size. A parent with a billion hosts then has some thousand size classes, and no task ever orders the
hosts themselves.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import numeric

# Shares of hosts at which the curve is read.
SHARE_POINTS = (0.01, 0.05, 0.10, 0.20, 0.50, 1.00)


def size_classes(df: DataFrame, parent: str, entity: str, item: str) -> DataFrame:
    """Per parent and entity size: entities and items of the class and of all larger classes."""
    classes = (
        df.groupBy(parent, entity)
        .agg(F.count(item).alias("size"))
        .groupBy(parent, "size")
        .agg(F.count("*").alias("n"), F.count(entity).alias("named"))
    )
    larger = (
        Window.partitionBy(parent).orderBy(F.col("size").desc()).rowsBetween(Window.unboundedPreceding, -1)
    )
    whole = Window.partitionBy(parent)
    items = F.col("n") * F.col("size")
    return classes.select(
        parent,
        "size",
        "n",
        F.coalesce(F.sum("n").over(larger), F.lit(0)).alias("n_before"),
        F.coalesce(F.sum(items).over(larger), F.lit(0)).alias("items_before"),
        F.sum("named").over(whole).alias("total_entities"),
        F.sum(items).over(whole).alias("total_items"),
    )


def at_rank(classes: DataFrame, rank: Column) -> DataFrame:
    """Items held by the ``rank`` largest entities, from the class in which the rank falls."""
    inside = (F.col("k") > F.col("n_before")) & (F.col("k") <= F.col("n_before") + F.col("n"))
    held = F.col("items_before") + (F.col("k") - F.col("n_before")) * F.col("size")
    return classes.withColumn("k", rank).where(inside).withColumn("held", held)


def pareto(
    df: DataFrame,
    parent: str = "city",
    entity: str = "host_id",
    item: str = "id",
    points: Sequence[float] = SHARE_POINTS,
) -> DataFrame:
    """Largest share of items held by at most the given shares of entities.

    A parent with too few entities for a point has no row for it.
    """
    classes = size_classes(df, parent, entity, item).withColumn(
        "host_share", F.explode(F.array(*[F.lit(float(p)) for p in points]))
    )
    point, total = F.col("host_share"), F.col("total_entities")
    # The largest rank whose quotient does not exceed the point, by the same division that compares.
    near = F.floor(point * total)
    rank = (
        F.when(numeric.ratio(near + 1, total) <= point, near + 1)
        .when(numeric.ratio(near, total) > point, near - 1)
        .otherwise(near)
    )
    return (
        at_rank(classes, rank)
        .select(parent, "host_share", numeric.ratio("held", "total_items").alias("listings_share"))
        .orderBy(parent, "host_share")
    )


def pareto_curve(df: DataFrame, parent: str = "city", **options) -> DataFrame:
    """The same curve starting at the origin."""
    curve = pareto(df, parent, **options)
    origin = curve.select(parent).distinct().select(parent, F.lit(0.0).alias("host_share"), F.lit(0.0).alias("listings_share"))
    return origin.unionByName(curve).orderBy(parent, "host_share")


def top_share_by_head(
    df: DataFrame, parent: str = "city", entity: str = "host_id", item: str = "id", share: float = 0.10
) -> DataFrame:
    """Items held by the top share of entities, counted in whole entities and at least one."""
    classes = size_classes(df, parent, entity, item)
    n_entities = F.sum("n").over(Window.partitionBy(parent))
    rank = F.greatest(F.lit(1), F.ceil(F.col("entities") * F.lit(share)))
    return (
        at_rank(classes.withColumn("entities", n_entities), rank)
        .select(
            parent,
            F.col("entities").alias("total_hosts"),
            F.col("k").alias("top_hosts"),
            F.col("held").alias("listings_by_top"),
            F.round(numeric.percent("held", "total_items"), 1).alias("pct_of_total_listings"),
        )
        .orderBy(parent)
    )
