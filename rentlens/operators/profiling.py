"""Table profiles and per-parent summaries."""

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import numeric
from .distributions import join_groups, with_quantiles
from .trends import dominant


def dataset_overview(tables: Mapping[str, DataFrame], parent: str = "city") -> DataFrame:
    """Rows of each table and parent, the parent's share of the table and the table's width."""

    def counts(name: str, df: DataFrame) -> DataFrame:
        per_parent = df.groupBy(parent).agg(F.count("*").alias("rows")).withColumn("dataset", F.lit(name))
        return per_parent.withColumn("columns", F.lit(len(df.columns)))

    stacked = reduce(DataFrame.unionByName, [counts(n, d) for n, d in tables.items()])
    totals = stacked.groupBy("dataset").agg(F.sum("rows").alias("total_rows"))
    return (
        stacked.join(totals, "dataset")
        .withColumn("pct", F.round(numeric.percent("rows", "total_rows"), 1))
        .orderBy("dataset", parent)
    )


def missing_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """NULL or empty values per column, worst first; complete columns are left out. One pass."""
    columns = list(columns or df.columns)
    empty = [F.count_if(F.col(c).isNull() | (F.col(c).cast("string") == "")) for c in columns]
    counts = df.agg(
        F.count("*").alias("total"),
        F.array(
            *[F.struct(F.lit(c).alias("column"), e.alias("missing")) for c, e in zip(columns, empty, strict=True)]
        ).alias("profile"),
    )
    return (
        counts.select("total", F.inline("profile"))
        .where(F.col("missing") > 0)
        .select("column", "missing", F.round(numeric.percent("missing", "total"), 1).alias("pct"))
        .orderBy(F.col("missing").desc(), "column")
    )


def value_distribution(df: DataFrame, column: str, by: Sequence[str] = ()) -> DataFrame:
    """Rows per value of a discrete column."""
    return df.where(F.col(column).isNotNull()).groupBy(*by, column).agg(F.count("*").alias("n")).orderBy(*by, column)


def date_range(df: DataFrame, date: str = "date") -> DataFrame:
    return df.agg(F.min(date).alias("start_date"), F.max(date).alias("end_date"))


def activity_overview(
    df: DataFrame, parent: str = "city", item: str = "listing_id", actor: str = "reviewer_id", date: str = "date"
) -> DataFrame:
    """Volume, distinct items and actors, first and last day of an activity table.

    Rows are reduced to one per item, and to one per actor, before these are counted.
    """
    per_item = df.groupBy(parent, item).agg(
        F.count("*").alias("rows"), F.min(date).alias("first"), F.max(date).alias("last")
    )
    items = per_item.groupBy(parent).agg(
        F.sum("rows").alias("total_reviews"),
        F.count(item).alias("reviewed_listings"),
        F.min("first").alias("first_review"),
        F.max("last").alias("last_review"),
    )
    actors = df.select(parent, actor).distinct().groupBy(parent).agg(F.count(actor).alias("unique_reviewers"))
    out = join_groups(items, actors, [parent])
    return out.select(parent, "total_reviews", "reviewed_listings", "unique_reviewers", "first_review", "last_review").orderBy(parent)


def rounded_means(
    df: DataFrame, means: Mapping[str, tuple[str, int]], parent: str = "city"
) -> DataFrame:
    """Size of each parent and rounded means; ``means`` maps the result name to column and digits."""
    return (
        df.groupBy(parent)
        .agg(
            F.count("*").alias("total_listings"),
            *[F.round(numeric.exact_avg(c), d).alias(name) for name, (c, d) in means.items()],
        )
        .orderBy(parent)
    )


def category_rates(
    df: DataFrame,
    by: Sequence[str] = ("city", "room_type"),
    available: str = "availability_365",
    capacity: float = 365.0,
    key: str = "id",
) -> DataFrame:
    """Mean availability and occupancy per category, over rows with known availability."""
    mean = numeric.exact_avg(available)
    return (
        df.where(F.col(available).isNotNull())
        .groupBy(*by)
        .agg(
            mean.alias("avg_availability_365"),
            numeric.occupancy(mean, capacity).alias("avg_occupancy_rate"),
            F.count(key).alias("n_listings"),
        )
        .orderBy(by[0], "avg_occupancy_rate", *by[1:])
    )


def compare_groups(
    df: DataFrame,
    by: Sequence[str],
    host: str = "host_id",
    price: str = "price",
    activity: str = "reviews_per_month",
    available: str = "availability_365",
    key: str = "id",
    extra_means: Mapping[str, str] | None = None,
    capacity: float = 365.0,
    sketch: int | None = None,
) -> DataFrame:
    """Price, activity, occupancy, listings and hosts per group, from one pass over the rows."""
    averaged = {"mean_price": price, "mean_reviews_per_month": activity, "available": available, **(extra_means or {})}
    measures = [*[numeric.exact_avg(c).alias(name) for name, c in averaged.items()], F.count(key).alias("n_listings")]
    table = with_quantiles(df, by, measures, price, {"median_price": 0.5}, sketch, distinct={"n_hosts": host})
    table = table.withColumn("avg_occupancy_rate", numeric.occupancy("available", capacity))
    means = [name for name in averaged if name != "available"]
    return table.select(*by, *means, "n_listings", "n_hosts", "avg_occupancy_rate", "median_price")


def compare_areas(
    listings: DataFrame,
    areas: DataFrame,
    parent: str = "city",
    group: str = "neighbourhood_group",
    area: str = "neighbourhood",
    **options,
) -> DataFrame:
    """Groups of areas compared, with the number of areas the reference table knows in each."""
    known = areas.groupBy(parent, group).agg(F.count_distinct(area).alias("n_neighbourhoods"))
    stats = compare_groups(listings, [parent, group], **options)
    return (
        stats.join(known, [parent, group], "left")
        .withColumn("listings_per_neighbourhood", numeric.ratio("n_listings", "n_neighbourhoods"))
        .orderBy(F.col(parent), F.col("n_listings").desc(), F.col(group))
    )


def headline_metrics(
    df: DataFrame, parent: str = "city", host: str = "host_id", price: str = "price", multi: str = "host_type"
) -> DataFrame:
    """Listings, hosts, exact median price and share of multi-listing hosts' listings."""
    measures = [
        F.count("*").alias("n_listings"),
        numeric.percent(F.count_if(F.col(multi) == "multi"), F.count("*")).alias("multi_share_pct"),
    ]
    table = with_quantiles(df, [parent], measures, price, {f"median_{price}": 0.5}, method="linear", distinct={"n_hosts": host})
    return table.select(parent, "n_listings", "n_hosts", "multi_share_pct", f"median_{price}").orderBy(parent)


def group_breakdown(
    df: DataFrame, by: Sequence[str] = ("city", "neighbourhood_group"), price: str = "price", key: str = "id"
) -> DataFrame:
    """Listings and exact median price per named group."""
    named = df.dropna(subset=list(by))
    return with_quantiles(named, by, [F.count(key).alias("n_listings")], price, {f"median_{price}": 0.5}, method="linear")


def group_centroid(
    df: DataFrame,
    by: Sequence[str] = ("neighbourhood_group",),
    latitude: str = "latitude",
    longitude: str = "longitude",
) -> DataFrame:
    """Mean position of each group."""
    return df.groupBy(*by).agg(
        numeric.exact_avg(latitude).alias("center_latitude"),
        numeric.exact_avg(longitude).alias("center_longitude"),
    )


def city_summary(
    listings: DataFrame,
    calendar: DataFrame,
    reviews: DataFrame,
    parent: str = "city",
    price: str = "price",
    category: str = "room_type",
    activity: str = "number_of_reviews",
    rating: str = "review_scores_rating",
    available: str = "availability_365",
    flag: str = "available",
    key: str = "id",
    sketch: int | None = None,
) -> DataFrame:
    """One row per parent: listing statistics, dominant category, reviews and calendar availability."""
    measures = [
        F.count(key).alias("n_listings"),
        F.round(numeric.exact_avg(price), 0).alias("avg_price"),
        F.round(numeric.exact_avg(activity), 1).alias("avg_reviews_per_listing"),
        F.round(numeric.exact_avg(rating), 2).alias("avg_rating"),
        F.round(numeric.exact_avg(available), 0).alias("avg_availability"),
    ]
    priced = with_quantiles(listings.where(F.col(price) > 0), [parent], measures, price, {"median_price": 0.5}, sketch)
    priced = priced.withColumn("median_price", F.round("median_price", 0))
    reviewed = reviews.groupBy(parent).agg(F.count("*").alias("total_reviews"))
    free = calendar.groupBy(parent).agg(
        F.round(numeric.percent(F.count_if(F.col(flag)), F.count(flag)), 1).alias("availability_rate_pct")
    )
    out = join_groups(priced, dominant(listings, parent, category), [parent], "left")
    out = join_groups(join_groups(out, reviewed, [parent], "left"), free, [parent], "left")
    return out.fillna(0, subset=["total_reviews"]).orderBy(parent)
