"""Counts over time and their growth."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import numeric
from .occupancy import with_month


def with_previous(
    counts: DataFrame, series: Sequence[str], n: str = "n_reviews", strict: bool = False
) -> DataFrame:
    """Add the count of the previous year that is present or, if strict, of the year before."""
    by_year = Window.partitionBy(*series).orderBy("year")
    previous: Column = F.lag(n).over(by_year)
    if strict:
        previous = F.when(F.lag("year").over(by_year) == F.col("year") - 1, previous)
    return counts.withColumn("previous", previous)


def yoy_monthly(
    df: DataFrame, parent: str = "city", date: str = "date", since: int = 2018, strict: bool = False
) -> DataFrame:
    """Monthly counts with the growth over the same month of the previous year."""
    counts = (
        with_month(df, date)
        .where(F.col("year") >= since)
        .groupBy(parent, "year", "month")
        .agg(F.count("*").alias("n_reviews"))
    )
    growth = numeric.ratio(F.col("n_reviews") - F.col("previous"), "previous")
    return (
        with_previous(counts, [parent, "month"], strict=strict)
        .withColumn("yoy_growth", F.when(F.col("previous") > 0, growth))
        .withColumnRenamed("previous", "prev_year_reviews")
        .orderBy(parent, "year", "month")
    )


def yoy_yearly(
    df: DataFrame, parent: str = "city", date: str = "date", since: int = 2018, strict: bool = False
) -> DataFrame:
    """Yearly counts with growth in percent; each parent's first year is left out."""
    counts = (
        with_month(df, date)
        .where(F.col("year") >= since)
        .groupBy(parent, "year")
        .agg(F.count("*").alias("n_reviews"))
    )
    growth = numeric.percent(F.col("n_reviews") - F.col("previous"), "previous")
    return (
        with_previous(counts, [parent], strict=strict)
        .where(F.col("previous").isNotNull())
        .select(
            parent,
            "year",
            "n_reviews",
            F.round(F.when(F.col("previous") > 0, growth).otherwise(F.lit(0.0)), 1).alias("yoy_growth_pct"),
        )
    )


def yoy_pivot(df: DataFrame, parents: Sequence[str], parent: str = "city", **options) -> DataFrame:
    """Yearly growth with one column per listed parent."""
    return (
        yoy_yearly(df, parent, **options)
        .groupBy("year")
        .pivot(parent, list(parents))
        .agg(F.first("yoy_growth_pct"))
        .orderBy("year")
    )


def per_entity_monthly(
    activity: DataFrame,
    entities: DataFrame,
    parent: str = "city",
    entity: str = "id",
    date: str = "date",
) -> DataFrame:
    """Monthly activity, absolute and per distinct entity of the parent."""
    monthly = activity.groupBy(parent, F.trunc(date, "month").alias("month")).agg(
        F.count("*").alias("review_count")
    )
    totals = entities.groupBy(parent).agg(F.count_distinct(entity).alias("total_listings"))
    return (
        monthly.join(totals, parent, "left")
        .withColumn("reviews_per_listing", numeric.ratio("review_count", "total_listings"))
        .orderBy(parent, "month")
    )


def series_extremes(
    df: DataFrame, series: str = "city", position: Sequence[str] = ("year", "month"), value: str = "value"
) -> DataFrame:
    """Where each series is lowest and highest; the earliest position wins among equal values."""
    at = F.struct(*position)
    negated = F.struct(*[(-F.col(p)).alias(p) for p in position])
    low = F.min(F.struct(F.col(value).alias("value"), at.alias("at")))
    high = F.max(F.struct(F.col(value).alias("value"), negated.alias("at")))
    out = df.where(F.col(value).isNotNull()).groupBy(series).agg(low.alias("low"), high.alias("high"))
    return out.select(
        series,
        *[F.col("low.at")[p].alias(f"min_{p}") for p in position],
        F.col("low.value").alias("min_value"),
        *[(-F.col("high.at")[p]).alias(f"max_{p}") for p in position],
        F.col("high.value").alias("max_value"),
    )


def month_means(df: DataFrame, series: str, value: str) -> DataFrame:
    """Mean of a monthly rate over the years."""
    return df.groupBy(series, "month").agg(numeric.exact_avg(value).alias("mean_value"))


def city_month_matrix(
    df: DataFrame, columns: Sequence[str], series: str = "city", value: str = "occupancy_rate"
) -> DataFrame:
    """Calendar months by series; months without data are present and empty."""
    means = month_means(df, series, value).groupBy("month").pivot(series, list(columns)).agg(F.first("mean_value"))
    months = df.sparkSession.range(1, 13).select(F.col("id").cast("int").alias("month"))
    return months.join(means, "month", "left").orderBy("month")


def season_lift(
    df: DataFrame,
    series: str = "city",
    value: str = "occupancy_rate",
    season: Sequence[int] = (6, 7, 8),
) -> DataFrame:
    """Season against the year, from the means per calendar month, and the peak month."""
    means = month_means(df, series, value)
    in_season = F.when(F.col("month").isin(list(season)), F.col("mean_value"))
    peak = F.max(F.struct("mean_value", (-F.col("month")).alias("month")))
    stats = means.groupBy(series).agg(
        numeric.exact_avg("mean_value").alias("annual"),
        numeric.exact_avg(in_season).alias("season"),
        peak.alias("peak"),
    )
    return stats.select(
        series,
        F.round("annual", 3).alias("annual_mean"),
        F.round("season", 3).alias("season_mean"),
        F.round(numeric.percent(F.col("season") - F.col("annual"), "annual"), 1).alias("lift_pct"),
        (-F.col("peak.month")).alias("peak_month"),
        F.round("peak.mean_value", 3).alias("peak_value"),
    )


def peak_trough(df: DataFrame, series: str = "city", value: str = "occupancy_rate") -> DataFrame:
    """Month and year with the highest and the lowest rate."""
    return series_extremes(df, series, ("year", "month"), value).select(
        series,
        F.col("max_month").alias("peak_month"),
        F.col("max_value").alias("peak_value"),
        F.col("min_month").alias("trough_month"),
        F.col("min_value").alias("trough_value"),
    )


def crosstab(
    df: DataFrame, row: str, column: str, values: Sequence, percent_of: str | None = None
) -> DataFrame:
    """Counts, or percentages of the row total, with one column per listed value; absent pairs are 0."""
    table = df.groupBy(row).pivot(column, list(values)).count().fillna(0, subset=[str(v) for v in values])
    if percent_of is None:
        return table
    if percent_of != "row":
        raise ValueError("percent_of must be None or 'row'")
    total = sum((F.col(f"`{v}`") for v in values), F.lit(0))
    share = {str(v): F.round(numeric.percent(F.col(f"`{v}`"), total), 2) for v in values}
    return table.select(row, *[e.alias(c) for c, e in share.items()])


def dominant(df: DataFrame, parent: str, category: str) -> DataFrame:
    """Most frequent category of each parent; the first by name among equals."""
    counts = df.groupBy(parent, category).agg(F.count("*").alias("n"))
    first = F.min(F.struct((-F.col("n")).alias("n"), F.col(category).alias("name")))
    return counts.groupBy(parent).agg(first["name"].alias(f"dominant_{category}"))


