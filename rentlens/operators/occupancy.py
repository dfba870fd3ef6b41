"""Daily calendars and reviews against listings.

Day-level rows are reduced to one row per listing and month before they meet the listings: the
reduction is combined in every map task, so a listing holding a large part of all days costs no more
than any other, and the join moves months instead of days. Listings carry one row per id
(``clean_listings`` sees to it), so counting listing-months of one month counts distinct listings.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import labels, numeric, parsing

LISTING = "listing_id"


def with_month(df: DataFrame, date: str = "date") -> DataFrame:
    """Add year and month where the table does not carry them."""
    parts = parsing.date_parts(date)
    return df.withColumns({c: parts[c] for c in ("year", "month") if c not in df.columns})


def listing_months(
    calendar: DataFrame, flag: str = "available", date: str = "date", keep: Sequence[str] = ("city",)
) -> DataFrame:
    """Days, known, free and booked days per listing and month."""
    keys = [LISTING, *[c for c in keep if c in calendar.columns], "year", "month"]
    free = F.col(flag)
    return (
        with_month(calendar, date)
        .groupBy(*keys)
        .agg(
            F.count("*").alias("n_days"),
            F.count(free).alias("n_known"),
            F.count_if(free).alias("n_free"),
            F.count_if(~free).alias("n_booked"),
        )
    )


def beside_listings(
    months: DataFrame, listings: DataFrame, attributes: Sequence[str], key: str = "id", how="inner"
) -> DataFrame:
    """Add listing attributes to monthly rows; the monthly side's own columns win.

    Without a hint: AQE broadcasts a side whose measured size allows it and splits hot keys of a merge
    join otherwise.
    """
    added = [c for c in attributes if c not in months.columns]
    chosen = listings.select(F.col(key).alias(LISTING), *added)
    return months.join(chosen, LISTING, how)


def seasonality(
    calendar: DataFrame,
    listings: DataFrame,
    by: Sequence[str] = ("city",),
    price: str | None = "price",
    flag: str = "available",
) -> DataFrame:
    """Monthly availability and, with a price, the revenue of the booked days.

    Days without a known flag count as days but neither as free nor as booked.
    """
    keys = [*by, "year", "month"]
    dated = calendar.where(F.col("date").isNotNull())
    months = beside_listings(
        listing_months(dated, flag, keep=by), listings, [*by, *([price] if price else [])]
    )
    measures = [F.sum("n_days").alias("n_calendar_days")]
    free = numeric.ratio(F.sum("n_free"), F.sum("n_known"))
    measures.append(free.alias("availability_rate"))
    if price:
        measures.append((F.lit(1.0) - free).alias("occupancy_rate"))
        # A month without a booked day adds zero even where the price is unknown.
        booked_value = F.when(F.col("n_booked") == 0, F.lit(0.0)).otherwise(F.col(price) * F.col("n_booked"))
        unpriced_days = F.when(F.col("n_booked") < F.col("n_days"), F.lit(0.0))
        measures.append(
            numeric.exact_sum(F.coalesce(booked_value, unpriced_days)).alias("estimated_revenue_proxy")
        )
    return months.groupBy(*keys).agg(*measures).orderBy(*keys)


def area_revenue(
    calendar: DataFrame,
    listings: DataFrame,
    parent: str = "city",
    area: str = "neighbourhood",
    price: str = "price",
    flag: str = "available",
) -> DataFrame:
    """Revenue of the booked days per area and month, ranked within the parent's month.

    The occupancy rate leaves out days without a known flag; the daily average counts them as zero.
    """
    months = beside_listings(listing_months(calendar, flag, keep=(parent,)), listings, [parent, area, price])
    earned = F.when(F.col("n_booked") == 0, F.lit(0.0)).otherwise(F.col(price) * F.col("n_booked"))
    valued_days = F.when(F.col(price).isNull(), F.col("n_days") - F.col("n_booked")).otherwise(F.col("n_days"))
    revenue = F.when(
        F.sum("valued_days") > 0, F.coalesce(numeric.exact_sum("earned"), F.lit(0.0))
    )
    mean_day = F.coalesce(
        numeric.exact_mean("earned", F.sum("valued_days")), F.when(F.sum("valued_days") > 0, F.lit(0.0))
    )
    areas = (
        months.select("*", earned.alias("earned"), valued_days.alias("valued_days"))
        .groupBy(parent, area, "year", "month")
        .agg(
            revenue.alias("total_revenue"),
            mean_day.alias("avg_daily_revenue"),
            F.sum("n_days").alias("n_days"),
            F.when(F.sum("n_known") > 0, F.sum("n_booked")).alias("booked_days"),
            F.when(F.sum("n_known") > 0, F.sum("n_free")).alias("available_days"),
            F.count(LISTING).alias("n_listings"),
        )
        .withColumn(
            "occupancy_rate", numeric.ratio("booked_days", F.col("booked_days") + F.col("available_days"))
        )
    )
    within_month = Window.partitionBy(parent, "year", "month").orderBy(
        F.col("total_revenue").desc(), F.col(area).asc()
    )
    return areas.withColumn("revenue_rank", F.row_number().over(within_month))


def listing_reviews(reviews: DataFrame, keep: Sequence[str] = (), date: str = "date") -> DataFrame:
    """Reviews per listing and month."""
    keys = [LISTING, *[c for c in keep if c in reviews.columns], "year", "month"]
    return with_month(reviews, date).groupBy(*keys).agg(F.count("*").alias("n_reviews"))


def review_demand(
    reviews: DataFrame,
    listings: DataFrame,
    parent: str = "city",
    category: str = "room_type",
    price: str = "price",
    limits=labels.PRICE_BANDS,
    top: str = labels.TOP_BAND,
) -> DataFrame:
    """Monthly reviews by price band and category, with the review-weighted mean price."""
    months = beside_listings(listing_reviews(reviews, keep=(parent,)), listings, [parent, category, price])
    keys = [parent, "year", "month", "price_range", category]
    priced = F.when(F.col(price).isNotNull(), F.col("n_reviews"))
    return (
        months.withColumn("price_range", labels.bands(price, limits, top))
        .groupBy(*keys)
        .agg(
            F.sum("n_reviews").alias("n_reviews"),
            F.count(LISTING).alias("n_unique_listings"),
            numeric.exact_mean(F.col(price) * F.col("n_reviews"), F.sum(priced)).alias("avg_price"),
        )
        .orderBy(*keys)
    )


def market_months(
    calendar: DataFrame,
    listings: DataFrame,
    reviews: DataFrame,
    parent: str = "city",
    category: str = "room_type",
    price: str = "price",
    flag: str = "available",
) -> DataFrame:
    """Calendar, listings and reviews in one monthly table per parent and category.

    Each listing-month weighs the same, whatever its number of days; days without a known flag lower
    its occupancy. Listing-months without reviews count zero reviews.
    """
    days = listing_months(calendar, flag, keep=(parent,))
    # Reviews join first: where the calendar carries no city of its own, both sides come out of their
    # aggregation partitioned by the join keys and need no further shuffle.
    active = days.join(listing_reviews(reviews), [LISTING, "year", "month"], "left")
    months = beside_listings(active, listings, [parent, category, price])
    booked = F.when(F.col("n_known") > 0, F.col("n_booked"))
    keys = [parent, category, "year", "month"]
    return (
        months.withColumns({"booked": booked, "occupancy": numeric.ratio(booked, "n_days")})
        .groupBy(*keys)
        .agg(
            numeric.exact_avg("occupancy").alias("avg_occupancy"),
            numeric.exact_avg(price).alias("avg_price"),
            F.sum(F.coalesce("n_reviews", F.lit(0))).alias("total_reviews"),
            F.count(LISTING).alias("n_listings"),
            numeric.ratio(F.sum("booked"), F.count("booked")).alias("avg_booked_days"),
        )
        .orderBy(*keys)
    )


def calendar_overview(
    calendar: DataFrame, by: str = "city", flag: str = "available", price: str | None = None
) -> DataFrame:
    """Rows, listings, free and blocked days and their shares of all rows."""
    free = F.col(flag)
    # Listing level first: the listing count then needs no pass over distinct day rows.
    per_listing = calendar.groupBy(by, LISTING).agg(
        F.count("*").alias("rows"),
        F.count_if(free).alias("free"),
        F.count_if(~free).alias("blocked"),
        *([numeric.exact_sum(price).alias("value"), F.count(price).alias("valued")] if price else []),
    )
    out = per_listing.groupBy(by).agg(
        F.sum("rows").alias("total_rows"),
        F.count(LISTING).alias("unique_listings"),
        F.sum("free").alias("available_days"),
        F.sum("blocked").alias("blocked_days"),
        *(
            [F.round(numeric.exact_mean("value", F.sum("valued")), 2).alias("avg_price")]
            if price
            else []
        ),
    )
    return out.withColumns(
        {
            "available_pct": F.round(numeric.percent("available_days", "total_rows"), 2),
            "blocked_pct": F.round(numeric.percent("blocked_days", "total_rows"), 2),
        }
    ).orderBy(by)


def monthly_rate(
    calendar: DataFrame,
    by: Sequence[str] = ("city",),
    flag: str = "available",
    date: str = "date",
    unknown: str = "count",
) -> DataFrame:
    """Monthly share of free days. ``unknown`` says whether days without a known flag are part of the
    total (``count``) or left out (``ignore``)."""
    if unknown not in ("count", "ignore"):
        raise ValueError("unknown must be 'count' or 'ignore'")
    total: Column = F.count("*") if unknown == "count" else F.count(flag)
    keys = [*by, "year", "month"]
    return (
        with_month(calendar, date)
        .groupBy(*keys)
        .agg(total.alias("total"), F.count_if(F.col(flag)).alias("available_count"))
        .withColumn("availability_rate", numeric.ratio("available_count", "total"))
        .orderBy(*keys)
    )


def coverage(df: DataFrame, column: str, by: Sequence[str] = ("city",)) -> DataFrame:
    """Filled values of a column per group."""
    return (
        df.groupBy(*by)
        .agg(F.count(column).alias("non_null"), F.count("*").alias("total"))
        .withColumn("pct_non_null", F.round(numeric.percent("non_null", "total"), 1))
        .orderBy(*by)
    )


def monthly_mean_positive(
    df: DataFrame, column: str, by: Sequence[str] = ("city",), date: str = "date"
) -> DataFrame:
    """Monthly mean of the positive values of a column."""
    keys = [*by, "year", "month"]
    return (
        with_month(df.where(F.col(column) > 0), date)
        .groupBy(*keys)
        .agg(F.round(numeric.exact_avg(column), 2).alias(f"avg_{column}"))
        .orderBy(*keys)
    )
