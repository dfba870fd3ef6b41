"""Stored forms of the tables: buckets, refreshed partitions, merged bitmaps, samples of exact size."""

from pyspark.sql import functions as F

from ..functions import bitmaps
from ..operators import distributions, occupancy
from ..plans import refresh
from ..sources import bucketed, scratch
from . import roles
from .market_entries import SEASON
from .registry import ENTRIES, entry, rounded, sql_avg, sql_sum

BUCKETS = 8


def bucketed_market(t):
    """Calendar and listings in equally many buckets of the listing, more where there are more rows. An order has one customer,
    so there are no more listings than orders."""
    buckets = bucketed.buckets_for_rows(t["lineitem"], t["orders"], at_least=BUCKETS)
    days = bucketed.write_bucketed(roles.calendar(t), "listing_id", buckets)
    homes = bucketed.write_bucketed(roles.listings(t).select("id", "city", "neighbourhood", "price"), "id", buckets)
    return bucketed.read_bucketed(t.spark, days), bucketed.read_bucketed(t.spark, homes)


@entry("bucketed_seasonality", SEASON, roles="r_calendar r_listings")
def _(t):
    return rounded(occupancy.seasonality(*bucketed_market(t)))


@entry(
    "bucketed_area_revenue",
    f"""
    WITH days AS (SELECT *, CASE WHEN NOT available THEN price ELSE 0 END AS earned FROM r_calendar JOIN r_listings ON listing_id = id)
    SELECT city, neighbourhood, year, month, {sql_sum("earned")} AS total_revenue, round({sql_avg("earned")}, 6) AS avg_daily_revenue,
           count(DISTINCT listing_id) AS n_listings FROM days GROUP BY ALL""",
    roles="r_calendar r_listings",
)
def _(t):
    return rounded(occupancy.area_revenue(*bucketed_market(t))).select("city", "neighbourhood", "year", "month", "total_revenue", "avg_daily_revenue", "n_listings")


@entry("refreshed_seasonality", SEASON, roles="r_calendar r_listings")
def _(t):
    """A first snapshot lacks the second half of every year and holds every day of one city twice; then the later months are
    added to the other cities, and the city is replaced as a whole."""
    path = scratch.new_folder(t.spark, "month-sums")
    sums = refresh.month_sums(roles.calendar(t), roles.listings(t))
    wrong, early = F.col("city") == "ASIA", F.col("month") <= 6
    refresh.replace_cities(refresh.merged_sums(sums.where(early), sums.where(early & wrong)), path)
    refresh.add_days(sums.where(~early & ~wrong), path)
    refresh.replace_cities(sums.where(wrong), path)
    return rounded(refresh.seasonality(refresh.read_sums(t.spark, path, sums)))


@entry(
    "yearly_reviewers",
    "SELECT city, year, count(DISTINCT reviewer_id) AS n_reviewers FROM r_reviews JOIN r_listings ON listing_id = id GROUP BY ALL",
    roles="r_reviews r_listings",
)
def _(t):
    """Reviewers of a year from the bitmaps of its months."""
    placed = roles.reviews(t).join(roles.listings(t).select(F.col("id").alias("listing_id"), "city"), "listing_id")
    months = bitmaps.key_bitmaps(occupancy.with_month(placed), "reviewer_id", ["city", "year", "month"])
    return bitmaps.distinct_keys(months, ["city", "year"], "n_reviewers")


@entry(
    "sample_of_exact_size",
    """
    SELECT city, id, price FROM r_listings
    QUALIFY row_number() OVER (PARTITION BY city ORDER BY md5('42:' || id), id) <= 40""",
    roles="r_listings",
)
def _(t):
    return distributions.exact_sample(roles.listings(t).select("city", "id", "price"), 40)


__all__ = ["ENTRIES"]
