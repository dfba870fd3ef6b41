"""The market questions over the four cleaned tables."""

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import concentration, distributions, occupancy, profiling, rankings, trends
from ..sources import tables


@dataclass(frozen=True)
class Market:
    listings: DataFrame
    calendar: DataFrame
    reviews: DataFrame
    neighbourhoods: DataFrame

    @classmethod
    def load(cls, spark: SparkSession, root: str) -> "Market":
        return cls(
            *[
                tables.read_table(spark, f"{root.rstrip('/')}/{name}")
                for name in ("listings", "calendar", "reviews", "neighbourhoods")
            ]
        )


def priciest_and_cheapest(m: Market) -> DataFrame:
    return rankings.top_bottom(m.listings)


def availability_by_month(m: Market) -> DataFrame:
    return occupancy.seasonality(m.calendar, m.listings)


def occupancy_by_room_type(m: Market) -> DataFrame:
    return profiling.category_rates(m.listings)


def multi_against_single_hosts(m: Market) -> DataFrame:
    return profiling.compare_groups(m.listings, ["city", "host_type"]).orderBy("city", "host_type")


def host_concentration(m: Market) -> DataFrame:
    return concentration.pareto(m.listings)


def reviews_against_price(m: Market) -> DataFrame:
    return rankings.corr_by_group(m.listings).withColumnRenamed("corr", "corr_rpm_price")


def top_revenue_areas(m: Market) -> DataFrame:
    return rankings.top_by_total(m.listings)


def room_type_shares(m: Market) -> DataFrame:
    return rankings.share_of_parent(m.listings)


def review_growth(m: Market) -> DataFrame:
    return trends.yoy_monthly(m.reviews)


def price_thresholds(m: Market) -> DataFrame:
    return distributions.thresholds_wide(m.listings)


def municipalities(m: Market) -> DataFrame:
    return profiling.compare_areas(
        m.listings, m.neighbourhoods, extra_means={"avg_minimum_nights": "minimum_nights"}
    ).withColumnsRenamed(
        {
            "mean_reviews_per_month": "avg_reviews_per_month",
            "n_neighbourhoods": "n_neighbourhoods_in_municipality",
        }
    )


QUESTIONS: dict[str, tuple[str, Callable[[Market], DataFrame]]] = {
    "q01": ("Ten most expensive and ten cheapest neighbourhoods per city", priciest_and_cheapest),
    "q02": ("Availability and revenue per city and month", availability_by_month),
    "q03": ("Occupancy by room type", occupancy_by_room_type),
    "q04": ("Hosts with several listings against hosts with one", multi_against_single_hosts),
    "q05": ("Share of listings held by the largest hosts", host_concentration),
    "q06": ("Correlation of review activity and price per neighbourhood", reviews_against_price),
    "q07": ("Ten neighbourhoods with the highest estimated revenue", top_revenue_areas),
    "q08": ("Room type shares per city", room_type_shares),
    "q09": ("Monthly reviews and their growth over the year before", review_growth),
    "q10": ("Listings above price thresholds", price_thresholds),
    "q11": ("Municipalities compared", municipalities),
}


def ask(market: Market, question: str) -> DataFrame:
    if question not in QUESTIONS:
        raise KeyError(f"unknown question {question!r}; known: {', '.join(QUESTIONS)}")
    return QUESTIONS[question][1](market)


def peak_demand(m: Market) -> DataFrame:
    """Peak and trough month per city."""
    return trends.peak_trough(availability_by_month(m).where(F.col("occupancy_rate").isNotNull()))


def answer(market: Market, folder: str, questions: list[str] | None = None, single_csv: bool = False) -> list[str]:
    """Answer questions, each stored as ``<folder>/<question>.parquet``."""
    chosen = questions or list(QUESTIONS)
    for q in chosen:
        tables.export_report(ask(market, q), f"{folder.rstrip('/')}/{q}", single_csv)
    return chosen
