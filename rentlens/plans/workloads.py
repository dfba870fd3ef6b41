"""The heavy workloads that are timed."""

from pyspark.sql import DataFrame

from ..ml import models
from ..operators import occupancy
from .market import Market


def query_seasonality(m: Market) -> DataFrame:
    return occupancy.seasonality(m.calendar, m.listings, price=None)


def review_demand(m: Market) -> DataFrame:
    return occupancy.review_demand(m.reviews, m.listings)


def calendar_revenue(m: Market) -> DataFrame:
    return occupancy.area_revenue(m.calendar, m.listings)


def full_pipeline(m: Market) -> DataFrame:
    return occupancy.market_months(m.calendar, m.listings, m.reviews)


def train_rf(m: Market) -> DataFrame:
    return models.train_forest_benchmark(m.listings)


WORKLOADS = {
    "query_seasonality": query_seasonality,
    "train_rf": train_rf,
    "review_demand": review_demand,
    "calendar_revenue": calendar_revenue,
    "full_pipeline": full_pipeline,
}
