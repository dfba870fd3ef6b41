"""Monthly market figures that are kept up to date: a stored table of sums per city and month.

Everything the figures need is additive: days, known and free days, and revenue as whole millionths beside a rest. New days
are added to the stored sums of their city, and a snapshot that replaces a city replaces that city's partition; the files of
other cities stay as they are. Figures read the stored sums only.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import numeric
from ..operators import occupancy
from ..sources.scratch import stored
from ..sources.tables import path_exists

KEYS = ["city", "year", "month"]
COUNTS = ["n_days", "n_known", "n_free"]


def month_sums(calendar: DataFrame, listings: DataFrame, price: str = "price", flag: str = "available") -> DataFrame:
    """The additive parts of ``occupancy.seasonality`` per city and month; days without a date have no part."""
    dated = calendar.where(F.col("date").isNotNull())
    months = occupancy.beside_listings(occupancy.listing_months(dated, flag, keep=("city",)), listings, ["city", price])
    booked_value = F.when(F.col("n_booked") == 0, F.lit(0.0)).otherwise(F.col(price) * F.col("n_booked"))
    value = F.coalesce(booked_value, F.when(F.col("n_booked") < F.col("n_days"), F.lit(0.0)))
    millionths, rest = numeric.exact_parts(value)
    sums = [F.sum(c).alias(c) for c in COUNTS]
    return months.groupBy(*KEYS).agg(*sums, millionths.alias("revenue_millionths"), rest.alias("revenue_rest"))


def merged_sums(*parts: DataFrame) -> DataFrame:
    """Sums of the same months put together."""
    rows = parts[0]
    for more in parts[1:]:
        rows = rows.unionByName(more)
    added = F.sum("revenue_millionths").cast("decimal(38,0)").alias("revenue_millionths")
    return rows.groupBy(*KEYS).agg(*[F.sum(c).alias(c) for c in COUNTS], added, F.sum("revenue_rest").alias("revenue_rest"))


def replace_cities(parts: DataFrame, path: str) -> None:
    """Write the cities of ``parts`` over what is stored of them; other cities keep their files."""
    chosen = parts.repartition("city").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    chosen.partitionBy("city").parquet(path)


def add_days(parts: DataFrame, path: str) -> None:
    """Add the sums of further days to the stored ones of their cities."""
    spark = parts.sparkSession
    if not path_exists(spark, path):
        return replace_cities(parts, path)
    parts = stored(parts, "new-sums")
    cities = parts.select(F.col("city").alias("_city")).distinct()
    before = read_sums(spark, path, parts).join(cities, F.col("city").eqNullSafe(F.col("_city")), "left_semi")
    # What is read from a partition is stored elsewhere before the partition is written over.
    replace_cities(stored(merged_sums(before, parts), "merged-sums"), path)


def read_sums(spark: SparkSession, path: str, like: DataFrame) -> DataFrame:
    return spark.read.schema(like.schema).parquet(path).select(*like.columns)


def seasonality(sums: DataFrame) -> DataFrame:
    """The figures of ``occupancy.seasonality`` from the stored sums."""
    free = numeric.ratio("n_free", "n_known")
    return sums.select(
        *KEYS,
        F.col("n_days").alias("n_calendar_days"),
        free.alias("availability_rate"),
        (F.lit(1.0) - free).alias("occupancy_rate"),
        numeric.whole_of("revenue_millionths", "revenue_rest").alias("estimated_revenue_proxy"),
    ).orderBy(*KEYS)
