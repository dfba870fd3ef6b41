"""Raw per-city files to unified tables to cleaned tables."""

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators import cleaning
from ..sources import tables

# The cities, their raw folders, and the files each folder holds.
CITY_FOLDERS = {"porto": "Porto", "lisbon": "Lisbon", "madrid": "Madrid", "barcelona": "Barcelona"}
DATASETS = ("listings", "calendar", "reviews", "neighbourhoods")
DETAILED = "listings-detailed"
# The daily calendar is by far the largest file and holds no free text, so it can be read in splits.
WITHOUT_LINE_BREAKS = ("calendar",)


def unify_cities(
    spark: SparkSession,
    raw: str,
    dataset: str,
    cities: Mapping[str, str] = CITY_FOLDERS,
    keep_malformed: bool = False,
) -> DataFrame:
    """One dataset of all cities, on the columns that every city has."""
    multiline = dataset not in WITHOUT_LINE_BREAKS
    return tables.unify(
        [
            tables.read_city_csv(spark, f"{raw}/{folder}", dataset, city, multiline, keep_malformed)
            for city, folder in cities.items()
        ]
    )


def ingest(
    spark: SparkSession,
    raw: str,
    interim: str,
    cities: Mapping[str, str] = CITY_FOLDERS,
    datasets: Sequence[str] = DATASETS,
    keep_malformed: bool = False,
) -> None:
    for dataset in datasets:
        rows = unify_cities(spark, raw, dataset, cities, keep_malformed)
        tables.write_table(rows, f"{interim}/{dataset}", "city")


def detailed_listings(
    spark: SparkSession, raw: str, cities: Mapping[str, str] = CITY_FOLDERS
) -> DataFrame | None:
    """Cleaned detailed listings of the cities that have the file; each file is read once."""
    found = []
    for city, folder in cities.items():
        path = f"{raw}/{folder}/{DETAILED}.csv"
        if tables.path_exists(spark, path):
            rows = tables.select_available(tables.read_csv(spark, path), cleaning.DETAIL_COLUMNS)
            found.append(cleaning.clean_detailed(rows).withColumn("city", F.lit(city)))
    return tables.unify(found) if found else None


def clean(
    spark: SparkSession,
    interim: str,
    processed: str,
    raw: str | None = None,
    cities: Mapping[str, str] = CITY_FOLDERS,
    account: bool = False,
) -> None:
    """Clean the unified tables; listings are enriched where raw detailed files exist.

    With ``account`` the pass that writes listings, calendar and reviews also counts what could not be read, per column, and
    the counts are stored as the table ``account``.
    """

    def unified(dataset: str) -> DataFrame:
        return tables.read_table(spark, f"{interim}/{dataset}")

    detailed = detailed_listings(spark, raw, cities) if raw else None
    seen = {d: Observation(d) if account else None for d in ("listings", "calendar", "reviews")}
    cleaned = {
        "listings": cleaning.clean_listings(unified("listings"), detailed, account=seen["listings"]),
        "calendar": cleaning.clean_calendar(unified("calendar"), seen["calendar"]),
        "reviews": cleaning.clean_reviews(unified("reviews"), seen["reviews"]),
        "neighbourhoods": cleaning.clean_neighbourhoods(unified("neighbourhoods").drop(tables.MALFORMED)),
    }
    for dataset, df in cleaned.items():
        tables.write_table(df, f"{processed}/{dataset}", "city")
    if account:
        counted = [cleaning.account_rows(spark, o).select(F.lit(d).alias("dataset"), "*") for d, o in seen.items()]
        tables.write_table(tables.unify(counted), f"{processed}/account")
