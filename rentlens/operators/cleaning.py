"""Cleaning: typed columns, defaults, valid rows, one row per key, derived columns."""

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions import labels, numeric, parsing
from ..sources.tables import MALFORMED

# Source columns by the type that cleaning gives them.
SUMMARY_NUMBERS = (
    "latitude",
    "longitude",
    "minimum_nights",
    "number_of_reviews",
    "reviews_per_month",
    "calculated_host_listings_count",
    "availability_365",
    "number_of_reviews_ltm",
)
DETAIL_NUMBERS = (
    "accommodates",
    "bedrooms",
    "beds",
    "bathrooms",
    "review_scores_rating",
    "review_scores_cleanliness",
    "review_scores_location",
    "review_scores_value",
    "estimated_revenue_l365d",
    "estimated_occupancy_l365d",
)
DETAIL_FLAGS = ("host_is_superhost", "instant_bookable")
DETAIL_COLUMNS = ("id", "city", "price", "property_type", "amenities", *DETAIL_FLAGS, *DETAIL_NUMBERS)
YEAR_DAYS = 365.0
HIGH_OCCUPANCY = 0.70


def replace_present(df: DataFrame, changes: Mapping[str, Column]) -> DataFrame:
    """Replace the columns that exist, in one projection."""
    return df.withColumns({c: e for c, e in changes.items() if c in df.columns})


def read_columns(df: DataFrame, readings: Mapping[str, Column], account: Observation | None = None) -> DataFrame:
    """Replace the columns that exist by what is read from them; lines kept for being malformed are dropped as a column.

    ``account`` counts on the way, in the pass that the first action over the result makes: rows, malformed lines, and for each
    column the texts that are missing or blank and those that say something but cannot be read. It sees all rows that come
    in, those that later steps remove included.
    """
    present = {c: e for c, e in readings.items() if c in df.columns}
    if account is not None:
        text = {c: F.coalesce(F.trim(F.col(c).cast("string")), F.lit("")) for c in present}
        df = df.observe(
            account,
            F.count("*").alias("rows"),
            (F.count(MALFORMED) if MALFORMED in df.columns else F.lit(0).cast("bigint")).alias("malformed"),
            *[F.count_if(t == "").alias(f"missing {c}") for c, t in text.items()],
            *[F.count_if((t != "") & present[c].isNull()).alias(f"unreadable {c}") for c, t in text.items()],
        )
    return df.drop(MALFORMED).withColumns(present)


def account_rows(spark: SparkSession, account: Observation) -> DataFrame:
    """What was counted, a row per column; waits for the action that counts."""
    counts = account.get
    columns = [c.removeprefix("missing ") for c in counts if c.startswith("missing ")]
    rows = [(c, counts["rows"], counts["malformed"], counts[f"missing {c}"], counts[f"unreadable {c}"]) for c in columns]
    return spark.createDataFrame(rows, "column string, n_rows bigint, n_malformed bigint, n_missing bigint, n_unreadable bigint")


def cast_columns(df: DataFrame, columns: Iterable[str], dtype: str = "double") -> DataFrame:
    return replace_present(df, {c: parsing.number(c, dtype) for c in columns})


def fill_defaults(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    present = {c: v for c, v in defaults.items() if c in df.columns}
    return df.fillna(present) if present else df


def positive_only(df: DataFrame, column: str = "price") -> DataFrame:
    """Rows with a positive number; NaN is none."""
    return df.where((F.col(column) > 0) & ~F.isnan(F.col(column).cast("double")))


def dedupe(df: DataFrame, keys: Iterable[str], known: Iterable[str] = ()) -> DataFrame:
    """One row per key: the smallest row in column order, so reruns keep the same survivor.

    Runs as a grouped minimum (of a struct, hence as sort aggregates), which is combined before the
    shuffle; copies of one key never have to meet in full in one task. Keys the table lacks are
    ignored. ``known`` columns are compared first, and rows that know them come before those that do not.
    """
    keys = [k for k in keys if k in df.columns]
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.dropDuplicates(keys)
    missing = [F.col(c).isNull().alias(f"_no_{i}") for i, c in enumerate(known) if c in rest]
    kept = df.groupBy(*keys).agg(F.min(F.struct(*missing, *rest)).alias("kept"))
    return kept.select(*[F.col(c) if c in keys else F.col("kept")[c].alias(c) for c in df.columns])


def slice_rows(
    df: DataFrame,
    members: Mapping[str, Iterable] | None = None,
    between: Mapping[str, tuple] | None = None,
) -> DataFrame:
    """Rows whose columns are in the given sets and inclusive ranges."""
    for column, values in (members or {}).items():
        df = df.where(F.col(column).isin(list(values)))
    for column, (low, high) in (between or {}).items():
        df = df.where(F.col(column).between(low, high))
    return df


def enrich(
    df: DataFrame, extra: DataFrame, on: str = "id", prefer: Mapping[str, str] | None = None
) -> DataFrame:
    """Left join of further columns. ``prefer`` maps a column to the extra column that replaces it
    where known. Extra rows are reduced to one per key first, so no row is multiplied; one that knows
    the preferred columns is kept before one that does not."""
    out = df.join(dedupe(extra, [on], (prefer or {}).values()), on, "left")
    for column, better in (prefer or {}).items():
        if better in out.columns:
            out = out.withColumn(column, F.coalesce(F.col(better), F.col(column))).drop(better)
    return out


def occupancy_columns(
    df: DataFrame,
    available: str = "availability_365",
    price: str = "price",
    capacity: float = YEAR_DAYS,
    threshold: float = HIGH_OCCUPANCY,
) -> DataFrame:
    """High-occupancy flag, booked nights and revenue estimate; unknown availability stays unknown."""
    booked = F.lit(capacity) - F.col(available)
    columns = {
        "is_high_occupancy": numeric.occupancy(available, capacity) > F.lit(threshold),
        "booked_nights_365": booked,
    }
    if price in df.columns:
        columns["estimated_revenue_365"] = F.col(price) * booked
    return df.withColumns(columns)


def clean_detailed(df: DataFrame) -> DataFrame:
    """Detailed listing file to the columns that enrich the summary."""
    present = [c for c in DETAIL_COLUMNS if c in df.columns]
    out = cast_columns(df.select(*present), DETAIL_NUMBERS)
    out = replace_present(out, {c: parsing.flag(c) for c in DETAIL_FLAGS})
    if "price" in present:
        out = out.withColumn("price_detailed", parsing.money("price")).drop("price")
    if "amenities" in present:
        out = out.withColumn("amenity_count", parsing.json_array_size("amenities")).drop("amenities")
    return out


def clean_listings(
    df: DataFrame,
    detailed: DataFrame | None = None,
    key: str = "id",
    capacity: float = YEAR_DAYS,
    threshold: float = HIGH_OCCUPANCY,
    multi_above: float = 1,
    account: Observation | None = None,
) -> DataFrame:
    out = read_columns(
        df,
        {
            **{c: parsing.number(c) for c in SUMMARY_NUMBERS},
            "price": parsing.money("price"),
            "last_review": parsing.iso_date("last_review"),
        },
        account,
    )
    out = fill_defaults(out, {"reviews_per_month": 0.0})
    if detailed is not None:
        out = enrich(out, detailed.drop("city"), key, {"price": "price_detailed"})
    out = dedupe(positive_only(out, "price"), [key])
    if "calculated_host_listings_count" in out.columns:
        out = out.withColumn(
            "host_type", labels.host_type("calculated_host_listings_count", multi_above)
        )
    if "availability_365" in out.columns:
        out = occupancy_columns(out, capacity=capacity, threshold=threshold)
    return out


def clean_calendar(df: DataFrame, account: Observation | None = None) -> DataFrame:
    """The raw price is never filled in the source and is dropped."""
    out = read_columns(
        df.drop("price"),
        {
            "date": parsing.iso_date("date"),
            "available": parsing.flag("available"),
            "adjusted_price": parsing.money("adjusted_price"),
            "minimum_nights": parsing.number("minimum_nights", "int"),
            "maximum_nights": parsing.number("maximum_nights", "int"),
        },
        account,
    )
    return out.withColumns(parsing.date_parts("date"))


def clean_reviews(df: DataFrame, account: Observation | None = None) -> DataFrame:
    """One review per listing, day and, where the source names one, reviewer."""
    parts = parsing.date_parts("date")
    dated = read_columns(df, {"date": parsing.iso_date("date")}, account)
    kept = dedupe(dated, ["listing_id", "reviewer_id", "date"])
    return kept.withColumns({"year": parts["year"], "month": parts["month"]})


def clean_neighbourhoods(df: DataFrame, city: str = "city") -> DataFrame:
    levels = [city, "neighbourhood_group", "neighbourhood"]
    return dedupe(df.dropna(subset=levels[1:]), levels).orderBy(*levels)
