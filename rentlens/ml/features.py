"""Features for the price and demand models."""

import math
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, replace

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import labels, numeric
from ..operators.distributions import exact_quantiles
from ..operators.occupancy import LISTING, listing_months
from ..sources import tables
from ..sources.scratch import new_folder, remove_folder, stored

# Feature names, defaults and leak lists that a trained model depends on.
NUMERIC = (
    "minimum_nights",
    "number_of_reviews",
    "number_of_reviews_ltm",
    "reviews_per_month",
    "calculated_host_listings_count",
    "availability_365",
    "latitude",
    "longitude",
    "accommodates",
    "bedrooms",
    "beds",
    "bathrooms",
    "review_scores_rating",
    "review_scores_cleanliness",
    "review_scores_location",
    "review_scores_value",
    "amenity_count",
    "estimated_occupancy_l365d",
    "occupancy_rate",
    "log_reviews",
    "log_host_listings",
    "recent_activity_ratio",
    "neighbourhood_listing_count",
    "neighbourhood_mean_log_price",
)
DERIVED_NUMERIC = NUMERIC[-6:]
CATEGORICAL = (
    "city",
    "room_type",
    "neighbourhood_group",
    "min_nights_cat",
    "property_type",
    "host_is_superhost",
    "instant_bookable",
)
CARRIED = (
    "id",
    "price",
    "is_high_occupancy",
    "is_high_demand_month",
    "monthly_occupancy_rate",
    "year",
    "month",
)
DEFAULTS = {
    "minimum_nights": 1,
    "number_of_reviews": 0,
    "number_of_reviews_ltm": 0,
    "reviews_per_month": 0.0,
    "calculated_host_listings_count": 1,
    "recent_activity_ratio": 0.0,
    "occupancy_rate": 0.5,
    "accommodates": 2,
    "bedrooms": 1,
    "beds": 1,
    "bathrooms": 1.0,
    "review_scores_rating": 4.7,
    "review_scores_cleanliness": 4.7,
    "review_scores_location": 4.7,
    "review_scores_value": 4.5,
    "amenity_count": 20,
    "estimated_occupancy_l365d": 0.0,
}
# Ours, for numbers without a default above: estimators refuse gaps. They agree with the defaults of the
# columns they are derived from.
GAP_DEFAULTS = {
    "availability_365": 182.5,
    "latitude": 0.0,
    "longitude": 0.0,
    "log_reviews": 0.0,
    "log_host_listings": math.log(2.0),
}
AVAILABILITY_LEAKS = (
    "availability_30",
    "availability_60",
    "availability_90",
    "availability_365",
    "occupancy_rate",
    "booked_nights_365",
    "estimated_revenue_365",
)
TEMPORAL = ("month", "sin_month", "cos_month")


@dataclass(frozen=True)
class TargetEncoding:
    """Mean log target and size per group, as learned from the training rows.

    ``defaults`` has one row, used for groups the training rows do not contain. Both stay DataFrames;
    nothing is brought to the driver.
    """

    groups: DataFrame
    defaults: DataFrame
    group: str = "neighbourhood"
    mean_name: str = "neighbourhood_mean_log_price"
    count_name: str = "neighbourhood_listing_count"
    scratch: str | None = None

    def apply(self, df: DataFrame) -> DataFrame:
        """Add the encoding to any split; rows are kept, unknown and NULL groups take the defaults."""
        default = self.defaults.select(F.struct("mean_log", "mean_count")).scalar()
        known = self.groups.select(self.group, self.mean_name, self.count_name)
        return df.join(known, self.group, "left").withColumns(
            {
                self.mean_name: F.coalesce(F.col(self.mean_name), default["mean_log"]),
                self.count_name: F.coalesce(F.col(self.count_name).cast("double"), default["mean_count"]),
            }
        )

    def stored(self) -> "TargetEncoding":
        """The same encoding read back from the shared folder, for plans that apply it many times."""
        spark = self.groups.sparkSession
        path = new_folder(spark, "encoding")
        self.save(path)
        read = tables.read_table
        groups, defaults = read(spark, f"{path}/groups"), read(spark, f"{path}/defaults")
        return replace(self, groups=groups, defaults=defaults, scratch=path)

    def discard(self) -> None:
        """Remove the scratch tables of ``stored``; plans that still read them fail afterwards."""
        if self.scratch:
            remove_folder(self.groups.sparkSession, self.scratch)

    def save(self, path: str) -> None:
        self.groups.write.mode("overwrite").parquet(f"{path}/groups")
        self.defaults.write.mode("overwrite").parquet(f"{path}/defaults")

    @classmethod
    def load(cls, spark: SparkSession, path: str, **names) -> "TargetEncoding":
        read = tables.read_table
        return cls(read(spark, f"{path}/groups"), read(spark, f"{path}/defaults"), **names)


def fit_target_encoding(
    train: DataFrame,
    group: str = "neighbourhood",
    target: str = "price",
    key: str = "id",
    mean_name: str = "neighbourhood_mean_log_price",
    count_name: str = "neighbourhood_listing_count",
) -> TargetEncoding:
    """Learn the encoding. The defaults come from the group rows, so the training rows are read once.

    The default size divides by all groups, the NULL group included.
    """
    log_target = F.log1p(target)
    groups = train.groupBy(group).agg(
        numeric.exact_avg(log_target).alias(mean_name),
        F.count(key).alias(count_name),
        numeric.exact_sum(log_target).alias("log_sum"),
        F.count(log_target).alias("n_targets"),
        F.count("*").alias("n_rows"),
    )
    defaults = groups.agg(
        numeric.exact_mean("log_sum", F.sum("n_targets")).alias("mean_log"),
        numeric.ratio(F.sum("n_rows"), F.count("*")).alias("mean_count"),
    )
    return TargetEncoding(groups, defaults, group, mean_name, count_name)


def fold_of(key: str | Sequence[str], folds: int, seed: int = 17) -> Column:
    """Fold of a row by its key, from 0; rows of one key share a fold, under any layout."""
    keys = [key] if isinstance(key, str) else list(key)
    return numeric.hash_bucket(*keys, buckets=folds, seed=seed).cast("int")


@dataclass(frozen=True)
class FoldEncoding:
    """The encoding for the training rows themselves: the mean log target of a group over the other folds.

    A row's own target, and that of its key's other rows, takes no part in its mean, so a model cannot read the label off a
    small group. A group without targets in the other folds, and the NULL group, take the mean of all rows of the other
    folds. Sizes of groups say nothing of the target and are those of all rows. New rows are encoded by
    ``fit_target_encoding``.
    """

    folds: int = 5
    group: str = "neighbourhood"
    target: str = "price"
    key: str = "id"
    mean_name: str = "neighbourhood_mean_log_price"
    count_name: str = "neighbourhood_listing_count"
    seed: int = 17

    def __post_init__(self):
        if self.folds < 2:
            raise ValueError(f"a row needs another fold: folds is {self.folds}")

    def sums(self, df: DataFrame) -> DataFrame:
        """One row per group and fold, the only reduction of the rows."""
        log_target = F.log1p(self.target)
        millionths, rest = numeric.exact_parts(log_target)
        return df.groupBy(self.group, fold_of(self.key, self.folds, self.seed).alias("_fold")).agg(
            millionths.alias("_whole"),
            F.coalesce(rest, F.lit(0.0)).alias("_rest"),
            F.count(log_target).alias("_n"),
            F.count(self.key).alias("_keys"),
            F.count("*").alias("_rows"),
        )

    def apply(self, df: DataFrame) -> DataFrame:
        """Add the encoding to the rows it is learned from; rows are kept. The means are learned and stored when this is
        called (``scratch.clear`` removes them), so what follows are joins of two small tables."""
        parts, names = stored(self.sums(df), "fold-sums"), ("_whole", "_rest", "_n")
        group = Window.partitionBy(self.group)
        groups = parts.select(
            self.group,
            "_fold",
            "_rows",
            numeric.mean_of(*[F.sum(c).over(group) - F.col(c) for c in names]).alias(self.mean_name),
            F.sum("_keys").over(group).cast("double").alias(self.count_name),
            (F.col("_fold") == F.min("_fold").over(group)).alias("_first"),
        )
        by_fold = parts.groupBy("_fold").agg(*[F.sum(c).alias(c) for c in names])
        whole = by_fold.agg(F.struct(*[F.sum(c).alias(c) for c in names])).scalar()
        size = groups.agg(numeric.ratio(F.sum("_rows"), F.count_if("_first"))).scalar()
        mean = numeric.mean_of(*[whole[c] - F.col(c) for c in names])
        others = stored(by_fold.select("_fold", mean.alias("_mean"), size.alias("_size")), "fold-means")
        kept = df.drop(self.mean_name, self.count_name)
        known = stored(groups.select(self.group, "_fold", self.mean_name, self.count_name), "group-means")
        marked = kept.withColumn("_fold", fold_of(self.key, self.folds, self.seed))
        return (
            marked.join(known, [self.group, "_fold"], "left")
            .join(others, "_fold", "left")
            .select(
                *[f"`{c}`" for c in kept.columns],
                F.coalesce(self.mean_name, "_mean").alias(self.mean_name),
                F.when(F.col(self.group).isNull(), F.col("_size")).otherwise(F.col(self.count_name)).alias(self.count_name),
            )
        )


def activity_ratio(recent: str = "number_of_reviews_ltm", total: str = "number_of_reviews") -> Column:
    return F.col(recent) / (F.col(total) + F.lit(1.0))


def engineer(df: DataFrame, encoding: TargetEncoding | FoldEncoding, capacity: float = 365.0) -> DataFrame:
    """Add all derived features."""
    return encoding.apply(derived(df, capacity))


def derived(df: DataFrame, capacity: float = 365.0) -> DataFrame:
    """Add the derived features that are learned from no other row."""
    return df.withColumns(
        {
            "occupancy_rate": numeric.occupancy("availability_365", capacity),
            "log_reviews": F.log1p("number_of_reviews"),
            "log_host_listings": F.log1p("calculated_host_listings_count"),
            "recent_activity_ratio": activity_ratio(),
            "min_nights_cat": labels.nights_bucket("minimum_nights"),
        }
    )


def model_columns(
    df: DataFrame, leaks: Iterable[str] = (), extra_numeric: Iterable[str] = ()
) -> tuple[list[str], list[str]]:
    """Numeric and categorical features that the table has and the target does not leak into."""
    leaks = set(leaks)
    usable = [c for c in df.columns if c not in leaks]
    numeric_names = [c for c in (*NUMERIC, *extra_numeric) if c in usable]
    return numeric_names, [c for c in CATEGORICAL if c in usable]


def select_and_fill(
    df: DataFrame,
    leaks: Iterable[str] = (),
    extra_numeric: Iterable[str] = (),
    defaults: Mapping[str, object] = DEFAULTS,
    carried: Sequence[str] = CARRIED,
) -> DataFrame:
    """Project to features and carried columns; categories become text without gaps, and the numbers
    that have a default are filled. Other numbers keep their gaps."""
    numbers, categories = model_columns(df, leaks, extra_numeric)
    kept = [c for c in dict.fromkeys(carried) if c in df.columns and c not in numbers]
    text = [F.coalesce(F.col(c).cast("string"), F.lit("unknown")).alias(c) for c in categories]
    filled = {c: v for c, v in defaults.items() if c in numbers}
    out = df.select(*numbers, *text, *kept)
    return out.fillna(filled) if filled else out


def model_input(
    df: DataFrame,
    encoding: TargetEncoding | FoldEncoding,
    leaks: Iterable[str] = (),
    extra_numeric: Iterable[str] = (),
    carried: Sequence[str] = CARRIED,
) -> DataFrame:
    """Everything between a listings table and the estimator, the same for training and scoring."""
    selected = select_and_fill(engineer(df, encoding), leaks, extra_numeric, carried=carried)
    gaps = {c: v for c, v in GAP_DEFAULTS.items() if c in selected.columns}
    return selected.fillna(gaps) if gaps else selected


def feature_stages(
    categorical: Sequence[str] = CATEGORICAL, numbers: Sequence[str] = NUMERIC, scaled: bool = True
) -> list:
    """Index and encode categories, assemble, scale to unit deviation without centring."""
    indexed, encoded = [f"{c}_idx" for c in categorical], [f"{c}_oh" for c in categorical]
    stages = []
    if categorical:
        stages = [
            StringIndexer(inputCols=list(categorical), outputCols=indexed, handleInvalid="keep"),
            OneHotEncoder(inputCols=indexed, outputCols=encoded, handleInvalid="keep"),
        ]
    assembled = "features_raw" if scaled else "features"
    stages.append(
        VectorAssembler(inputCols=[*numbers, *encoded], outputCol=assembled, handleInvalid="keep")
    )
    if scaled:
        stages.append(StandardScaler(inputCol=assembled, outputCol="features", withMean=False))
    return stages


def fit_features(df: DataFrame, categorical=CATEGORICAL, numbers=NUMERIC) -> PipelineModel:
    return Pipeline(stages=feature_stages(categorical, numbers)).fit(df)


def split(df: DataFrame, key: str | Sequence[str] = "id", train_percent: int = 80, seed: int = 42):
    """Train and test rows by key, the same rows under any layout; rows of one key stay together."""
    keys = [key] if isinstance(key, str) else list(key)
    bucket = numeric.hash_bucket(*keys, seed=seed)
    return df.where(bucket < train_percent), df.where(bucket >= train_percent)


def sample(df: DataFrame, percent: int | None, key: str = "id", seed: int = 7) -> DataFrame:
    """A percentage of the rows by key, all rows without one. The seed is not that of the split."""
    return df if percent is None else df.where(numeric.hash_bucket(key, seed=seed) < percent)


def price_cap(df: DataFrame, price: str = "price", p: float = 0.99) -> DataFrame:
    """One row with the price below which the given share of all rows lies."""
    return exact_quantiles(df, price, {"cap": p}, method="lower").select("cap")


def within_cap(
    df: DataFrame, price: str = "price", floor: float = 10, cap: Column | float | None = None
) -> DataFrame:
    """Rows with a price from the floor to the cap, both included; the cap of the table if none is given."""
    return df.where(F.col(price).between(floor, price_cap(df, price).scalar() if cap is None else cap))


def class_weights(train: DataFrame, label: str = "label", low: float = 0.35, high: float = 0.65) -> DataFrame:
    """Add the inverse class frequency as weight where the positive share is outside [low, high]."""
    base = train.agg(numeric.ratio(F.count_if(F.col(label) == 1), F.count(label)).alias("base")).scalar()
    inverse = F.when(
        F.col(label) == 1, numeric.ratio(F.lit(1.0), base)
    ).otherwise(numeric.ratio(F.lit(1.0), F.lit(1.0) - base))
    return train.withColumn("weight", F.when((base < low) | (base > high), inverse).otherwise(F.lit(1.0)))


def monthly_demand(
    calendar: DataFrame,
    listings: DataFrame,
    flag: str = "available",
    key: str = "id",
    min_days: int = 20,
    busy_above: float = 0.50,
    keep: Sequence[str] = ("city",),
) -> DataFrame:
    """Listing-months with enough days: booked share, busy label, cyclic month, listing columns."""
    months = (
        listing_months(calendar.where(F.col("date").isNotNull()), flag, keep=keep)
        .where(F.col("n_days") >= min_days)
        .withColumn("monthly_occupancy_rate", numeric.ratio("n_booked", "n_known"))
        .drop("n_known", "n_free", "n_booked")
    )
    attributes = listings.drop(*[c for c in keep if c in months.columns])
    sine, cosine = numeric.cyclic("month")
    return (
        months.join(attributes, F.col(LISTING) == F.col(key), "inner")
        .withColumn("month", F.col("month").cast("double"))
        .withColumns(
            {
                "sin_month": sine,
                "cos_month": cosine,
                "is_high_demand_month": (F.col("monthly_occupancy_rate") > busy_above).cast("double"),
            }
        )
    )
