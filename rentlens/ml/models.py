"""Price and demand models: training, comparison, importance, batch scoring."""

from collections.abc import Callable, Iterable, Mapping, Sequence
from contextlib import contextmanager
from dataclasses import dataclass
from functools import reduce
from multiprocessing.pool import ThreadPool

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.scratch import new_folder, remove_folder, use_checkpoints
from . import evaluation, features, forests
from .features import TargetEncoding

# The hyper-parameters of each model.
PRICE_MODELS: dict[str, tuple[Callable, dict]] = {
    "lr": (LinearRegression, {"regParam": 0.01, "elasticNetParam": 0.0}),
    "rf": (RandomForestRegressor, {"numTrees": 100, "maxDepth": 8, "minInstancesPerNode": 10, "seed": 42}),
    "gbt": (
        GBTRegressor,
        {
            "maxIter": 200,
            "maxDepth": 6,
            "stepSize": 0.05,
            "minInstancesPerNode": 5,
            "subsamplingRate": 0.8,
            "seed": 42,
        },
    ),
}
DEMAND_MODELS: dict[str, tuple[Callable, dict]] = {
    "logreg": (LogisticRegression, {"maxIter": 100, "family": "binomial", "weightCol": "weight"}),
    "rf": (
        RandomForestClassifier,
        # Deep trees: each pass would send the whole forest with every task. Cached node ids change no split.
        {"numTrees": 150, "maxDepth": 12, "seed": 42, "weightCol": "weight", "cacheNodeIds": True},
    ),
}
BENCHMARK_NUMERIC = (
    "accommodates",
    "bedrooms",
    "beds",
    "minimum_nights",
    "number_of_reviews",
    "reviews_per_month",
    "review_scores_rating",
    "latitude",
    "longitude",
)
BENCHMARK_FOREST = {"numTrees": 50, "maxDepth": 8, "seed": 42}
# Training rows of a partition, and the fewest partitions: the layout of a fit follows its rows, not the machine.
PARTITION_ROWS = 1_000_000
PARTITIONS = 8
# Training rows beyond which trees are grown over binned rows (``forests``): MLlib's own rows no longer fit memory then, and
# below it a pass of MLlib takes less than starting Python tasks.
LARGE_ROWS = 500_000


@dataclass(frozen=True)
class Trained:
    """A fitted pipeline with what scoring needs, its test predictions and its one-row metrics."""

    model: PipelineModel
    encoding: TargetEncoding
    predictions: DataFrame
    metrics: DataFrame
    scratch: tuple[str, ...] = ()

    def save(self, path: str) -> None:
        self.model.write().overwrite().save(f"{path}/model")
        self.encoding.save(f"{path}/encoding")
        self.metrics.write.mode("overwrite").parquet(f"{path}/metrics")

    def discard(self) -> None:
        """Remove what the training left in the shared folder, once metrics and predictions are used."""
        self.encoding.discard()
        for path in self.scratch:
            remove_folder(self.metrics.sparkSession, path)


def load(spark: SparkSession, path: str) -> tuple[PipelineModel, TargetEncoding]:
    return PipelineModel.load(f"{path}/model"), TargetEncoding.load(spark, f"{path}/encoding")


def _estimator(catalog: Mapping, algo: str, changes: Mapping | None):
    if algo not in catalog:
        raise KeyError(f"unknown algorithm {algo!r}; known: {', '.join(catalog)}")
    kind, parameters = catalog[algo]
    return kind(featuresCol="features", labelCol="label", **{**parameters, **(changes or {})})


def partitions_for(train: DataFrame) -> int:
    """How many partitions a fit deals these rows into."""
    return max(PARTITIONS, -(-train.count() // PARTITION_ROWS))


def _kept(rows: DataFrame, label: str) -> tuple[DataFrame, str]:
    """The rows written to the shared folder and read back, with the folder: a training reads them many times, the joins
    that make them run once."""
    path = new_folder(rows.sparkSession, label)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path), path


def _needed(rows: DataFrame, *more: str) -> DataFrame:
    """The columns that a training reads."""
    used = {"neighbourhood", *features.NUMERIC, *features.CATEGORICAL, *features.CARRIED, *features.TEMPORAL, *more}
    return rows.select(*[f"`{c}`" for c in rows.columns if c in used])


@contextmanager
def held(train: DataFrame, key: str, partitions: int, order: Sequence[str] = ()):
    """Keep training rows for the duration of a fit, which reads them once per tree level or iteration.

    They spill to disk where memory ends. Rows are always dealt by key into ``partitions`` and sorted,
    so a fit sees the same layout on any number of cores.
    """
    spread = train.repartition(partitions, key).sortWithinPartitions(*dict.fromkeys((key, *order)))
    kept = spread.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield kept
    finally:
        kept.unpersist()


def fit_all(
    train: DataFrame,
    estimators: Sequence,
    numbers: Sequence[str],
    categories: Sequence[str],
    key: str = "id",
    partitions: int | None = None,
) -> list[PipelineModel]:
    """Fit features once and every estimator on them. Estimators are fitted at the same time: a boosted tree level leaves
    cores idle that another fit can use."""
    use_checkpoints(train.sparkSession)
    order = [c for c in ("year", "month") if c in train.columns]
    with held(train, key, partitions or partitions_for(train), order) as rows:
        prepared = Pipeline(stages=features.feature_stages(categories, numbers)).fit(rows)
        ready = prepared.transform(rows)
        large = any(map(forests.covers, estimators)) and rows.count() > LARGE_ROWS

        def fitted(e) -> PipelineModel:
            by_bins = large and forests.covers(e)
            model = forests.fit(e, ready, prepared.stages, numbers, categories) if by_bins else e.fit(ready)
            if isinstance(e, RandomForestClassifier) and model.hasSummary:
                # The summary holds the session, which cannot travel with tasks once it has observed a plan.
                model._java_obj.setSummary(train.sparkSession._jvm.scala.Option.empty())
            return PipelineModel([*prepared.stages, model])

        if len(estimators) == 1:
            return [fitted(estimators[0])]
        wrapped = inheritable_thread_target(train.sparkSession)
        tasks = [wrapped(lambda e=e: fitted(e)) for e in estimators]
        with ThreadPool(len(tasks)) as pool:
            return pool.map(lambda task: task(), tasks, chunksize=1)


def fit(
    train: DataFrame,
    estimator,
    numbers: Sequence[str],
    categories: Sequence[str],
    key: str = "id",
    partitions: int | None = None,
) -> PipelineModel:
    """Fit features and estimator."""
    return fit_all(train, [estimator], numbers, categories, key, partitions)[0]


def _sized(metrics: DataFrame, name: str, train: DataFrame, test: DataFrame) -> DataFrame:
    return metrics.select(
        F.lit(name).alias("algo"),
        train.agg(F.count("*")).scalar().alias("n_train"),
        test.agg(F.count("*")).scalar().alias("n_test"),
        "*",
    )


def train_prices(
    listings: DataFrame,
    algos: Sequence[str],
    changes: Mapping | None = None,
    key: str = "id",
    sample: int | None = None,
    folds: int | None = None,
) -> list[Trained]:
    """Models of the log price over the same rows. ``sample`` keeps that percentage of the listings, chosen by key. With
    ``folds``, training rows are encoded by the targets of the other folds; test rows and scoring use the encoding of all
    training rows either way.

    The listings are stored once, as cap, encoding, fit, sizes and test each read them. The price cap is one number that
    every later plan filters by, so it is settled once and reaches the scans as a literal.
    """
    estimators = [_estimator(PRICE_MODELS, algo, changes) for algo in algos]
    listings, path = _kept(_needed(features.sample(listings, sample, key), key), "listings")
    cap = features.price_cap(listings).first()["cap"]
    train_rows, test_rows = features.split(features.within_cap(listings, cap=cap), key)
    encoding = features.fit_target_encoding(train_rows, key=key).stored()

    def prepared(rows: DataFrame, by=encoding) -> DataFrame:
        return features.model_input(rows, by, carried=(key, *features.CARRIED)).withColumn("label", F.log1p("price"))

    train = prepared(train_rows, features.FoldEncoding(folds, key=key) if folds else encoding)
    numbers, categories = features.model_columns(train)
    found = []
    for algo, model in zip(algos, fit_all(train, estimators, numbers, categories, key), strict=True):
        predictions = model.transform(prepared(test_rows)).withColumn("prediction_price", F.expm1("prediction"))
        # Both scales from one pass over the predictions.
        sized = _sized(price_metrics(predictions), algo, train_rows, test_rows)
        found.append(Trained(model, encoding, predictions, sized.withColumn("price_cap", F.lit(cap)), (path,)))
    return found


def train_price(
    listings: DataFrame,
    algo: str = "gbt",
    changes: Mapping | None = None,
    key: str = "id",
    sample: int | None = None,
    folds: int | None = None,
) -> Trained:
    """One model of the log price; see ``train_prices``."""
    return train_prices(listings, [algo], changes, key, sample, folds)[0]


def price_metrics(predictions: DataFrame) -> DataFrame:
    """Metrics of the log label and of the price itself."""
    scales = F.array(
        F.struct(F.lit("log").alias("scale"), F.col("label").alias("y"), F.col("prediction").alias("p")),
        F.struct(F.lit("price").alias("scale"), F.col("price").cast("double").alias("y"), F.col("prediction_price").alias("p")),
    )
    error = F.col("y") - F.col("p")
    by_scale = (
        predictions.select(F.inline(scales))
        .groupBy("scale")
        .agg(
            F.avg(error * error).alias("mse"),
            F.avg(F.abs(error)).alias("mae"),
            F.var_pop("y").alias("spread"),
        )
    )

    def of(scale: str, value: Column) -> Column:
        return F.max(F.when(F.col("scale") == scale, value))

    r2 = F.lit(1.0) - F.try_divide(F.col("mse"), F.col("spread"))
    return by_scale.agg(
        *[
            of(scale, value).alias(f"{name}_{scale}")
            for scale in ("log", "price")
            for name, value in (("rmse", F.sqrt("mse")), ("mae", F.col("mae")), ("r2", r2))
        ]
    )


def _train_classifier(
    rows: DataFrame, label: str, estimator, name: str, key: str, extra_numeric: Iterable[str] = ()
) -> Trained:
    rows, path = _kept(_needed(rows, key, label, *extra_numeric), "training-rows")
    train_rows, test_rows = features.split(rows, key)
    encoding = features.fit_target_encoding(train_rows, key=key).stored()
    leaks = features.AVAILABILITY_LEAKS

    def prepared(part: DataFrame) -> DataFrame:
        selected = features.model_input(part, encoding, leaks, extra_numeric, carried=(key, *features.CARRIED))
        return selected.withColumn("label", F.col(label).cast("double"))

    train = features.class_weights(prepared(train_rows))
    numbers, categories = features.model_columns(train, leaks, extra_numeric)
    model = fit(train, estimator, numbers, categories, key)
    predictions = model.transform(prepared(test_rows))
    # Both measures read the scores, which are made once.
    judged, scores = _kept(predictions.select("label", "prediction", "rawPrediction"), "scores")
    metrics = evaluation.classification_metrics(judged).withColumn("auc", F.lit(evaluation.area_under_roc(judged)))
    return Trained(model, encoding, predictions, _sized(metrics, name, train_rows, test_rows), (path, scores))


def train_occupancy(
    listings: DataFrame,
    algo: str = "rf",
    changes: Mapping | None = None,
    key: str = "id",
    label: str = "is_high_occupancy",
    sample: int | None = None,
) -> Trained:
    """Classifier of highly occupied listings, without the columns availability leaks into."""
    rows = features.sample(listings.where(F.col(label).isNotNull()), sample, key)
    return _train_classifier(rows, label, _estimator(DEMAND_MODELS, algo, changes), algo, key)


def train_monthly_occupancy(
    months: DataFrame,
    changes: Mapping | None = None,
    key: str = "listing_id",
    label: str = "is_high_demand_month",
    sample: int | None = None,
) -> Trained:
    """Classifier of busy listing-months. All months of a listing are on the same side of the split, and
    in or out of a sample."""
    rows = features.sample(months.where(F.col(label).isNotNull()), sample, key)
    estimator = _estimator(DEMAND_MODELS, "rf", changes)
    return _train_classifier(rows, label, estimator, "monthly_rf", key, features.TEMPORAL)


def compare(trained: Sequence[Trained]) -> DataFrame:
    """Metric rows of several models."""
    return reduce(DataFrame.unionByName, [t.metrics for t in trained])


def train_forest_benchmark(
    listings: DataFrame,
    numbers: Sequence[str] = BENCHMARK_NUMERIC,
    categories: Sequence[str] = ("room_type", "city"),
    price: str = "price",
    low: float = 10,
    high: float = 1000,
    key: str = "id",
    changes: Mapping | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """The timed forest: indexed categories, numbers with gaps as zero, log price, RMSE and R²."""
    rows = (
        listings.select(key, *[F.col(c).cast("double").alias(c) for c in numbers], *categories, F.col(price).cast("double").alias("price"))
        .where(F.col("price").between(low, high))
        .fillna(0, subset=list(numbers))
        .withColumn("log_price", F.log1p("price"))
    )
    rows, _ = _kept(rows, "benchmark")
    train, test = features.split(rows, key)
    indexed = [f"{c}_idx" for c in categories]
    stages = [
        StringIndexer(inputCols=list(categories), outputCols=indexed, handleInvalid="keep"),
        VectorAssembler(inputCols=[*numbers, *indexed], outputCol="features", handleInvalid="keep"),
        RandomForestRegressor(
            featuresCol="features", labelCol="log_price", **{**BENCHMARK_FOREST, **(changes or {})}
        ),
    ]
    with held(train, key, partitions or partitions_for(train)) as rows_kept:
        model = Pipeline(stages=stages).fit(rows_kept)
    metrics = evaluation.regression_metrics(model.transform(test), "log_price")
    return metrics.select(rows.agg(F.count("*")).scalar().alias("n_rows"), "rmse", "r2")


def feature_importance(model: PipelineModel, sample: DataFrame) -> DataFrame:
    """Importance per source column, the slots of a category added up, largest first.

    Slot names come from the assembled vector's own metadata, so every slot of a category, the one for
    unseen values included, is counted with its column.
    """
    assembler = next(s for s in model.stages if isinstance(s, VectorAssembler))
    assembled = model.transform(sample.limit(0)).schema[assembler.getOutputCol()]
    slots = [a for group in assembled.metadata["ml_attr"]["attrs"].values() for a in group]
    encoded = {f"{c}_": c.removesuffix("_oh") for c in assembler.getInputCols() if c.endswith("_oh")}

    def source(slot: str) -> str:
        return next((c for prefix, c in encoded.items() if slot.startswith(prefix)), slot)

    estimator = model.stages[-1]
    if hasattr(estimator, "featureImportances"):
        weights = estimator.featureImportances.toArray()
    elif hasattr(estimator, "coefficients"):
        # Features have unit deviation, so the sizes of their coefficients compare; they are scaled to sum to one.
        weights = abs(estimator.coefficients.toArray())
        weights = weights / (weights.sum() or 1.0)
    else:
        raise TypeError(f"{type(estimator).__name__} has neither importances nor coefficients")
    rows = [(source(a["name"]), float(weights[a["idx"]])) for a in slots]
    return (
        sample.sparkSession.createDataFrame(rows, "feature string, importance double")
        .groupBy("feature")
        .agg(F.sum("importance").alias("importance"))
        .orderBy(F.col("importance").desc(), "feature")
    )


def score(
    df: DataFrame,
    model: PipelineModel,
    encoding: TargetEncoding,
    leaks: Iterable[str] = (),
    extra_numeric: Iterable[str] = (),
    keys: Sequence[str] = ("id",),
) -> DataFrame:
    """Score a whole table: price for a regression, probability of the positive class otherwise.

    ``keys`` name the rows of the result.
    """
    carried = tuple(dict.fromkeys((*keys, *features.CARRIED)))
    scored = model.transform(features.model_input(df, encoding, leaks, extra_numeric, carried))
    if "probability" in scored.columns:
        return scored.select(*keys, "prediction", vector_to_array("probability")[1].alias("probability"))
    return scored.select(*keys, "prediction", F.expm1("prediction").alias("predicted_price"))


