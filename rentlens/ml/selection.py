"""Parameters chosen over folds, and the importance of columns by permutation."""

import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace

from pyspark.ml import Estimator, Model, Pipeline, PipelineModel
from pyspark.ml.evaluation import Evaluator, RegressionEvaluator
from pyspark.ml.tuning import CrossValidator
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import numeric
from ..sources.scratch import stored, use_checkpoints
from . import features, models

# Rows that exchange values among each other when a column is permuted.
EXCHANGED = 10_000


class GroupEncoder(Estimator):
    """Target encoding as a pipeline stage, learned anew from the rows of every fit: in a selection no candidate sees the
    targets of the fold it is measured on. ``names`` are arguments of ``fit_target_encoding``."""

    def __init__(self, **names: str):
        super().__init__()
        self.names = names

    def _fit(self, dataset: DataFrame) -> "GroupEncoderModel":
        learned = features.fit_target_encoding(dataset, **self.names)
        groups, defaults = stored(learned.groups, "groups"), stored(learned.defaults, "defaults")
        return GroupEncoderModel(replace(learned, groups=groups, defaults=defaults))


class GroupEncoderModel(Model):
    def __init__(self, encoding: features.TargetEncoding):
        super().__init__()
        self.encoding = encoding

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return self.encoding.apply(dataset)


@dataclass(frozen=True)
class Selection:
    """The chosen parameters, a row per candidate, and the chosen candidate fitted to all rows."""

    best: Mapping[str, object]
    table: DataFrame
    model: PipelineModel


def fold_sizes(rows: DataFrame, key: str | Sequence[str] = "id", folds: int = 3, seed: int = 17) -> DataFrame:
    """Rows that are fitted and held back for each fold that has any, from one pass."""
    held = rows.groupBy(features.fold_of(key, folds, seed).alias("fold")).agg(F.count("*").alias("n_held"))
    everything = F.sum("n_held").over(Window.partitionBy(F.lit(0)))
    return held.select("fold", (everything - F.col("n_held")).alias("n_fit"), "n_held")


def select_over_folds(
    rows: DataFrame,
    stages: Sequence,
    grid: Sequence[Mapping[str, object]],
    evaluator: Evaluator,
    key: str = "id",
    folds: int = 3,
    seed: int = 17,
    partitions: int = models.PARTITIONS,
    parallelism: int = 1,
) -> Selection:
    """Choose parameters of the last stage by the mean metric over folds of the key.

    ``grid`` has the candidates, as parameter names and values; the first of equally good ones is chosen. Rows of one key
    are in one fold, so no candidate is measured on a key it learned from. An empty fold is an error.
    """
    if not grid:
        raise ValueError("no candidates to choose from")
    use_checkpoints(rows.sparkSession)
    maps = [{stages[-1].getParam(name): value for name, value in candidate.items()} for candidate in grid]
    search = CrossValidator(
        estimator=Pipeline(stages=list(stages)),
        estimatorParamMaps=maps,
        evaluator=evaluator,
        numFolds=folds,
        foldCol="_fold",
        parallelism=parallelism,
    )
    with models.held(rows.withColumn("_fold", features.fold_of(key, folds, seed)), key, partitions) as kept:
        found = search.fit(kept)
    pick = max if evaluator.isLargerBetter() else min
    chosen = found.avgMetrics.index(pick(found.avgMetrics))
    table = [
        (i, json.dumps(candidate, sort_keys=True), float(mean), float(spread), i == chosen)
        for i, (candidate, mean, spread) in enumerate(zip(grid, found.avgMetrics, found.stdMetrics, strict=True))
    ]
    schema = "candidate int, parameters string, mean_metric double, std_metric double, chosen boolean"
    return Selection(grid[chosen], rows.sparkSession.createDataFrame(table, schema), found.bestModel)


def price_rows(listings: DataFrame, key: str = "id") -> DataFrame:
    """Listings up to the price cap with every price feature but the target encoding, and the log price as label."""
    cap = features.price_cap(listings).first()["cap"]
    derived = features.derived(features.within_cap(listings, cap=cap))
    kept = features.select_and_fill(derived, carried=(key, "neighbourhood", *features.CARRIED))
    gaps = {c: v for c, v in features.GAP_DEFAULTS.items() if c in kept.columns}
    return (kept.fillna(gaps) if gaps else kept).withColumn("label", F.log1p("price"))


def select_price(
    listings: DataFrame,
    algo: str,
    grid: Sequence[Mapping[str, object]],
    key: str = "id",
    folds: int = 3,
    seed: int = 17,
    metric: str = "rmse",
) -> Selection:
    """Choose the parameters of a price model on the training side of the split, which ``train_price`` uses too: its
    ``changes`` take ``best``, and its test rows have had no part in the choice."""
    train, _ = features.split(price_rows(listings, key), key)
    numbers, categories = features.model_columns(train)
    encoder = GroupEncoder(key=key)
    numbers += [c for c in ("neighbourhood_listing_count", "neighbourhood_mean_log_price") if c not in numbers]
    stages = [encoder, *features.feature_stages(categories, numbers), models._estimator(models.PRICE_MODELS, algo, None)]
    return select_over_folds(train, stages, grid, RegressionEvaluator(labelCol="label", metricName=metric), key, folds, seed)


def permuted(
    rows: DataFrame, columns: Sequence[str], key: str | Sequence[str] = "id", seed: int = 9, exchanged: int = EXCHANGED
) -> DataFrame:
    """Add ``_other``: the columns of another row, each row's values going to exactly one row.

    Rows are dealt by a digest of their key into groups of about ``exchanged`` rows; in the order of the digest, a row gets
    the values of the next one and the last those of the first. That is one shuffle, no task orders more than some such
    groups, and under any layout the same row is next as long as keys are unique. A row alone in its group keeps its own.
    """
    keys = [key] if isinstance(key, str) else list(key)
    groups = rows.agg(F.greatest(F.ceil(F.count("*") / F.lit(exchanged)), F.lit(1))).scalar()
    marked = rows.withColumns(
        {"_group": numeric.hash_bucket(*keys, buckets=groups, seed=seed), "_digest": numeric.digest(*keys, seed=seed)}
    )
    order = Window.partitionBy("_group").orderBy("_digest", *keys)
    values = F.struct(*columns)
    first = F.first(values).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return marked.withColumn("_other", F.coalesce(F.lead(values).over(order), first)).drop("_group", "_digest")


def squared_error(label: str = "label", prediction: str = "prediction") -> Column:
    error = F.col(label).cast("double") - F.col(prediction).cast("double")
    return error * error


def permutation_importance(
    model: Model,
    rows: DataFrame,
    columns: Sequence[str],
    key: str | Sequence[str] = "id",
    loss: Column | None = None,
    seed: int = 9,
    exchanged: int = EXCHANGED,
) -> DataFrame:
    """How much the mean loss rises when the values of one column are moved among the rows, largest first.

    ``rows`` are the input of the model with its label; the loss, the squared error if none is given, is a column over the
    model's output, and rows without one do not count. Unlike the weights inside a model this is measured on rows of one's
    own choice, such as the held-back ones, and means the same for every kind of model. Every row is scored once as it is
    and once per column, next to each other in one task: only means are shuffled after the permutation. An empty table
    gives NULL for every column.
    """
    loss = squared_error() if loss is None else loss
    if missing := set(columns) - set(rows.columns):
        raise ValueError(f"no such columns: {sorted(missing)}")
    probes = rows.sparkSession.createDataFrame([(c,) for c in columns], "feature string")
    tried = permuted(rows, columns, key, seed, exchanged).withColumn("_probe", F.explode(F.array(*[F.lit(c) for c in ("", *columns)])))
    moved = {c: F.when(F.col("_probe") == c, F.col("_other")[c]).otherwise(F.col(c)) for c in columns}
    scored = model.transform(tried.withColumns(moved).drop("_other"))
    by_probe = scored.groupBy("_probe").agg(numeric.exact_avg(loss).alias("loss"))
    base = F.max(F.when(F.col("_probe") == "", F.col("loss"))).over(Window.partitionBy(F.lit(0)))
    rises = by_probe.select(F.col("_probe").alias("feature"), base.alias("loss"), F.col("loss").alias("permuted_loss"))
    return (
        probes.join(rises, "feature", "left")
        .select("feature", "loss", "permuted_loss", (F.col("permuted_loss") - F.col("loss")).alias("importance"))
        .orderBy(F.col("importance").desc(), "feature")
    )
