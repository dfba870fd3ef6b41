"""Encoding over folds, selection over folds, importance by permutation, and how good the models are."""

import math
import random
from collections import Counter, defaultdict

import pytest
from pyspark.ml import Pipeline
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.sql import functions as F

from rentlens.ml import features, models, selection

SMALL = {"numTrees": 5, "maxDepth": 4}


@pytest.fixture(scope="module")
def listings(spark):
    """Prices by area and room, availability by the number of reviews."""
    rng = random.Random(3)
    rows = []
    for i in range(500):
        area, entire, reviews = rng.randrange(5), rng.random() < 0.5, rng.randrange(40)
        price = round(50 + 30 * area + 80 * entire + rng.uniform(0, 10), 2)
        free = min(365, max(0, 8 * reviews + rng.randrange(-30, 30)))
        rows.append((str(i), "porto", "Entire home/apt" if entire else "Private room", f"n{area}" if area else None, price, 2.0,
                     float(reviews), 1.0, 0.5, float(rng.randint(1, 4)), float(free), 41.0, -8.6))
    schema = (
        "id string, city string, room_type string, neighbourhood string, price double, minimum_nights double, "
        "number_of_reviews double, number_of_reviews_ltm double, reviews_per_month double, "
        "calculated_host_listings_count double, availability_365 double, latitude double, longitude double"
    )
    df = spark.createDataFrame(rows, schema)
    return df.withColumn("is_high_occupancy", 1 - F.col("availability_365") / 365 > 0.7).cache()


@pytest.fixture(scope="module")
def forest(listings):
    return models.train_price(listings, "rf", SMALL)


@pytest.fixture(scope="module")
def demand(listings):
    return models.train_occupancy(listings, "rf", SMALL)


def test_own_fold_takes_no_part(spark):
    rng = random.Random(1)
    rows = [(f"k{i % 300}", rng.choice(["a", "b", "c", None]), float(rng.randrange(5, 500)) if i % 9 else None) for i in range(400)]
    rows += [("single", "only", 77.0), ("void", "never priced", None)]
    df = spark.createDataFrame(rows, "id string, neighbourhood string, price double").withColumn("fold", features.fold_of("id", 4))
    folds = defaultdict(set)
    for r in df.collect():
        folds[r.id].add(r.fold)
    assert all(len(f) == 1 for f in folds.values()) and set.union(*folds.values()) == {0, 1, 2, 3}
    logs = [(r.neighbourhood, r.fold, math.log1p(r.price)) for r in df.collect() if r.price is not None]
    sizes = Counter(n for _, n, _ in rows)
    encoding = features.FoldEncoding(folds=4)
    out = encoding.apply(df).collect()
    assert len(out) == len(rows)
    for r in out:
        own = [y for n, f, y in logs if f != r.fold and n == r.neighbourhood and n is not None] or [y for _, f, y in logs if f != r.fold]
        assert r.neighbourhood_mean_log_price == pytest.approx(sum(own) / len(own), abs=1e-9)
        assert r.neighbourhood_listing_count == pytest.approx(sizes[r.neighbourhood] if r.neighbourhood else len(rows) / len(sizes))
    for n in (1, 16):
        assert Counter(map(tuple, encoding.apply(df.repartition(n)).collect())) == Counter(map(tuple, out))
    assert encoding.apply(df.where("false")).count() == 0
    with pytest.raises(ValueError, match="folds"):
        features.FoldEncoding(folds=1)


def test_a_label_does_not_reach_its_own_encoding(spark):
    """In groups of one the plain encoding is the label itself."""
    rng = random.Random(2)
    df = spark.createDataFrame([(str(i), f"n{i}", rng.uniform(10, 500)) for i in range(200)], "id string, neighbourhood string, price double")
    mean, label = "neighbourhood_mean_log_price", F.log1p("price")
    plain = features.fit_target_encoding(df).apply(df)
    assert plain.where(F.abs(F.col(mean) - label) > 1e-9).count() == 0
    over_folds = features.FoldEncoding().apply(df)
    assert abs(over_folds.agg(F.corr(mean, label)).first()[0]) < 0.5
    assert over_folds.select(mean).distinct().count() == 5


def test_training_over_folds_keeps_the_scoring_encoding(listings, forest):
    folded = models.train_price(listings, "rf", SMALL, folds=5)
    a, b = forest.metrics.first(), folded.metrics.first()
    assert (a.n_train, a.n_test, a.price_cap) == (b.n_train, b.n_test, b.price_cap) and b.r2_log > 0.5
    assert Counter(map(tuple, forest.encoding.groups.collect())) == Counter(map(tuple, folded.encoding.groups.collect()))


def test_mean_metric_is_the_mean_of_single_fits(listings):
    grid = [{"regParam": 0.0}, {"regParam": 5.0}]
    found = selection.select_price(listings, "lr", grid, folds=2)
    table = found.table.orderBy("candidate").collect()
    train, _ = features.split(selection.price_rows(listings))
    rows = train.withColumn("fold", features.fold_of("id", 2)).cache()
    numbers, categories = features.model_columns(train)
    numbers += ["neighbourhood_listing_count", "neighbourhood_mean_log_price"]
    for candidate, row in zip(grid, table, strict=True):
        errors = []
        for fold in range(2):
            rest, held = rows.where(F.col("fold") != fold), rows.where(F.col("fold") == fold)
            encoding = features.fit_target_encoding(rest)
            stages = [*features.feature_stages(categories, numbers), models._estimator(models.PRICE_MODELS, "lr", candidate)]
            fitted = Pipeline(stages=stages).fit(encoding.apply(rest))
            errors.append(RegressionEvaluator(labelCol="label").evaluate(fitted.transform(encoding.apply(held))))
        assert row.mean_metric == pytest.approx(sum(errors) / 2, rel=1e-6)
    assert [r.chosen for r in table] == [True, False] and found.best == grid[0]
    assert found.model.transform(train).where("prediction is null").count() == 0
    sizes = selection.fold_sizes(train, folds=2).collect()
    assert len(sizes) == 2 and all(r.n_fit + r.n_held == rows.count() for r in sizes)
    assert {r.fold: r.n_held for r in sizes} == Counter(r.fold for r in rows.select("fold").collect())


def test_no_candidates(listings):
    with pytest.raises(ValueError, match="candidates"):
        selection.select_price(listings, "lr", [])


@pytest.mark.parametrize("exchanged", [37, 10_000])
def test_values_move_to_exactly_one_row(spark, exchanged):
    df = spark.createDataFrame([(i, i * i % 50 if i % 11 else None, f"t{i % 3}") for i in range(300)], "id long, v long, t string")
    runs = [selection.permuted(df.repartition(n), ["v", "t"], exchanged=exchanged).orderBy("id").collect() for n in (1, 16)]
    assert runs[0] == runs[1]
    assert Counter(tuple(r._other) for r in runs[0]) == Counter((r.v, r.t) for r in runs[0])
    if exchanged > 300:
        assert sum((r.v, r.t) != tuple(r._other) for r in runs[0]) > 250
    assert selection.permuted(df.where("false"), ["v"]).count() == 0


def test_importance_by_permutation(listings, forest):
    rows = features.model_input(listings, forest.encoding).withColumns({"label": F.log1p("price"), "noise": F.crc32("id")}).cache()
    columns = ["noise", "room_type", "neighbourhood_mean_log_price", "minimum_nights", "number_of_reviews"]
    runs = [selection.permutation_importance(forest.model, rows.repartition(n), columns).collect() for n in (1, 16)]
    assert [r.feature for r in runs[0]] == [r.feature for r in runs[1]]
    assert [r.importance for r in runs[0]] == pytest.approx([r.importance for r in runs[1]], abs=1e-12)
    found = {r.feature: r.importance for r in runs[0]}
    assert found["noise"] == 0 and found["minimum_nights"] == 0
    assert {r.feature for r in runs[0][:2]} == {"room_type", "neighbourhood_mean_log_price"}
    assert min(found["room_type"], found["neighbourhood_mean_log_price"]) > 10 * abs(found["number_of_reviews"])
    with pytest.raises(ValueError, match="no such"):
        selection.permutation_importance(forest.model, rows, ["absent"])
    empty = selection.permutation_importance(forest.model, rows.where("false"), ["room_type"]).collect()
    assert [(r.feature, r.importance) for r in empty] == [("room_type", None)]


def test_importance_by_another_loss(listings, demand):
    wrong = (F.col("label") != F.col("prediction")).cast("double")
    given = features.model_input(listings, demand.encoding, features.AVAILABILITY_LEAKS).withColumn("label", F.col("is_high_occupancy").cast("double"))
    first = selection.permutation_importance(demand.model, given, ["number_of_reviews", "room_type", "log_reviews"], loss=wrong).first()
    assert first.feature in ("number_of_reviews", "log_reviews") and first.importance > 0 and 0 <= first.loss < 0.3


def mean_error(listings):
    """RMSE of the train mean of the log price on the test rows."""
    train, test = features.split(features.within_cap(listings))
    mean = train.agg(F.avg(F.log1p("price"))).first()[0]
    return test.agg(F.sqrt(F.avg((F.log1p("price") - mean) ** 2))).first()[0]


def test_price_models_beat_the_train_mean(listings, forest):
    others = [models.train_price(listings, "lr"), models.train_price(listings, "gbt", {"maxIter": 10, "maxDepth": 4, "stepSize": 0.3})]
    limit = 0.6 * mean_error(listings)
    for row in models.compare([forest, *others]).collect():
        assert row.rmse_log < limit and row.r2_log > 0.6 and row.r2_price > 0.6
        assert row.mae_log <= row.rmse_log and row.mae_price <= row.rmse_price


def test_demand_models_rank_by_what_the_label_depends_on(listings, demand):
    row = demand.metrics.first()
    assert row.auc > 0.85 and row.accuracy > 0.8 and row.f1 > 0.8
    shuffled = selection.permuted(listings, ["is_high_occupancy"]).withColumn("is_high_occupancy", F.col("_other.is_high_occupancy")).drop("_other")
    assert models.train_occupancy(shuffled, "rf", SMALL).metrics.first().auc < 0.75


def test_benchmark_forest_learns(listings):
    rows = listings.withColumns({c: F.lit(1.0) for c in models.BENCHMARK_NUMERIC if c not in listings.columns})
    coded = rows.withColumn("latitude", F.col("latitude") + F.coalesce(F.substring("neighbourhood", 2, 1).cast("int"), F.lit(0)))
    row = models.train_forest_benchmark(coded, changes={"numTrees": 10}).first()
    assert row.n_rows == 500 and row.r2 > 0.5
