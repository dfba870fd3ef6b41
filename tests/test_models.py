"""Features, models and scoring on small synthetic listings."""

import math
import random

import pytest
from pyspark.ml.evaluation import MulticlassClassificationEvaluator, RegressionEvaluator
from pyspark.sql import Observation
from pyspark.sql import functions as F

from rentlens.ml import evaluation, features, models

SMALL = {"numTrees": 5, "maxDepth": 4}


@pytest.fixture(scope="module")
def listings(spark):
    rng = random.Random(11)
    rows = []
    for i in range(600):
        area = rng.randrange(6)
        room = rng.choice(["Entire home/apt", "Private room", "Shared room", None])
        price = round(40 + 30 * area + (60 if room == "Entire home/apt" else 0) + rng.uniform(0, 10), 2)
        reviews = rng.randrange(50)
        rows.append(
            (str(i), "porto", room, f"g{area % 2}", f"n{area}" if area else None, price, float(rng.choice([1, 2, 5, 30])),
             float(reviews), float(reviews // 2), 1.0, float(rng.randint(1, 9)), float(rng.randrange(366)) if i % 20 else None,
             41.0 + area / 100, -8.6)
        )
    schema = (
        "id string, city string, room_type string, neighbourhood_group string, neighbourhood string, price double, "
        "minimum_nights double, number_of_reviews double, number_of_reviews_ltm double, reviews_per_month double, "
        "calculated_host_listings_count double, availability_365 double, latitude double, longitude double"
    )
    df = spark.createDataFrame(rows, schema)
    return df.withColumn("is_high_occupancy", 1 - F.col("availability_365") / 365 > 0.7).cache()


@pytest.fixture(scope="module")
def trained(listings):
    return models.train_price(listings, "rf", SMALL)


def test_split_is_the_same_in_any_layout(listings):
    first = {r["id"] for r in features.split(listings)[0].collect()}
    again = {r["id"] for r in features.split(listings.repartition(9))[0].collect()}
    rest = {r["id"] for r in features.split(listings)[1].collect()}
    assert first == again and not first & rest and len(first | rest) == 600
    assert 400 < len(first) < 550


def test_encoding_of_known_unknown_and_missing_groups(spark):
    train = spark.createDataFrame(
        [("1", "a", 9.0), ("2", "a", 19.0), ("3", None, 29.0)], "id string, neighbourhood string, price double"
    )
    encoding = features.fit_target_encoding(train)
    new = spark.createDataFrame([("x", "a"), ("y", "new"), ("z", None)], "id string, neighbourhood string")
    out = {r["id"]: r for r in encoding.apply(new).collect()}
    logs = [math.log1p(v) for v in (9, 19, 29)]
    assert out["x"]["neighbourhood_mean_log_price"] == pytest.approx(sum(logs[:2]) / 2)
    assert out["x"]["neighbourhood_listing_count"] == 2
    for key in "yz":
        assert out[key]["neighbourhood_mean_log_price"] == pytest.approx(sum(logs) / 3)
        # Three rows over two groups, the unnamed one included.
        assert out[key]["neighbourhood_listing_count"] == 1.5


def test_select_and_fill_keeps_gaps_without_default(listings):
    encoding = features.fit_target_encoding(listings)
    engineered = features.engineer(listings, encoding)
    filled = features.select_and_fill(engineered)
    assert filled.where("availability_365 is null").count() == 30
    assert filled.where("occupancy_rate = 0.5 and availability_365 is null").count() == 30
    assert filled.where("room_type = 'unknown'").count() > 0
    leakless = features.select_and_fill(engineered, features.AVAILABILITY_LEAKS)
    assert not set(features.AVAILABILITY_LEAKS) & set(leakless.columns)
    assert features.model_input(listings, encoding).where("availability_365 is null").count() == 0


def test_price_model_learns_and_reports(listings, trained):
    row = trained.metrics.first()
    assert row["n_train"] + row["n_test"] == features.within_cap(listings).count()
    assert trained.predictions.count() == row["n_test"]
    assert row["r2_log"] > 0.5 and row["r2_price"] > 0.5
    log = RegressionEvaluator(labelCol="label")
    price = RegressionEvaluator(labelCol="price", predictionCol="prediction_price")
    for metric in ("rmse", "mae", "r2"):
        assert row[f"{metric}_log"] == pytest.approx(log.setMetricName(metric).evaluate(trained.predictions))
        assert row[f"{metric}_price"] == pytest.approx(price.setMetricName(metric).evaluate(trained.predictions))


def test_training_repeats(listings, trained):
    again = models.train_price(listings, "rf", SMALL).metrics.first()
    assert again["rmse_log"] == pytest.approx(trained.metrics.first()["rmse_log"])


def test_a_sample_is_a_share_of_the_keys(listings):
    assert features.sample(listings, None).count() == 600
    part = features.sample(listings, 30)
    assert 120 < part.count() < 240
    # The sample does not coincide with one side of the split.
    assert features.split(part)[0].count() > 0 and features.split(part)[1].count() > 0


def test_every_algorithm_trains(listings):
    rows = models.compare(
        [models.train_price(listings, "lr"), models.train_price(listings, "gbt", {"maxIter": 3, "maxDepth": 3})]
    ).collect()
    assert [r["algo"] for r in rows] == ["lr", "gbt"]
    with pytest.raises(KeyError):
        models.train_price(listings, "other")


def test_saved_model_scores_the_whole_table_alike(spark, listings, trained, tmp_path):
    trained.save(str(tmp_path / "m"))
    model, encoding = models.load(spark, str(tmp_path / "m"))
    stored = {r["id"]: r["prediction"] for r in models.score(listings, model, encoding).collect()}
    fresh = {r["id"]: r["prediction"] for r in models.score(listings, trained.model, trained.encoding).collect()}
    assert len(stored) == 600 and stored == pytest.approx(fresh)


def test_importance_covers_every_slot(listings, trained):
    rows = models.feature_importance(trained.model, features.model_input(listings, trained.encoding)).collect()
    names = {r["feature"] for r in rows}
    assert {"room_type", "city", "neighbourhood_mean_log_price"} <= names
    assert names <= {*features.NUMERIC, *features.CATEGORICAL}
    assert sum(r["importance"] for r in rows) == pytest.approx(1.0)


def test_occupancy_classifier(listings):
    for algo, changes in (("rf", SMALL), ("logreg", {"maxIter": 5})):
        result = models.train_occupancy(listings, algo, changes)
        row = result.metrics.first()
        predictions = result.predictions
        multi = MulticlassClassificationEvaluator(labelCol="label")
        assert row["f1"] == pytest.approx(multi.setMetricName("f1").evaluate(predictions))
        assert row["accuracy"] == pytest.approx(multi.setMetricName("accuracy").evaluate(predictions))
        assert 0 <= row["auc"] <= 1
        scored = models.score(listings, result.model, result.encoding, features.AVAILABILITY_LEAKS)
        assert scored.where("probability between 0 and 1").count() == 600


@pytest.mark.parametrize("partitions", [1, 16])
def test_area_under_roc_of_many_scores(spark, partitions):
    """More than 2,000 distinct scores with ties, against the rank sum."""
    rng = random.Random(5)
    rows = [(float(rng.random() < s / 9000), float(s)) for s in (rng.randrange(6000) for _ in range(8000))]
    own = [s for y, s in rows if y == 1]
    below = [s for y, s in rows if y == 0]
    places = {s: 0 for _, s in rows}
    for s in below:
        places[s] += 1
    lower, won = 0, {}
    for s in sorted(places):
        won[s] = lower + places[s] / 2
        lower += places[s]
    exact = sum(won[s] for s in own) / (len(own) * len(below))
    assert len(places) > 2000
    scored = spark.createDataFrame(rows, "label double, rawPrediction double").repartition(partitions)
    assert evaluation.area_under_roc(scored) == pytest.approx(exact, abs=1e-11)


def test_monthly_model_keeps_listings_on_one_side(spark, listings):
    days = spark.range(600 * 50).selectExpr(
        "cast(id % 600 as string) as listing_id",
        "date_add(date'2025-01-01', cast(id div 600 as int)) as date",
        "(id % 600 + id div 600) % 3 = id % 2 as available",
        "'porto' as city",
    )
    months = features.monthly_demand(days, listings)
    assert {r["month"] for r in months.select("month").distinct().collect()} == {1.0}
    train, test = features.split(features.monthly_demand(days, listings, min_days=10), "listing_id")
    assert not {r[0] for r in train.select("listing_id").collect()} & {r[0] for r in test.select("listing_id").collect()}
    months = features.monthly_demand(days, listings, min_days=10)
    result = models.train_monthly_occupancy(months, SMALL)
    row = result.metrics.first()
    assert row["n_train"] + row["n_test"] == months.count() == 1200
    scored = models.score(
        months, result.model, result.encoding, features.AVAILABILITY_LEAKS, features.TEMPORAL, ("id", "year", "month")
    )
    assert scored.select("id", "year", "month").distinct().count() == 1200


def test_weights_only_for_uneven_classes(spark):
    uneven = spark.createDataFrame([(1.0,)] + [(0.0,)] * 9, "label double")
    weights = {r["label"]: r["weight"] for r in features.class_weights(uneven).collect()}
    assert weights == pytest.approx({1.0: 10.0, 0.0: 1 / 0.9})
    even = spark.createDataFrame([(1.0,), (0.0,)], "label double")
    assert {r["weight"] for r in features.class_weights(even).collect()} == {1.0}


def test_confusion_metrics_of_a_single_class(spark):
    df = spark.createDataFrame([(0.0, 0.0), (0.0, 1.0)], "label double, prediction double")
    row = evaluation.classification_metrics(df).first()
    assert (row["accuracy"], row["base_rate"]) == (0.5, 0.0)
    assert row["f1"] == pytest.approx(2 / 3)


def test_key_is_an_argument_of_the_classifiers(listings):
    renamed = listings.withColumnRenamed("id", "listing_key")
    by_key = models.train_occupancy(renamed, "rf", SMALL, key="listing_key")
    assert by_key.metrics.drop("algo").first() == models.train_occupancy(listings, "rf", SMALL).metrics.drop("algo").first()
    scored = models.score(renamed, by_key.model, by_key.encoding, features.AVAILABILITY_LEAKS, keys=("listing_key",))
    assert scored.select("listing_key").distinct().count() == listings.count()


def test_importance_of_a_linear_model(listings):
    linear = models.train_price(listings, "lr")
    found = models.feature_importance(linear.model, features.model_input(listings, linear.encoding)).collect()
    assert sum(r["importance"] for r in found) == pytest.approx(1.0) and min(r["importance"] for r in found) >= 0


def test_fit_sees_one_layout(listings):
    with models.held(listings.repartition(3), "id", 4) as a:
        first = a.withColumn("at", F.spark_partition_id()).select("id", "at").collect()
    with models.held(listings.coalesce(1), "id", 4) as b:
        assert b.withColumn("at", F.spark_partition_id()).select("id", "at").collect() == first


def test_scratch_tables_are_removed(listings, spark):
    encoding = features.fit_target_encoding(listings).stored()
    encoding.discard()
    with pytest.raises(Exception, match="(?i)not.*(exist|found)"):
        features.TargetEncoding.load(spark, encoding.scratch).groups.collect()


def test_compared_models_share_one_preparation(listings, monkeypatch):
    """Cap, encoding and rows are settled once for all algorithms, and every model is the one it would be alone."""
    calls = []
    for name in ("price_cap", "fit_target_encoding"):
        work = getattr(features, name)
        monkeypatch.setattr(features, name, lambda *a, _work=work, _name=name, **k: (calls.append(_name), _work(*a, **k))[1])
    both = models.train_prices(listings, ("lr", "rf"))
    assert sorted(calls) == ["fit_target_encoding", "price_cap"]
    alone = [models.train_price(listings, algo).metrics.first() for algo in ("lr", "rf")]
    for row, own in zip(models.compare(both).collect(), alone, strict=True):
        assert row["algo"] == own["algo"] and row["n_train"] == own["n_train"]
        assert row["rmse_log"] == pytest.approx(own["rmse_log"])


def test_training_reads_its_input_once(listings, tmp_path):
    """What follows the stored rows reads those, not the joins or files that made the listings."""
    source = str(tmp_path / "listings")
    listings.write.parquet(source)
    trained = models.train_price(listings.sparkSession.read.parquet(source), "lr")
    read = {f for df in (trained.metrics, trained.predictions) for f in df.inputFiles()}
    assert read and not any(source in f for f in read)
    assert trained.metrics.first()["n_train"] > 0


def test_partitions_of_a_fit_follow_its_rows(spark):
    few, many = spark.range(1000), spark.range(20 * models.PARTITION_ROWS + 1)
    assert models.partitions_for(few) == models.PARTITIONS
    assert models.partitions_for(many) == 21


def test_deep_forests_do_not_travel_with_tasks(listings):
    """The same scores with and without cached node ids, which the demand forest uses."""
    assert models._estimator(models.DEMAND_MODELS, "rf", SMALL).getCacheNodeIds()
    found = [
        {r["id"]: r["probability"] for r in models.train_occupancy(listings, changes={**SMALL, "cacheNodeIds": c}).predictions.collect()}
        for c in (True, False)
    ]
    assert found[0] == found[1]


def test_a_forest_of_classes_scores_after_an_observation(spark, listings):
    """A session that has observed a plan cannot be serialized; the model must not hold it."""
    seen = Observation("seen")
    spark.range(3).observe(seen, F.count("*").alias("n")).collect()
    assert seen.get == {"n": 3}
    result = models.train_occupancy(listings, "rf", SMALL)
    assert result.predictions.select("probability").count() == result.metrics.first()["n_test"]
    assert len(result.predictions.select("probability").collect()) == result.metrics.first()["n_test"]
