"""Trees over binned rows against MLlib's own and against plain loops."""

import random

import numpy as np
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.sql import functions as F

from rentlens.ml import features, forests, models


@pytest.fixture(scope="module")
def prepared(spark):
    """Few values per column, so that both have the same candidates; no ties between splits."""
    rng = random.Random(3)
    rows = []
    for i in range(700):
        a, b, c = rng.randrange(20), rng.randrange(7), rng.choice("uvwx")
        y = a * 0.37 + b * b * 0.11 + (2.3 if c == "w" else 0) + rng.random()
        rows.append((i, float(a), float(b) if i % 50 else float("nan"), c, y, float(y > 6), 3.0 if y > 6 else 0.8))
    df = spark.createDataFrame(rows, "id long, a double, b double, c string, y double, busy double, weight double").repartition(3, "id").cache()
    stages = Pipeline(stages=features.feature_stages(["c"], ["a", "b"])).fit(df.fillna(0.0, ["b"])).stages
    return PipelineModel(stages).transform(df.fillna(0.0, ["b"])).cache(), stages


@pytest.mark.parametrize(
    "make",
    [
        lambda: RandomForestRegressor(labelCol="y", numTrees=2, maxDepth=7, minInstancesPerNode=4, bootstrap=False, featureSubsetStrategy="all"),
        lambda: RandomForestClassifier(labelCol="busy", weightCol="weight", numTrees=1, maxDepth=4, bootstrap=False, featureSubsetStrategy="all"),
        lambda: GBTRegressor(labelCol="y", maxIter=4, maxDepth=3, stepSize=0.3, minInstancesPerNode=5),
    ],
    ids=["regression", "classes", "boosted"],
)
def test_without_draws_the_trees_are_those_of_mllib(prepared, make):
    (rows, stages), estimator = prepared, make()
    assert forests.covers(estimator)
    ours, own = forests.fit(estimator, rows, stages, ["a", "b"], ["c"]), estimator.fit(rows)
    assert type(ours) is type(own)
    assert [t.numNodes for t in ours.trees] == [t.numNodes for t in own.trees]
    assert ours.treeWeights == own.treeWeights and ours.getMaxDepth() == own.getMaxDepth()
    assert ours.featureImportances.toArray() == pytest.approx(own.featureImportances.toArray(), abs=1e-9)
    # Scored at the driver, as this is about the trees.
    for row in rows.select("features").limit(300).collect():
        if isinstance(estimator, RandomForestClassifier):
            assert ours.predictProbability(row.features).toArray() == pytest.approx(own.predictProbability(row.features).toArray(), abs=1e-9)
        assert ours.predict(row.features) == pytest.approx(own.predict(row.features), abs=1e-9)


@pytest.mark.parametrize("costs", [None, (0.7, 2.5)])
def test_counts_are_those_of_a_plain_loop(costs):
    columns = (forests.Binned("a", (0,), (1.0, 2.0, 3.0)), forests.Binned("b", (1, 2, 3), None), forests.Binned("c", (4,), tuple(map(float, range(31)))))
    rule = forests.Rule(columns, 5, 2, 1, 0.0, 42, 1.0, True, costs)
    rng = np.random.default_rng(1)
    blocks = []
    for id_, n in ((7, 400), (9, 37)):
        x = np.stack([rng.integers(0, c.size, n) for c in columns]).astype(np.uint8)
        blocks.append((id_, x, (x[0] > 1).astype(float) if costs else x[0] + rng.random(n)))
    tree = forests.Tree()
    for level in range(7):
        if not (tree.open >= 0).any():
            break
        counts = forests.tallied(blocks, 3, tree.walk, tree.open, tree.n_open, rule)
        plain = [np.zeros((tree.n_open, 2, c.size)) for c in columns]
        for id_, x, y in blocks:
            for row, times in enumerate(rule.bag(3, id_, len(y))):
                at = 0
                for column, low, span in tree.walk:
                    bin_ = int(x[column[at], row])
                    at = 2 * at + int(column[at] >= 0 and int(low[at]) <= bin_ <= int(low[at]) + int(span[at]))
                for i in range(len(columns) if tree.open[at] >= 0 else 0):
                    cell = plain[i][tree.open[at], :, x[i, row]]
                    cell += (times * (y[row] == 0), times * y[row]) if costs else (times, times * y[row])
        for found, expected in zip(counts, plain, strict=True):
            assert found == pytest.approx(expected)
        tree.split(forests.best(forests.sent(counts, 3, level, tree.n_open, rule), 3, level, tree.n_open, rule), rule, 7)


def test_bags_and_subsets_follow_their_laws():
    rule = forests.Rule((), 30, 6, 1, 0.0, 5, 1.0, True, None)
    bag = rule.bag(0, 1, 200_000)
    shares = np.bincount(bag, minlength=4)[:4] / len(bag)
    assert shares == pytest.approx([np.exp(-1), np.exp(-1), np.exp(-1) / 2, np.exp(-1) / 6], abs=0.005)
    assert (rule.bag(0, 1, 100) == bag[:100]).all() and (rule.bag(1, 1, 100) != bag[:100]).any()
    once = forests.Rule((), 30, 30, 1, 0.0, 5, 0.8, False, None)
    assert once.bag(0, 1, 200_000).mean() == pytest.approx(0.8, abs=0.005) and once.subset(0, 0, 4) is None
    mask = rule.subset(2, 3, 500)
    assert (mask.sum(axis=1) == 6).all() and mask.mean(axis=0) == pytest.approx(np.full(30, 0.2), abs=0.08)


def test_large_trainings_grow_over_bins(spark, monkeypatch, tmp_path):
    """Beyond the limit no tree is left to MLlib's rows, and the model is saved, loaded and applied as any other."""
    listings = spark.range(900).select(
        F.col("id").cast("string").alias("id"),
        F.lit("porto").alias("city"),
        F.when(F.col("id") % 3 == 0, "Entire home/apt").otherwise("Private room").alias("room_type"),
        F.concat(F.lit("n"), F.col("id") % 6).alias("neighbourhood"),
        (40 + 30 * (F.col("id") % 6) + F.when(F.col("id") % 3 == 0, 60).otherwise(0) + F.col("id") % 7).cast("double").alias("price"),
        *[(F.col("id") % k).cast("double").alias(c) for c, k in (("minimum_nights", 4), ("number_of_reviews", 50), ("number_of_reviews_ltm", 20), ("calculated_host_listings_count", 9), ("availability_365", 366))],
    )
    monkeypatch.setattr(models, "LARGE_ROWS", 0)
    monkeypatch.setattr(models, "PARTITIONS", 2)
    grown = []
    monkeypatch.setattr(forests, "fit", lambda e, *rest, _fit=forests.fit: (grown.append(type(e).__name__), _fit(e, *rest))[1])
    trained = models.train_price(listings, "rf", {"numTrees": 4, "maxDepth": 4})
    assert grown == ["RandomForestRegressor"] and trained.metrics.first()["r2_log"] > 0.5
    trained.save(str(tmp_path / "m"))
    model, encoding = models.load(spark, str(tmp_path / "m"))
    assert models.score(listings, model, encoding).where("predicted_price > 0").count() == 900


def test_blocks_are_a_byte_per_column_and_a_label(prepared):
    rows, stages = prepared
    columns = forests._columns(rows, stages, ["a", "b"], ["c"], 32)
    assert [c.slots for c in columns] == [(0,), (1,), (2, 3, 4, 5, 6)]
    run, opened = forests._packed(columns)
    blocks = rows.select("a", "b", "c_idx", "y").mapInArrow(run, "id long, x binary, y binary").rdd.map(opened).collect()
    assert sum(len(y) for _, _, y in blocks) == 700 and all(x.nbytes + y.nbytes == 11 * len(y) for _, x, y in blocks)
    assert len({i for i, _, _ in blocks}) == len(blocks)


def test_what_is_not_covered_is_left_to_mllib(spark):
    assert not forests.covers(GBTRegressor(lossType="absolute"))
    assert not forests.covers(RandomForestRegressor(weightCol="weight"))
    assert not forests.covers(RandomForestRegressor(featureSubsetStrategy="3"))
    assert not forests.covers(RandomForestClassifier(maxDepth=20))
