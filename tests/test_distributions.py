"""Distributions against direct computations."""

import math

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rentlens.functions import labels, numeric
from rentlens.operators import distributions as d
from rentlens.operators import order_statistics
from rentlens.operators import profiling


def frame(spark, values, groups=None):
    groups = groups or ["g"] * len(values)
    return spark.createDataFrame(list(zip(groups, values, strict=True)), "city string, price double")


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.floats(-1e6, 1e9, allow_nan=False).map(lambda x: round(x, 2)), min_size=1, max_size=60))
def test_exact_quantiles_equal_numpy(spark, values):
    points = {"a": 0.0, "b": 0.25, "c": 0.5, "e": 0.99, "f": 1.0}
    row = d.exact_quantiles(frame(spark, values), "price", points, ["city"]).first()
    assert row["n"] == len(values)
    for name, p in points.items():
        assert row[name] == pytest.approx(np.quantile(values, p), rel=1e-12, abs=1e-9)


def test_exact_quantiles_of_a_dominant_value_and_of_unnamed_groups(spark):
    values = [5.0] * 300 + [float(i) for i in range(100)] + [None, float("nan")]
    groups = [None] * 150 + ["x"] * 252
    out = {r["city"]: r for r in d.exact_quantiles(frame(spark, values, groups), "price", {"m": 0.5}, ["city"]).collect()}
    assert out[None]["m"] == 5.0 and out[None]["n"] == 150
    x = [v for v, g in zip(values, groups, strict=True) if g == "x" and v is not None and v == v]
    assert out["x"]["n"] == len(x) and out["x"]["m"] == np.median(x)


def test_lower_quantile_takes_an_existing_value(spark):
    row = d.exact_quantiles(frame(spark, [1.0, 2.0, 3.0, 4.0]), "price", {"m": 0.5}, ["city"], "lower").first()
    assert row["m"] == 2.0


def test_histogram_equals_numpy_and_covers_every_value(spark):
    values = [float(v) for v in np.random.default_rng(1).lognormal(4, 0.7, 500).round(2)]
    kept = [v for v in values if 0 < v < 500]
    rows = d.histogram(frame(spark, values), bins=20, density=True).collect()
    counts, edges = np.histogram(kept, bins=20)
    got = {r["bin"]: r for r in rows}
    assert sum(r["n"] for r in rows) == len(kept)
    for i, n in enumerate(counts):
        assert (got[i]["n"] if i in got else 0) == n
        if i in got:
            assert got[i]["left_edge"] == pytest.approx(edges[i])
            assert got[i]["density"] == pytest.approx(n / len(kept) / (edges[1] - edges[0]))


def test_histogram_of_one_value_and_without_groups(spark):
    assert [r["n"] for r in d.histogram(frame(spark, [5.0, 5.0]), bins=3).collect()] == [2]
    assert sum(r["n"] for r in d.histogram(frame(spark, [1.0, 2.0, 3.0]), by=[], bins=3).collect()) == 3


def test_boxplot(spark):
    values = [1.0, 10.0, 11.0, 12.0, 13.0, 14.0, 15.0, 100.0]
    row = d.boxplot(frame(spark, values)).first()
    q1, q3 = np.quantile(values, [0.25, 0.75])
    inside = [v for v in values if q1 - 1.5 * (q3 - q1) <= v <= q3 + 1.5 * (q3 - q1)]
    assert (row["q1"], row["q3"]) == (q1, q3)
    assert (row["whisker_low"], row["whisker_high"]) == (min(inside), max(inside))
    assert row["n_fliers"] == len(values) - len(inside)


def test_threshold_shapes_agree(spark):
    values = [float(v) for v in range(1, 101)]
    df = frame(spark, values, ["a" if v < 40 else "b" for v in values]).selectExpr("*", "'x' as room_type", "1 as id")
    wide = {r["city"]: r for r in d.thresholds_wide(df, ["city"], thresholds=[30, 60]).collect()}
    long = {(r["city"], r["threshold"]): r["outlier_count"] for r in d.thresholds_long(df, [30, 60]).collect()}
    assert ("a", 60) not in long and wide["a"]["n_above_60"] == 0
    assert all(wide[c][f"n_above_{t}"] == n for (c, t), n in long.items())
    overall = d.thresholds_long(df, [60, 500], ()).collect()
    assert [(r["threshold"], r["outlier_count"]) for r in overall] == [(60, 40), (500, 0)]


def test_rounding_to_tens_is_half_even(spark):
    rows = d.rounded_histogram(frame(spark, [5.0, 15.0, 25.0, 26.0])).collect()
    assert [(r["level"], r["n"]) for r in rows] == [(0.0, 1), (20.0, 2), (30.0, 1)]


def test_quartile_bucket_drops_far_values_first(spark):
    df = frame(spark, [1.0, 2.0, 3.0, 4.0, 1000.0])
    out = {r["price"]: r["quartile"] for r in d.quartile_bucket(df, cap=5).collect()}
    assert out == {1.0: "lowest", 2.0: "second", 3.0: "third", 4.0: "highest"}


def test_nights_and_band_labels(spark):
    df = spark.createDataFrame([(v,) for v in (None, 0.0, 1.0, 1.5, 2.0, 3.0, 4.0, 6.0, 7.0)], "v double")
    got = [r[0] for r in df.select(labels.nights_bucket("v")).collect()]
    assert got == ["long_stay", "long_stay", "one_night", "long_stay", "weekend", "weekend", "week_short", "week_short", "long_stay"]
    assert [r[0] for r in df.select(labels.bands("v")).collect()][0] == labels.TOP_BAND


def test_sums_do_not_depend_on_order(spark):
    values = [0.1, 0.2, 0.3, 1e9, -1e9] * 200
    totals = {
        frame(spark, values).repartition(p).agg(numeric.exact_sum("price")).first()[0] for p in (1, 4, 9)
    }
    assert totals == {120.0}


def test_sums_keep_small_large_and_missing_values(spark):
    def mean(*values):
        return frame(spark, list(values)).agg(numeric.exact_avg("price")).first()[0]

    assert mean(0.004, 0.004) == 0.004 and mean(2e7, 4e7) == 3e7 and mean(1e300, 3e300) == 2e300
    assert mean(None, None) is None and mean(None, 2.0) == 2.0 and math.isnan(mean(float("nan"), 5.0))
    assert mean(float("inf"), 1.0) == float("inf") and mean(104766.57, 0.0, 0.0) == 34922.19
    assert mean(1e-9, 3e-9) == pytest.approx(2e-9, rel=1e-12)


def test_exact_sums_of_any_size(spark):
    from fractions import Fraction

    rng = np.random.default_rng(5)
    values = [*rng.normal(0, 1e12, 300), *rng.normal(0, 1e3, 300).round(2), *(rng.normal(0, 1, 100) * 10.0 ** rng.integers(-9, 19, 100)), -9e9, 9e9, 8_999_999_999.999999, 1e19, -1e19, 0.1]
    values = [float(v) for v in values]
    exact = float(sum(map(Fraction, values)))
    sums = {p: frame(spark, values).repartition(p).agg(numeric.exact_sum("price"), numeric.exact_avg("price")).first() for p in (1, 3, 16)}
    assert len(set(sums.values())) == 1
    assert sums[1][0] == pytest.approx(exact, rel=1e-15) and sums[1][1] == pytest.approx(exact / len(values), rel=1e-15)
    assert frame(spark, [1e19, 0.25, -1e19, 123456789012.5]).agg(numeric.exact_sum("price")).first()[0] == 123456789012.75
    assert math.isnan(frame(spark, [float("inf"), float("-inf"), 1.0]).agg(numeric.exact_sum("price")).first()[0])


@pytest.mark.parametrize(("low", "high"), [(1000.0, 1001.0), (0.0, 0.001), (-1001.0, -1000.0)])
def test_close_values_spread_over_partitions(spark, low, high):
    n = 200_000
    rows = spark.range(n).select(F.lit("g").alias("city"), (F.lit(low) + F.col("id") * ((high - low) / n)).alias("price"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        counts = order_statistics.ValueCounts(rows, "price", ["city"])
        shares = [r["count"] for r in counts.values().groupBy("_part").count().collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(shares) == 4 and max(shares) < 0.4 * n
    row = counts.summary({"m": 0.5, "p": 0.9}, "lower").first()
    assert row["m"] == pytest.approx(low + (high - low) * (n // 2 - 1) / n, rel=1e-12)
    assert row["p"] == pytest.approx(low + (high - low) * (n * 9 // 10 - 1) / n, rel=1e-12)


def test_medians_do_not_depend_on_the_layout(spark):
    rows = spark.range(1_000_000).select(F.lit("g").alias("city"), (F.xxhash64("id") % 10_000_000 / 7.0).alias("price"))
    found = set()
    for parts in (1, 4, 16, 64):
        spark.conf.set("spark.sql.shuffle.partitions", str(parts))
        found.add(d.quartile_stats(rows.repartition(parts), "price", ("city",)).first())
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert len(found) == 1


def test_aggregates_and_distinct_counts_beside_quantiles(spark):
    rng = np.random.default_rng(2)
    rows = [(str(rng.choice(["a", "b"])), None if rng.random() < 0.1 else float(rng.integers(0, 50)), int(rng.integers(0, 9)) if rng.random() < 0.8 else None) for _ in range(400)]
    rows += [(None, float("nan"), 3), ("only unknown", None, None), ("only unknown", None, 5)]
    df = spark.createDataFrame(rows, "city string, price double, host long").repartition(5)
    measures = [F.count("*").alias("n"), F.max("price").alias("top"), F.collect_set("host").alias("hosts")]
    got = {r["city"]: r for r in d.with_quantiles(df, ["city"], measures, "price", {"m": 0.5}, method="linear", distinct={"n_hosts": "host", "n_prices": "price"}).collect()}
    assert set(got) == {"a", "b", None, "only unknown"}
    for city, row in got.items():
        mine = [r for r in rows if r[0] == city]
        known = [r[1] for r in mine if r[1] is not None and r[1] == r[1]]
        hosts = {r[2] for r in mine} - {None}
        assert row["n"] == len(mine) and row["n_hosts"] == len(hosts) and set(row["hosts"]) == hosts
        assert row["m"] == (np.median(known) if known else None)
        assert row["n_prices"] == len(set(known)) + any(r[1] is not None and r[1] != r[1] for r in mine)
    whole = d.with_quantiles(df, [], measures, "price", {"m": 0.5}, distinct={"n_hosts": "host"}).first()
    assert whole["n"] == len(rows) and whole["n_hosts"] == 9
    assert d.exact_quantiles(df.where("false"), "price", {"m": 0.5}).collect() == []


@pytest.mark.parametrize("name", ["q01_top_bottom", "q04_host_type", "q07_top_revenue", "q10_thresholds", "quantile_array", "boxplot_stats", "price_summary"])
def test_quantile_plans(spark, name):
    """Value counts are stored from one read of the source; what follows has few exchanges and reads no source."""
    from rentlens.catalog import ENTRIES

    plan = ENTRIES[name].run(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString().splitlines()
    assert sum("- Exchange" in line for line in plan) <= 5
    assert not any("FileScan" in line and "/root/testdata" in line for line in plan)


def test_stored_tables_are_removed(spark):
    from rentlens.sources import scratch

    scratch.clear(spark)
    d.medians(frame(spark, [1.0, 2.0]), ["city"]).collect()
    assert scratch.clear(spark) == 1 and scratch.clear(spark) == 0


def test_unnamed_groups_are_kept(spark):
    rows = frame(spark, [1.0, 2.0, 3.0, 50.0, 7.0], [None, None, None, None, "x"])
    assert {r["city"] for r in d.boxplot(rows).collect()} == {None, "x"}
    assert {r["city"] for r in d.histogram(rows).collect()} == {None, "x"}
    hosts = rows.withColumns({"host_id": F.lit(1), "host_type": F.lit("multi")})
    assert {(r["city"], r["median_price"]) for r in profiling.headline_metrics(hosts).collect()} == {(None, 2.5), ("x", 7.0)}
    items = rows.select("city", F.lit("l").alias("listing_id"), F.lit("p").alias("reviewer_id"), F.lit("2020-01-01").alias("date"))
    overview = {r["city"]: r for r in profiling.activity_overview(items).collect()}
    assert overview[None]["total_reviews"] == 4 and overview[None]["unique_reviewers"] == 1
    listed = rows.selectExpr("city", "price", "'r' AS room_type", "1.0 AS number_of_reviews", "1.0 AS review_scores_rating", "1.0 AS availability_365", "1 AS id")
    days = rows.selectExpr("city", "true AS available")
    found = {r["city"]: r for r in profiling.city_summary(listed, days, items).collect()}
    assert found[None]["total_reviews"] == 4 and found[None]["availability_rate_pct"] == 100.0 and found[None]["median_price"] == 2.0
