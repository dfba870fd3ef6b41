"""Edge rules of the market operators, checked by hand or by a direct computation."""

import math
import random
from collections import Counter, defaultdict

import pytest

from rentlens.operators import concentration, occupancy, rankings, trends


def listings(spark, rows):
    return spark.createDataFrame(rows, "id string, city string, room_type string, neighbourhood string, price double")


def calendar(spark, rows):
    return spark.createDataFrame(rows, "listing_id string, date string, available boolean").selectExpr(
        "listing_id", "cast(date as date) as date", "available"
    )


def test_unknown_flags_and_dropped_listings(spark):
    days = calendar(
        spark,
        [
            ("1", "2025-01-01", True),
            ("1", "2025-01-02", False),
            ("1", "2025-01-03", None),
            ("1", None, False),
            ("gone", "2025-01-01", False),
        ],
    )
    out = occupancy.seasonality(days, listings(spark, [("1", "porto", "r", "n", 10.0)])).collect()
    assert len(out) == 1
    row = out[0]
    assert (row["n_calendar_days"], row["availability_rate"], row["occupancy_rate"]) == (3, 0.5, 0.5)
    assert row["estimated_revenue_proxy"] == 10.0


def test_the_two_occupancy_denominators(spark):
    days = calendar(spark, [("1", "2025-01-01", True), ("1", "2025-01-02", False), ("1", "2025-01-03", None)])
    homes = listings(spark, [("1", "porto", "r", "n", 10.0)])
    reviews = spark.createDataFrame([], "listing_id string, date date")
    area = occupancy.area_revenue(days, homes).first()
    assert (area["occupancy_rate"], area["n_days"], area["total_revenue"]) == (0.5, 3, 10.0)
    assert area["avg_daily_revenue"] == pytest.approx(10 / 3)
    month = occupancy.market_months(days, homes, reviews).first()
    assert month["avg_occupancy"] == pytest.approx(1 / 3)
    assert month["total_reviews"] == 0


def test_months_without_any_known_flag(spark):
    days = calendar(spark, [("1", "2025-01-01", None)])
    homes = listings(spark, [("1", "porto", "r", "n", 10.0)])
    area = occupancy.area_revenue(days, homes).first()
    assert (area["booked_days"], area["available_days"], area["occupancy_rate"]) == (None, None, None)
    assert area["total_revenue"] == 0.0


def test_monthly_rate_policies(spark):
    days = calendar(spark, [("1", "2025-01-01", True), ("1", "2025-01-02", None)]).selectExpr("*", "'porto' as city")
    assert occupancy.monthly_rate(days).first()["availability_rate"] == 0.5
    assert occupancy.monthly_rate(days, unknown="ignore").first()["availability_rate"] == 1.0
    with pytest.raises(ValueError):
        occupancy.monthly_rate(days, unknown="other")


def brute_pareto(sizes, points):
    sizes = sorted(sizes, reverse=True)
    out = {}
    for p in points:
        ranks = [i for i in range(1, len(sizes) + 1) if i / len(sizes) <= p]
        if ranks:
            out[p] = sum(sizes[: max(ranks)]) / sum(sizes)
    return out


def test_pareto_against_ranking_every_host(spark):
    rng = random.Random(5)
    rows = []
    for city, hosts in (("a", 7), ("b", 100), ("c", 333), ("d", 1)):
        for h in range(hosts):
            rows += [(city, f"{city}{h}", i) for i in range(int(rng.paretovariate(1.0)) % 200 + 1)]
    df = spark.createDataFrame(rows, "city string, host_id string, id int")
    points = [*concentration.SHARE_POINTS, 0.07, 0.29, 0.58]
    got = defaultdict(dict)
    for r in concentration.pareto(df, points=points).collect():
        got[r["city"]][r["host_share"]] = r["listings_share"]
    head = {r["city"]: r for r in concentration.top_share_by_head(df).collect()}
    for city in "abcd":
        sizes = list(Counter(h for c, h, _ in rows if c == city).values())
        want = brute_pareto(sizes, points)
        assert set(got[city]) == set(want)
        for p, share in want.items():
            assert got[city][p] == pytest.approx(share, abs=1e-12)
        k = max(1, math.ceil(len(sizes) * 0.1))
        assert head[city]["top_hosts"] == k
        assert head[city]["listings_by_top"] == sum(sorted(sizes, reverse=True)[:k])
    assert 0.01 not in got["a"]


def test_pareto_is_monotone_and_ends_at_one(spark):
    df = spark.createDataFrame([("a", i % 50 * (i % 3), i) for i in range(500)], "city string, host_id int, id int")
    rows = concentration.pareto_curve(df).collect()
    shares = [r["listings_share"] for r in rows]
    assert shares == sorted(shares) and shares[0] == 0.0 and shares[-1] == 1.0


def test_correlation_of_constant_and_incomplete_groups(spark):
    rows = [("flat", float(i), 5.0) for i in range(5)]
    rows += [("line", float(i), 2.0 * i) for i in range(5)] + [("line", 9.0, None)]
    rows += [("one", 1.0, 1.0)]
    df = spark.createDataFrame(rows, "g string, x double, y double").selectExpr("*", "g as id")
    out = {r["g"]: r["corr"] for r in rankings.corr_by_group(df, "x", "y", ["g"], min_n=1).collect()}
    assert out["flat"] is None and out["one"] is None
    assert out["line"] == pytest.approx(1.0)


def test_growth_spans_gaps_unless_strict(spark):
    days = [("porto", f"{y}-03-01") for y, n in ((2018, 2), (2020, 3)) for _ in range(n)]
    df = spark.createDataFrame(days, "city string, date string").selectExpr("city", "cast(date as date) as date")
    loose = trends.yoy_monthly(df).collect()
    assert [(r["year"], r["prev_year_reviews"], r["yoy_growth"]) for r in loose] == [(2018, None, None), (2020, 2, 0.5)]
    strict = trends.yoy_monthly(df, strict=True).collect()
    assert strict[1]["prev_year_reviews"] is None
    yearly = trends.yoy_yearly(df).collect()
    assert [(r["year"], r["yoy_growth_pct"]) for r in yearly] == [(2020, 50.0)]


def test_ties_rank_by_name_and_short_lists_overlap(spark):
    rows = [(str(i), "porto", "r", f"n{i % 3}", 10.0) for i in range(30)]
    df = listings(spark, rows)
    out = rankings.top_bottom(df, group=["neighbourhood"], k=2).collect()
    assert [(r["bucket"], r["rank"], r["neighbourhood"]) for r in out] == [
        ("bottom", 1, "n0"),
        ("bottom", 2, "n1"),
        ("top", 1, "n0"),
        ("top", 2, "n1"),
    ]


def test_fallback_to_the_second_level(spark):
    rows = [("a", "g1", "x"), ("a", None, "y"), ("a", "", "y")] + [("b", None, f"z{i:02d}") for i in range(20)]
    df = spark.createDataFrame(rows, "city string, neighbourhood_group string, neighbourhood string")
    out = rankings.group_with_fallback(df).collect()
    assert [(r["level"], r["label"], r["n"]) for r in out if r["city"] == "a"] == [(1, "g1", 1)]
    second = [r for r in out if r["city"] == "b"]
    assert len(second) == 15 and {r["level"] for r in second} == {2}


def test_shares_add_up(spark):
    df = listings(spark, [(str(i), f"c{i % 2}", f"r{i % 5}", "n", 1.0) for i in range(57)])
    total = defaultdict(float)
    for r in rankings.share_of_parent(df).collect():
        total[r["city"]] += r["share"]
    assert all(v == pytest.approx(1.0) for v in total.values())


def test_results_do_not_depend_on_the_layout(spark):
    rng = random.Random(3)
    rows = [(str(i), f"c{i % 3}", f"r{i % 4}", f"n{i % 11}", round(rng.uniform(1, 900), 2)) for i in range(800)]
    days = [(str(rng.randrange(800)), f"2025-{rng.randint(1, 12):02d}-01", rng.choice([True, False, None])) for _ in range(4000)]
    results = []
    for parts in (1, 5, 13):
        homes, cal = listings(spark, rows).repartition(parts), calendar(spark, days).repartition(parts)
        results.append(
            (
                sorted(map(str, occupancy.seasonality(cal, homes).collect())),
                sorted(map(str, occupancy.area_revenue(cal, homes).collect())),
                sorted(map(str, rankings.top_bottom(homes, group=["neighbourhood"]).collect())),
            )
        )
    assert results[0] == results[1] == results[2]
