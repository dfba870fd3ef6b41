"""Bucketed tables, refreshed partitions, merged bitmaps and samples of exact size."""

import hashlib
from collections import Counter, defaultdict
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from rentlens.catalog import roles, storage_entries
from rentlens.catalog.registry import Tables
from rentlens.functions import bitmaps, numeric
from rentlens.operators import distributions, occupancy
from rentlens.plans import refresh
from rentlens.sources import bucketed

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def market(spark):
    t = Tables(spark, FOLDER)
    return roles.calendar(t), roles.listings(t).select("id", "city", "neighbourhood", "price")


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_grouping_and_joining_buckets_shuffles_nothing(spark, market):
    days = bucketed.read_bucketed(spark, bucketed.write_bucketed(market[0], "listing_id", 6, ["date"]))
    homes = bucketed.read_bucketed(spark, bucketed.write_bucketed(market[1], "id", 6))
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        months = occupancy.beside_listings(occupancy.listing_months(days), homes, ["city", "price"])
        plan = plan_of(months)
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        assert plan_of(occupancy.seasonality(days, homes)).count("- Exchange") == 2  # city months, then their order
        assert "Exchange" in plan_of(occupancy.listing_months(market[0]))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    plain = occupancy.beside_listings(occupancy.listing_months(market[0]), market[1], ["city", "price"])
    assert Counter(map(tuple, months.collect())) == Counter(map(tuple, plain.select(*months.columns).collect()))


def test_buckets_take_missing_keys_and_sizes(spark):
    rows = spark.createDataFrame([(None, 1), (None, 2), (5, 3)], "k long, v int")
    name = bucketed.write_bucketed(rows, "k", 4)
    assert sorted(r.v for r in bucketed.read_bucketed(spark, name).collect()) == [1, 2, 3]
    assert bucketed.buckets_for(0) == 1 and bucketed.buckets_for(10, 3) == 4 and bucketed.buckets_for(10, 3, at_least=8) == 8


def files(path):
    found = defaultdict(dict)
    for f in Path(path).rglob("*.parquet"):
        found[f.parent.name][f.name] = f.stat().st_mtime_ns
    return found


def test_replaced_city_equals_a_full_run_and_leaves_other_files(spark, market, tmp_path):
    calendar, homes = market
    path = str(tmp_path / "sums")
    sums = refresh.month_sums(calendar, homes)
    stale = refresh.month_sums(calendar.where("day(date) <= 10"), homes.withColumn("price", F.col("price") + 1))
    refresh.replace_cities(sums.where("city <> 'ASIA'").unionByName(stale.where("city = 'ASIA'")), path)
    before = files(path)
    refresh.replace_cities(sums.where("city = 'ASIA'"), path)
    after = files(path)
    assert set(after) == set(before) and len(after) == 5
    assert all((after[c] == before[c]) == (c != "city=ASIA") for c in after)
    got = refresh.seasonality(refresh.read_sums(spark, path, sums)).collect()
    want = occupancy.seasonality(calendar, homes).collect()
    assert [tuple(r) for r in got] == [tuple(r) for r in want] and len(want) > 100


def test_added_days_merge_into_stored_sums(spark, market, tmp_path):
    calendar, homes = market
    path = str(tmp_path / "sums")
    for part in ("day(date) < 7", "day(date) between 7 and 20", "day(date) > 20"):
        refresh.add_days(refresh.month_sums(calendar.where(part), homes), path)
    before = files(path)
    refresh.add_days(refresh.month_sums(calendar.where("false"), homes), path)
    assert files(path) == before
    got = refresh.seasonality(refresh.read_sums(spark, path, refresh.month_sums(calendar, homes))).collect()
    for g, w in zip(got, occupancy.seasonality(calendar, homes).collect(), strict=True):
        assert tuple(g)[:-1] == tuple(w)[:-1] and g.estimated_revenue_proxy == pytest.approx(w.estimated_revenue_proxy, rel=1e-13)


def test_unnamed_city_is_a_partition(spark, tmp_path):
    days = spark.createDataFrame([(1, None, "2020-01-05", True), (2, "x", "2020-01-05", False)], "listing_id long, city string, date string, available boolean")
    homes = spark.createDataFrame([(1, 10.0), (2, 0.1)], "id long, price double")
    sums = refresh.month_sums(days.withColumn("date", F.to_date("date")), homes)
    for _ in range(2):
        refresh.add_days(sums, str(tmp_path / "sums"))
    got = {r.city: r for r in refresh.seasonality(refresh.read_sums(spark, str(tmp_path / "sums"), sums)).collect()}
    assert got[None].n_calendar_days == 2 and got[None].availability_rate == 1.0 and got["x"].estimated_revenue_proxy == 0.2


def test_parts_of_a_sum_add_up(spark):
    values = [0.1, 0.2, 1e15 + 0.125, -3e18, 7e-9, None]
    df = spark.createDataFrame([(v, i % 2) for i, v in enumerate(values)], "v double, g int")
    millionths, rest = numeric.exact_parts("v")
    parts = df.groupBy("g").agg(millionths.alias("m"), rest.alias("r"))
    merged = parts.agg(F.sum("m").cast("decimal(38,0)").alias("m"), F.sum("r").alias("r")).select(numeric.whole_of("m", "r")).first()[0]
    assert merged == df.agg(numeric.exact_sum("v")).first()[0]


def test_bitmaps_count_and_merge(spark):
    rows = [(f"g{i % 3}" if i % 7 else None, i % 12, k) for i in range(500) for k in (i * i % 997, -i, i * 100_003, None)]
    df = spark.createDataFrame(rows, "g string, m int, k long").repartition(5)
    fine = bitmaps.key_bitmaps(df, "k", ["g", "m"])
    out = bitmaps.distinct_keys(fine, ["g"])
    want = defaultdict(set)
    for g, _, k in rows:
        want[g] |= {k} - {None}
    assert {r.g: r.n_keys for r in out.collect()} == {g: len(s) for g, s in want.items()}
    assert "Expand" not in plan_of(out)
    again = bitmaps.merged_bitmaps(fine.unionByName(fine), ["g", "m"])
    assert Counter(map(str, again.collect())) == Counter(map(str, fine.collect()))
    assert bitmaps.distinct_keys(bitmaps.key_bitmaps(df.where("false"), "k", ["g"]), ["g"]).collect() == []


def test_sample_of_exact_size(spark):
    rows = [(None if i % 50 == 0 else "big" if i % 10 else "small", i) for i in range(3000)] + [("big", None), ("one", 7)]
    df = spark.createDataFrame(rows, "city string, id long")
    found = {p: sorted(map(str, distributions.exact_sample(df.repartition(p), 100, key="id").collect())) for p in (1, 4, 16)}
    assert found[1] == found[4] == found[16]
    sizes, kept = Counter(c for c, _ in rows), Counter()
    for r in distributions.exact_sample(df, 100).collect():
        kept[r.city] += 1
    assert kept == {c: min(100, n) for c, n in sizes.items()}
    digest = lambda i: hashlib.md5(f"42:{i}".encode()).hexdigest()
    big = sorted((i for c, i in rows if c == "big" and i is not None), key=digest)[:100]
    assert {r.id for r in distributions.exact_sample(df, 100).where("city = 'big'").collect()} == set(big)
    plan = plan_of(distributions.exact_sample(df, 100)).splitlines()
    at = [i for i, line in enumerate(plan) if "Exchange" in line][0]
    assert any("WindowGroupLimit" in line and "Partial" in line for line in plan[at:])


def test_more_rows_make_more_buckets(spark, market, monkeypatch):
    """A bucket is sorted by one task, so its rows stay bounded."""
    assert bucketed.buckets_for_rows(spark.range(21), spark.range(3), bucket_rows=5) == 5
    assert bucketed.buckets_for_rows(spark.range(21), bucket_rows=5, at_least=8) == 8
    made, write = [], bucketed.write_bucketed
    monkeypatch.setattr(bucketed, "write_bucketed", lambda df, key, buckets: (made.append(buckets), write(df, key, buckets))[1])
    monkeypatch.setattr(bucketed.buckets_for_rows, "__kwdefaults__", {"bucket_rows": 500, "at_least": 1})
    t = Tables(spark, FOLDER)
    days, homes = storage_entries.bucketed_market(t)
    assert made == [-(-market[0].count() // 500)] * 2 and made[0] > storage_entries.BUCKETS
    assert days.count() == market[0].count() and homes.count() == market[1].count()
