"""Cleaning rules on small rows."""

import datetime as dt

from pyspark.sql import Observation
from pyspark.sql import functions as F

from rentlens.operators import cleaning
from rentlens.sources import tables


def strings(spark, rows, columns):
    return spark.createDataFrame(rows, ", ".join(f"{c} string" for c in columns))


LISTING = ["id", "city", "price", "calculated_host_listings_count", "availability_365", "reviews_per_month"]


def cleaned(spark, rows, **options):
    out = cleaning.clean_listings(strings(spark, rows, LISTING), **options)
    return {r["id"]: r for r in out.collect()}


def test_listing_types_defaults_and_derived_columns(spark):
    rows = cleaned(
        spark,
        [("1", "porto", "75", "3", "30", None), ("2", "lisbon", "$1,234.50", "1", "300", "1.5")],
    )
    a, b = rows["1"], rows["2"]
    assert (a["price"], b["price"]) == (75.0, 1234.5)
    assert (a["host_type"], b["host_type"]) == ("multi", "single")
    assert (a["is_high_occupancy"], b["is_high_occupancy"]) == (True, False)
    assert a["reviews_per_month"] == 0.0
    assert a["estimated_revenue_365"] == 75 * 335
    assert b["booked_nights_365"] == 65.0


def test_rows_without_a_valid_price_go(spark):
    prices = [None, "0", "", "abc", "-5", "$48.00"]
    rows = [(str(i), "porto", p, "1", "100", None) for i, p in enumerate(prices)]
    assert list(cleaned(spark, rows)) == ["5"]


def test_unknown_values_follow_their_rules(spark):
    rows = cleaned(spark, [("1", "porto", "10", None, None, None), ("2", "porto", "10", "n/a", "x", None)])
    for r in rows.values():
        assert r["host_type"] == "single"
        assert r["is_high_occupancy"] is None
        assert r["estimated_revenue_365"] is None


def test_thresholds_are_parameters(spark):
    row = ("1", "porto", "10", "2", "50", None)
    assert cleaned(spark, [row])["1"]["is_high_occupancy"] is True
    changed = cleaned(spark, [row], threshold=0.9, multi_above=5)["1"]
    assert (changed["is_high_occupancy"], changed["host_type"]) == (False, "single")


def test_summary_columns_may_be_missing(spark):
    out = cleaning.clean_listings(strings(spark, [("1", "5")], ["id", "price"]))
    assert out.columns == ["id", "price"]


def test_detailed_file_enriches_without_losing_or_multiplying(spark):
    detailed = strings(
        spark,
        [("1", "$80.00", "2", "t", '["a","b, c"]'), ("1", "$80.00", "3", "t", "[]"), ("9", "$1", "1", "f", None)],
        ["id", "price", "beds", "host_is_superhost", "amenities"],
    )
    rows = cleaned(
        spark,
        [("1", "porto", "75", "1", "30", None), ("2", "porto", "60", "1", "30", None)],
        detailed=cleaning.clean_detailed(detailed),
    )
    assert len(rows) == 2
    assert (rows["1"]["price"], rows["2"]["price"]) == (80.0, 60.0)
    assert rows["1"]["host_is_superhost"] is True
    assert rows["1"]["beds"] == 2.0 and rows["1"]["amenity_count"] == 2
    assert rows["2"]["amenity_count"] is None


def test_amenities(spark):
    rows = [("1", '["a","b, c"]'), ("2", "[]"), ("3", "[oops"), ("4", None)]
    out = cleaning.clean_detailed(strings(spark, rows, ["id", "amenities"]))
    assert {r["id"]: r["amenity_count"] for r in out.collect()} == {"1": 2, "2": 0, "3": None, "4": None}


def test_calendar(spark):
    rows = [
        ("porto", "1", "2025-06-15", "t", None, "$1,000.50", "2"),
        ("porto", "1", "2025-13-99", "f", None, "", "two"),
        ("porto", "1", "", "x", None, None, None),
        ("porto", "1", None, "", None, "abc", "1"),
    ]
    columns = ["city", "listing_id", "date", "available", "price", "adjusted_price", "minimum_nights"]
    out = cleaning.clean_calendar(strings(spark, rows, columns))
    assert "price" not in out.columns
    got = out.select("date", "available", "adjusted_price", "minimum_nights", "year", "month", "dow").collect()
    assert tuple(got[0]) == (dt.date(2025, 6, 15), True, 1000.5, 2, 2025, 6, 1)
    assert tuple(got[1]) == (None, False, None, None, None, None, None)
    assert [r["available"] for r in got[2:]] == [None, None]


def test_reviews_are_deduplicated_by_the_columns_present(spark):
    rows = [("1", "2024-01-01", "porto"), ("1", "2024-01-01", "porto"), ("1", "2024-02-01", "porto")]
    assert cleaning.clean_reviews(strings(spark, rows, ["listing_id", "date", "city"])).count() == 2
    named = [(*r, str(i)) for i, r in enumerate(rows)]
    columns = ["listing_id", "date", "city", "reviewer_id"]
    assert cleaning.clean_reviews(strings(spark, named, columns)).count() == 3


def test_neighbourhoods(spark):
    rows = [("porto", "P", "b"), ("porto", "P", "b"), ("porto", "P", "a"), ("porto", None, "c"), ("porto", "P", None)]
    out = cleaning.clean_neighbourhoods(strings(spark, rows, ["city", "neighbourhood_group", "neighbourhood"]))
    assert [r["neighbourhood"] for r in out.collect()] == ["a", "b"]


def test_the_same_copy_survives_in_any_layout(spark):
    rows = [(str(k), str(v)) for k in range(5) for v in range(40)]
    df = strings(spark, rows, ["id", "payload"])
    for parts in (1, 3, 7):
        kept = cleaning.dedupe(df.repartition(parts), ["id"]).collect()
        assert {(r["id"], r["payload"]) for r in kept} == {(str(k), "0") for k in range(5)}


def test_null_keys_are_one_group(spark):
    rows = [(None, "a"), (None, "b"), ("x", "c")]
    assert cleaning.dedupe(strings(spark, rows, ["id", "payload"]), ["id"]).count() == 2


def test_enrich_keeps_the_row_that_knows_the_price(spark):
    rows = spark.createDataFrame([("1", 50.0)], "id string, price double")
    extra = spark.createDataFrame([("1", "a", None), ("1", "b", 80.0)], "id string, note string, price_detailed double")
    assert cleaning.enrich(rows, extra, "id", {"price": "price_detailed"}).first()["price"] == 80.0


def test_nan_is_no_price(spark):
    rows = spark.createDataFrame([(float("nan"),), (1.0,), (None,)], "price double")
    assert [r[0] for r in cleaning.positive_only(rows).collect()] == [1.0]


def test_account_counts_what_is_lost_in_the_same_pass(spark, tmp_path):
    folder = tmp_path / "porto"
    folder.mkdir()
    lines = ["id,price,minimum_nights,last_review,name", "1,$10,2,2024-01-01,a", "2,abc,,2024-13-01,b", "3,,x, ,c", "4,-5,3,2024-01-02", "1,$10,2,2024-01-01,a", "5,$7,1,2024-01-03,d,more", '6,"$1,000",n/a,,e']
    (folder / "listings.csv").write_text("\n".join(lines) + "\n")
    raw = tables.read_city_csv(spark, str(folder), "listings", "porto", keep_malformed=True)
    kept = [r for r in raw.collect() if r[tables.MALFORMED]]
    assert [r.id for r in kept] == ["4", "5"] and [r[tables.MALFORMED] for r in kept] == ["4,-5,3,2024-01-02", "5,$7,1,2024-01-03,d,more"]
    account = Observation("seen")
    cleaned = cleaning.clean_listings(raw, account=account)
    assert cleaned._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1 and tables.MALFORMED not in cleaned.columns
    cleaned.write.format("noop").mode("overwrite").save()
    got = {r.column: tuple(r)[1:] for r in cleaning.account_rows(spark, account).collect()}
    assert got == {"price": (7, 2, 1, 1), "minimum_nights": (7, 2, 1, 2), "last_review": (7, 2, 2, 1)}
    plain = tables.read_city_csv(spark, str(folder), "listings", "porto")
    assert sorted(map(tuple, cleaning.clean_listings(plain).collect())) == sorted(map(tuple, cleaned.collect()))
    assert cleaned.count() == 3


def test_account_of_no_rows(spark):
    account = Observation("none")
    df = cleaning.read_columns(strings(spark, [], ["id", "price"]), {"price": F.col("price").try_cast("double")}, account)
    assert df.collect() == []
    assert [tuple(r) for r in cleaning.account_rows(spark, account).collect()] == [("price", 0, 0, 0, 0)]
