"""Sources and cleaning.

Raw text columns are rendered from typed ones with some damaged rows, so the SQL states the typed
values that parsing has to give back.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import labels, parsing
from ..operators import cleaning, rankings
from ..sources import scratch, tables
from . import roles
from .registry import Tables, entry, rounded

# How order keys choose the damaged rows (remainder of 50).
BAD_PRICE, EMPTY_PRICE, NEGATIVE_PRICE = 7, 11, 13


def raw_listings(t: Tables) -> DataFrame:
    """Listings as text: dollar prices with thousands separators, damaged on some rows."""
    k = F.col("o_orderkey") % 50
    shown = F.concat(F.lit("$"), F.format_number("o_totalprice", 2))
    return t["orders"].select(
        F.col("o_orderkey").cast("string").alias("id"),
        F.col("o_custkey").cast("string").alias("host_id"),
        F.col("o_orderpriority").alias("room_type"),
        F.when(k == BAD_PRICE, "abc")
        .when(k == EMPTY_PRICE, "")
        .when(k == NEGATIVE_PRICE, "-5")
        .otherwise(shown)
        .alias("price"),
        F.when(k == 3, "2025-13-99").when(k == 4, "").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("last_review"),
        F.when(k != 5, (F.col("o_custkey") % 20).cast("string")).alias("calculated_host_listings_count"),
        F.when(k != 6, (F.col("o_orderkey") % 366).cast("string")).alias("availability_365"),
        F.when(k != 8, F.col("o_custkey").cast("string")).otherwise("n/a").alias("minimum_nights"),
        F.when(k > 1, F.concat((F.col("o_custkey") % 7).cast("string"), F.lit(".25"))).alias("reviews_per_month"),
        F.lit("porto").alias("city"),
    )


RAW_LISTINGS = """
    WITH raw AS (SELECT *, o_orderkey % 50 AS k FROM orders),
    typed AS (
      SELECT CAST(o_orderkey AS VARCHAR) AS id, CAST(o_custkey AS VARCHAR) AS host_id, o_orderpriority AS room_type,
             CASE WHEN k IN (7, 11) THEN NULL WHEN k = 13 THEN -5.0 ELSE o_totalprice END AS price,
             CASE WHEN k IN (3, 4) THEN NULL ELSE CAST(o_orderdate AS DATE) END AS last_review,
             CAST(CASE WHEN k <> 5 THEN o_custkey % 20 END AS DOUBLE) AS calculated_host_listings_count,
             CAST(CASE WHEN k <> 6 THEN o_orderkey % 366 END AS DOUBLE) AS availability_365,
             CAST(CASE WHEN k <> 8 THEN o_custkey END AS DOUBLE) AS minimum_nights,
             CASE WHEN k > 1 THEN o_custkey % 7 + 0.25::DOUBLE ELSE 0 END AS reviews_per_month,
             'porto' AS city
      FROM raw)"""


def raw_calendar(t: Tables) -> DataFrame:
    """Line items as a raw calendar: t/f flags with damaged ones, a price column that is never filled."""
    n = F.col("l_linenumber")
    return t["lineitem"].select(
        F.col("l_orderkey").cast("string").alias("listing_id"),
        F.when(n == 7, "2025-13-99").otherwise(F.date_format("l_shipdate", "yyyy-MM-dd")).alias("date"),
        F.when(n == 6, "x").when(n == 5, "").when(F.col("l_linestatus") == "O", "t").otherwise("f").alias("available"),
        F.lit(None).cast("string").alias("price"),
        F.concat(F.lit("$"), F.format_number("l_extendedprice", 2)).alias("adjusted_price"),
        F.when(n != 4, F.col("l_quantity").cast("int").cast("string")).otherwise("many").alias("minimum_nights"),
    )


RAW_CALENDAR = """
    WITH days AS (
      SELECT CAST(l_orderkey AS VARCHAR) AS listing_id,
             CASE WHEN l_linenumber <> 7 THEN CAST(l_shipdate AS DATE) END AS date,
             CASE WHEN l_linenumber NOT IN (5, 6) THEN l_linestatus = 'O' END AS available,
             l_extendedprice AS adjusted_price,
             CASE WHEN l_linenumber <> 4 THEN CAST(l_quantity AS INTEGER) END AS minimum_nights
      FROM lineitem)"""


@entry("parse_money", f"{RAW_LISTINGS} SELECT id, price FROM typed")
def _(t):
    return raw_listings(t).select("id", parsing.money("price").alias("price"))


@entry("parse_flag", f"{RAW_CALENDAR} SELECT available, count(*) AS n FROM days GROUP BY available")
def _(t):
    return raw_calendar(t).groupBy(parsing.flag("available").alias("available")).agg(F.count("*").alias("n"))


@entry(
    "cast_columns",
    f"{RAW_LISTINGS} SELECT id, minimum_nights, availability_365, calculated_host_listings_count FROM typed",
)
def _(t):
    columns = ["minimum_nights", "availability_365", "calculated_host_listings_count", "absent_column"]
    return cleaning.cast_columns(raw_listings(t).select("id", *columns[:3]), columns)


@entry("parse_date", f"{RAW_LISTINGS} SELECT id, last_review FROM typed")
def _(t):
    return raw_listings(t).select("id", parsing.iso_date("last_review").alias("last_review"))


@entry(
    "date_parts",
    """
    SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month,
           CAST(dayofweek(o_orderdate) + 1 AS INTEGER) AS dow FROM orders""",
)
def _(t):
    return t["orders"].select("o_orderkey", *[e.alias(n) for n, e in parsing.date_parts("o_orderdate").items()])


@entry(
    "json_array_count",
    """
    SELECT event_id, CAST(CASE event_id % 5 WHEN 0 THEN 2 WHEN 1 THEN 0 WHEN 4 THEN 1 END AS INTEGER) AS amenity_count
    FROM events""",
)
def _(t):
    kind = F.col("event_id") % 5
    amenities = (
        F.when(kind == 0, F.concat(F.lit('["'), F.col("event_type"), F.lit('", "b, c"]')))
        .when(kind == 1, "[]")
        .when(kind == 2, "[oops")
        .when(kind == 4, F.concat(F.lit("["), F.col("props"), F.lit("]")))
    )
    return t["events"].select("event_id", parsing.json_array_size(amenities).alias("amenity_count"))


@entry(
    "fill_defaults",
    """
    SELECT id, coalesce(availability_365, 0) AS availability_365, coalesce(number_of_reviews, 1) AS number_of_reviews
    FROM r_listings""",
    roles="r_listings",
)
def _(t):
    rows = roles.listings(t, activity=True).select("id", "availability_365", "number_of_reviews")
    return cleaning.fill_defaults(rows, {"availability_365": 0, "number_of_reviews": 1, "absent_column": 0})


@entry("valid_price_filter", "SELECT c_custkey, c_acctbal FROM customer WHERE c_acctbal > 0")
def _(t):
    return cleaning.positive_only(t["customer"].select("c_custkey", "c_acctbal"), "c_acctbal")


@entry(
    "dedupe_by_key",
    """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_linestatus FROM (
      SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
             ORDER BY l_partkey, l_suppkey, l_extendedprice, l_linestatus) AS rn FROM lineitem) WHERE rn = 1""",
)
def _(t):
    columns = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_linestatus"]
    return cleaning.dedupe(t["lineitem"].select(*columns), ["l_orderkey", "l_linenumber", "absent_column"])


@entry("host_type", "SELECT id, host_type FROM r_listings", roles="r_listings")
def _(t):
    rows = roles.listings(t, hosts_counted=True)
    return rows.select("id", labels.host_type("host_listings", roles.MULTI_ABOVE).alias("host_type"))


@entry(
    "high_occupancy_flag",
    "SELECT id, 1 - availability_365 / 365.0 > 0.7 AS is_high_occupancy FROM r_listings",
    roles="r_listings",
)
def _(t):
    return cleaning.occupancy_columns(roles.listings(t, activity=True)).select("id", "is_high_occupancy")


@entry(
    "estimated_revenue",
    """
    SELECT id, CAST(365 - availability_365 AS DOUBLE) AS booked_nights_365,
           CAST(round(CAST(price * (365 - availability_365) AS DECIMAL(30,9)), 2) AS DOUBLE) AS estimated_revenue_365 FROM r_listings""",
    roles="r_listings",
)
def _(t):
    rows = cleaning.occupancy_columns(roles.listings(t, activity=True))
    return rounded(rows.select("id", "booked_nights_365", "estimated_revenue_365"), 2)


@entry("clean_neighbourhoods", "SELECT * FROM r_neighbourhoods", roles="r_neighbourhoods")
def _(t):
    people = roles.hosts(t)
    unnamed = people.withColumn("neighbourhood", F.lit(None).cast("string"))
    rows = people.unionByName(unnamed).select("city", "neighbourhood_group", "neighbourhood")
    return cleaning.clean_neighbourhoods(rows)


@entry(
    "slice_filter",
    """
    SELECT id, city, room_type, price FROM r_listings
    WHERE city IN ('ASIA', 'EUROPE') AND room_type IN ('1-URGENT', '5-LOW')
      AND neighbourhood_group IN ('NATION_2', 'NATION_3', 'NATION_7') AND price BETWEEN 100000 AND 300000""",
    roles="r_listings",
)
def _(t):
    rows = cleaning.slice_rows(
        roles.listings(t),
        {
            "city": ["ASIA", "EUROPE"],
            "room_type": ["1-URGENT", "5-LOW"],
            "neighbourhood_group": ["NATION_2", "NATION_3", "NATION_7"],
        },
        {"price": (100000, 300000)},
    )
    return rows.select("id", "city", "room_type", "price")


@entry(
    "enrich_left",
    """
    SELECT o_orderkey AS id, coalesce(d.p, o_totalprice) AS price, d.q AS beds
    FROM orders LEFT JOIN (
      SELECT l_orderkey, l_extendedprice AS p, l_quantity AS q FROM (
        SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_extendedprice, l_quantity) AS rn
        FROM lineitem) WHERE rn = 1) d ON d.l_orderkey = o_orderkey""",
)
def _(t):
    rows = t["orders"].select(F.col("o_orderkey").alias("id"), F.col("o_totalprice").alias("price"))
    extra = t["lineitem"].select(
        F.col("l_orderkey").alias("id"),
        F.col("l_extendedprice").alias("price_detailed"),
        F.col("l_quantity").alias("beds"),
    )
    return cleaning.enrich(rows, extra, "id", {"price": "price_detailed"})


@entry(
    "clean_listings",
    f"""{RAW_LISTINGS},
    detailed AS (SELECT CAST(l_orderkey AS VARCHAR) AS id, max(l_extendedprice) AS p,
                        CAST(max(l_quantity) AS DOUBLE) AS beds,
                        max(CASE WHEN l_linestatus = 'O' THEN 1 ELSE 0 END) = 1 AS host_is_superhost
                 FROM lineitem GROUP BY l_orderkey),
    priced AS (SELECT typed.* EXCLUDE (price), coalesce(p, price) AS price, beds, host_is_superhost,
                      CASE WHEN p IS NOT NULL THEN 2 END AS amenity_count
               FROM typed LEFT JOIN detailed USING (id))
    SELECT *, CASE WHEN calculated_host_listings_count > 1 THEN 'multi' ELSE 'single' END AS host_type,
           1 - availability_365 / 365 > 0.7 AS is_high_occupancy, 365 - availability_365 AS booked_nights_365,
           round(price * (365 - availability_365), 6) AS estimated_revenue_365
    FROM priced WHERE price > 0""",
)
def _(t):
    raw = raw_listings(t)
    doubled = raw.unionByName(raw)
    lines = t["lineitem"].groupBy("l_orderkey").agg(
        F.max("l_extendedprice").alias("price"),
        F.max("l_quantity").alias("beds"),
        F.max(F.when(F.col("l_linestatus") == "O", 1).otherwise(0)).alias("open"),
    )
    detailed = lines.select(
        F.col("l_orderkey").cast("string").alias("id"),
        F.lit("porto").alias("city"),
        F.concat(F.lit("$"), F.format_number("price", 2)).alias("price"),
        F.col("beds").cast("string").alias("beds"),
        F.when(F.col("open") == 1, "t").otherwise("f").alias("host_is_superhost"),
        F.lit('["Wifi", "Kitchen, shared"]').alias("amenities"),
    )
    return rounded(cleaning.clean_listings(doubled, cleaning.clean_detailed(detailed)))


@entry(
    "clean_calendar",
    f"""{RAW_CALENDAR}
    SELECT *, CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month,
           CAST(dayofweek(date) + 1 AS INTEGER) AS dow FROM days""",
)
def _(t):
    return cleaning.clean_calendar(raw_calendar(t))


@entry(
    "clean_reviews",
    """
    SELECT DISTINCT CAST(l_orderkey AS VARCHAR) AS listing_id, CAST(l_shipdate AS DATE) AS date,
           CAST(year(l_shipdate) AS INTEGER) AS year, CAST(month(l_shipdate) AS INTEGER) AS month FROM lineitem""",
)
def _(t):
    rows = t["lineitem"].select(
        F.col("l_orderkey").cast("string").alias("listing_id"),
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("date"),
    )
    return cleaning.clean_reviews(rows.unionByName(rows))


@entry(
    "clean_reviews_by_reviewer",
    """
    SELECT DISTINCT CAST(l_orderkey AS VARCHAR) AS listing_id, CAST(l_suppkey AS VARCHAR) AS reviewer_id,
           CAST(l_shipdate AS DATE) AS date, CAST(year(l_shipdate) AS INTEGER) AS year,
           CAST(month(l_shipdate) AS INTEGER) AS month FROM lineitem""",
)
def _(t):
    rows = t["lineitem"].select(
        F.col("l_orderkey").cast("string").alias("listing_id"),
        F.col("l_suppkey").cast("string").alias("reviewer_id"),
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("date"),
    )
    return cleaning.clean_reviews(rows.unionByName(rows))


@entry(
    "price_bands",
    """
    SELECT CASE WHEN c_acctbal < 30 THEN 'budget_<30' WHEN c_acctbal < 75 THEN 'mid_30-75'
                WHEN c_acctbal < 150 THEN 'upper_75-150' ELSE 'luxury_150+' END AS price_range,
           count(*) AS n, min(c_acctbal) AS lowest FROM customer GROUP BY 1""",
)
def _(t):
    banded = t["customer"].groupBy(labels.bands("c_acctbal").alias("price_range"))
    return banded.agg(F.count("*").alias("n"), F.min("c_acctbal").alias("lowest"))


@entry(
    "shorten_label",
    """
    SELECT doc_id, CASE WHEN length(text) > 42 THEN concat(substr(text, 1, 39), '...') ELSE text END AS label,
           CASE WHEN length(source) > 4 THEN concat(substr(source, 1, 3), '…') ELSE source END AS source_label
    FROM documents""",
)
def _(t):
    return t["documents"].select(
        "doc_id",
        labels.shorten("text", 42).alias("label"),
        labels.shorten("source", 4, "…").alias("source_label"),
    )


@entry(
    "csv_roundtrip",
    """
    SELECT o_orderkey AS id, o_totalprice AS price, CAST(o_orderdate AS DATE) AS listed_on,
           concat(o_orderpriority, ', "', o_orderstatus, '"', chr(10), 'note') AS note, 'porto' AS city FROM orders""",
)
def _(t):
    folder = scratch.new_folder(t.spark, "csv")
    rows = t["orders"].select(
        F.col("o_orderkey").alias("id"),
        F.col("o_totalprice").alias("price"),
        F.col("o_orderdate").cast("date").alias("listed_on"),
        F.concat("o_orderpriority", F.lit(', "'), "o_orderstatus", F.lit('"\nnote')).alias("note"),
    )
    rows.write.option("header", True).option("escape", '"').csv(f"{folder}/listings.csv")
    raw = tables.read_city_csv(t.spark, folder, "listings", "porto")
    typed = cleaning.cast_columns(cleaning.cast_columns(raw, ["id"], "bigint"), ["price"])
    return typed.withColumn("listed_on", parsing.iso_date("listed_on"))


@entry(
    "unify_common_columns",
    """
    SELECT o_orderkey AS id, o_totalprice AS price, 'a' AS city FROM orders WHERE o_orderstatus = 'F'
    UNION ALL SELECT o_orderkey, o_totalprice, 'b' FROM orders WHERE o_orderstatus <> 'F'""",
)
def _(t):
    orders = t["orders"].withColumnsRenamed({"o_orderkey": "id", "o_totalprice": "price"})
    a = orders.where("o_orderstatus = 'F'").select("id", "price", "o_orderdate", F.lit("a").alias("city"))
    b = orders.where("o_orderstatus <> 'F'").select(F.lit("b").alias("city"), "o_orderpriority", "price", "id")
    return tables.unify([a, b])


@entry(
    "partitioned_roundtrip",
    """
    SELECT l_orderkey, l_linenumber, l_extendedprice, l_returnflag FROM lineitem WHERE l_returnflag IN ('A', 'R')""",
)
def _(t):
    path = scratch.new_folder(t.spark, "partitioned")
    columns = ["l_orderkey", "l_linenumber", "l_extendedprice", "l_returnflag"]
    tables.write_table(t["lineitem"].select(*columns), path, "l_returnflag")
    return tables.read_table(t.spark, path).where(F.col("l_returnflag").isin("A", "R"))


@entry("select_available_columns", "SELECT p_brand, p_partkey, p_size FROM part")
def _(t):
    return tables.select_available(t["part"], ["p_brand", "absent_column", "p_partkey", "p_size"])


@entry(
    "csv_single_file_export",
    """
    SELECT city, room_type, CAST(count(id) AS BIGINT) AS n_listings,
           round(count(id) / CAST(sum(count(id)) OVER (PARTITION BY city) AS DOUBLE), 6) AS share
    FROM r_listings GROUP BY city, room_type""",
    roles="r_listings",
)
def _(t):
    path = f"{scratch.new_folder(t.spark, 'report')}/shares"
    tables.export_report(rankings.share_of_parent(roles.listings(t)), path, single_csv=True)
    stored = tables.read_csv(t.spark, f"{path}.csv")
    return rounded(cleaning.cast_columns(cleaning.cast_columns(stored, ["n_listings"], "bigint"), ["share"]))
