"""The test tables in the role of rental tables: the Spark view and the SQL view of each.

Orders play listings, their customers the hosts and the geography, line items the calendar days and
the reviews. Flags are unknown on the seventh line of an order and region ASIA names no level-1 group
in ``listings_gaps``, which exercises the rules for missing values.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .registry import Tables

# The regions of the test tables and thresholds that split their values.
CITIES = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]
PRICE_LIMITS = [100000, 250000, 400000]
BAND_LIMITS = ((100000, "low"), (250000, "mid"), (400000, "upper"))
BAND_TOP = "top"
MULTI_ABOVE = 10


def geography(t: Tables, people: DataFrame, nation_key: str) -> DataFrame:
    """Add city and neighbourhood group to customers or suppliers."""
    nation, region = t["nation"], t["region"]
    places = nation.join(region, nation["n_regionkey"] == region["r_regionkey"])
    located = people.join(places, people[nation_key] == places["n_nationkey"])
    return located.withColumnsRenamed({"r_name": "city", "n_name": "neighbourhood_group"})


def with_neighbourhood(located: DataFrame) -> DataFrame:
    return located.withColumn("neighbourhood", F.concat_ws("/", "neighbourhood_group", "c_mktsegment"))


def hosts(t: Tables) -> DataFrame:
    """Customers with geography."""
    return with_neighbourhood(geography(t, t["customer"], "c_nationkey"))


def counted_customers(t: Tables) -> DataFrame:
    """Customers with their number of orders."""
    counts = t["orders"].groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("host_listings"))
    return t["customer"].join(counts, "c_custkey")


def listings(t: Tables, hosts_counted: bool = False, activity: bool = False, places: bool = False) -> DataFrame:
    """One row per order; the joins for host counts and line activity only where asked for."""
    orders, people = t["orders"], counted_customers(t) if hosts_counted else t["customer"]
    sold = orders.join(people, orders["o_custkey"] == people["c_custkey"])
    out = with_neighbourhood(geography(t, sold, "c_nationkey"))
    columns = {
        "id": F.col("o_orderkey"),
        "host_id": F.col("o_custkey"),
        "city": F.col("city"),
        "neighbourhood_group": F.col("neighbourhood_group"),
        "neighbourhood": F.col("neighbourhood"),
        "room_type": F.col("o_orderpriority"),
        "price": F.col("o_totalprice"),
        "listed_on": F.col("o_orderdate").cast("date"),
    }
    if hosts_counted:
        columns["host_listings"] = F.col("host_listings")
        columns["host_type"] = F.when(F.col("host_listings") > MULTI_ABOVE, "multi").otherwise("single")
    if places:
        columns["latitude"] = F.col("n_nationkey") + F.col("o_custkey") % 100 / F.lit(100.0)
        columns["longitude"] = F.col("n_regionkey") + F.col("o_orderkey") % 100 / F.lit(100.0)
    if activity:
        lines = (
            t["lineitem"]
            .groupBy("l_orderkey")
            .agg(
                (F.sum("l_quantity").cast("bigint") % 366).alias("availability_365"),
                F.count("*").alias("number_of_reviews"),
                F.count_if(F.col("l_shipdate") >= "2000-01-01").alias("number_of_reviews_ltm"),
                F.sum(F.col("l_discount").cast("decimal(18,2)")).cast("double").alias("reviews_per_month"),
                F.min("l_linenumber").alias("minimum_nights"),
            )
        )
        out = out.join(lines, out["o_orderkey"] == lines["l_orderkey"], "left")
        for name in lines.columns[1:]:
            columns[name] = F.col(name)
    return out.select(*[c.alias(name) for name, c in columns.items()])


def flagged_lines(t: Tables) -> DataFrame:
    return t["lineitem"].select(
        "*",
        F.col("l_shipdate").cast("date").alias("date"),
        F.when(F.col("l_linenumber") < 7, F.col("l_linestatus") == "O").alias("available"),
    )


def calendar(t: Tables) -> DataFrame:
    """Days of listings; the city comes with the listing."""
    return flagged_lines(t).select(
        F.col("l_orderkey").alias("listing_id"), "date", "available", F.col("l_extendedprice").alias("adjusted_price")
    )


def supplier_lines(t: Tables) -> DataFrame:
    people = geography(t, t["supplier"], "s_nationkey")
    return flagged_lines(t).join(people, F.col("l_suppkey") == F.col("s_suppkey"))


def city_calendar(t: Tables) -> DataFrame:
    """Days that carry their city: parts as listings, the suppliers' region as city."""
    return supplier_lines(t).select(
        F.col("l_partkey").alias("listing_id"), "city", "date", "available", F.col("l_extendedprice").alias("adjusted_price")
    )


def reviews(t: Tables) -> DataFrame:
    return t["lineitem"].select(
        F.col("l_orderkey").alias("listing_id"),
        F.col("l_suppkey").alias("reviewer_id"),
        F.col("l_shipdate").cast("date").alias("date"),
    )


def city_reviews(t: Tables) -> DataFrame:
    return supplier_lines(t).select(
        F.col("l_partkey").alias("listing_id"), F.col("l_suppkey").alias("reviewer_id"), "city", "date"
    )


def neighbourhoods(t: Tables) -> DataFrame:
    people = hosts(t)
    return people.select("city", "neighbourhood_group", "neighbourhood").distinct()


def listings_gaps(t: Tables) -> DataFrame:
    """Listings with a region that has no level-1 groups."""
    named = F.when(F.col("city") != "ASIA", F.col("neighbourhood_group"))
    return listings(t).withColumn("neighbourhood_group", named)


VIEWS = {
    "r_listings": """
        SELECT o.o_orderkey AS id, o.o_custkey AS host_id, r.r_name AS city, n.n_name AS neighbourhood_group,
               concat(n.n_name, '/', c.c_mktsegment) AS neighbourhood, o.o_orderpriority AS room_type,
               o.o_totalprice AS price, CAST(o.o_orderdate AS DATE) AS listed_on,
               h.n_orders AS host_listings,
               CASE WHEN h.n_orders > 10 THEN 'multi' ELSE 'single' END AS host_type,
               n.n_nationkey + o.o_custkey % 100 / 100.0 AS latitude,
               n.n_regionkey + o.o_orderkey % 100 / 100.0 AS longitude,
               s.availability_365, s.number_of_reviews, s.number_of_reviews_ltm, s.reviews_per_month,
               s.minimum_nights
        FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
        JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey
        JOIN (SELECT o_custkey, count(*) AS n_orders FROM orders GROUP BY o_custkey) h ON h.o_custkey = o.o_custkey
        LEFT JOIN (SELECT l_orderkey, CAST(sum(l_quantity) AS BIGINT) % 366 AS availability_365,
                          count(*) AS number_of_reviews,
                          count(*) FILTER (l_shipdate >= TIMESTAMP '2000-01-01') AS number_of_reviews_ltm,
                          CAST(sum(CAST(l_discount AS DECIMAL(18,2))) AS DOUBLE) AS reviews_per_month,
                          min(l_linenumber) AS minimum_nights
                   FROM lineitem GROUP BY l_orderkey) s ON s.l_orderkey = o.o_orderkey""",
    "r_lines": """
        SELECT l.*, CAST(l_shipdate AS DATE) AS date, r_name AS city,
               CAST(year(l_shipdate) AS INTEGER) AS year, CAST(month(l_shipdate) AS INTEGER) AS month,
               CASE WHEN l_linenumber < 7 THEN l_linestatus = 'O' END AS available
        FROM lineitem l JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
        JOIN region ON n_regionkey = r_regionkey""",
    "r_calendar": """
        SELECT l_orderkey AS listing_id, CAST(l_shipdate AS DATE) AS date,
               CASE WHEN l_linenumber < 7 THEN l_linestatus = 'O' END AS available,
               CAST(year(l_shipdate) AS INTEGER) AS year, CAST(month(l_shipdate) AS INTEGER) AS month,
               l_extendedprice AS adjusted_price FROM lineitem""",
    "r_reviews": """
        SELECT l_orderkey AS listing_id, l_suppkey AS reviewer_id, CAST(l_shipdate AS DATE) AS date,
               CAST(year(l_shipdate) AS INTEGER) AS year, CAST(month(l_shipdate) AS INTEGER) AS month
        FROM lineitem""",
    "r_neighbourhoods": """
        SELECT DISTINCT r_name AS city, n_name AS neighbourhood_group, concat(n_name, '/', c_mktsegment) AS neighbourhood
        FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
}


def with_roles(names: str, sql: str) -> str:
    """Put the named views in front of a statement that may itself start with WITH."""
    views = [f"{name} AS ({VIEWS[name]})" for name in names.split()]
    sql = sql.strip()
    if not views:
        return sql
    if sql.upper().startswith("WITH "):
        return f"WITH {', '.join(views)}, {sql[5:]}"
    return f"WITH {', '.join(views)} {sql}"
