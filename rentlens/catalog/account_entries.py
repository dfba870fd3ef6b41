"""Raw city files with gaps: what could not be read, malformed lines, detailed files of some cities, named workloads."""

from pyspark.sql import Observation
from pyspark.sql import functions as F

from ..functions import parsing
from ..operators import cleaning
from ..plans import ingestion, market, workloads
from ..sources import scratch, tables
from . import roles
from .cleaning_entries import raw_listings
from .registry import ENTRIES, entry, rounded

ACCOUNT = """SELECT '{}' AS column, count(*) AS n_rows, {} AS n_malformed, count(*) FILTER ({}) AS n_missing,
                    count(*) FILTER ({}) AS n_unreadable FROM orders"""


def account_sql(malformed: str, *columns: tuple[str, str, str]) -> str:
    return " UNION ALL ".join(ACCOUNT.format(c, malformed, missing, unreadable) for c, missing, unreadable in columns).replace("{k}", "o_orderkey % 50")


@entry(
    "account_of_listings",
    account_sql(
        "0::BIGINT",
        ("price", "{k} = 11", "{k} = 7"),
        ("last_review", "{k} = 4 OR {k} <> 3 AND o_orderdate IS NULL", "{k} = 3"),
        ("minimum_nights", "false", "{k} = 8"),
        ("availability_365", "{k} = 6", "false"),
        ("calculated_host_listings_count", "{k} = 5", "false"),
        ("reviews_per_month", "{k} <= 1", "false"),
    ),
)
def _(t):
    """Counted by the pass that stores the cleaned listings."""
    account = Observation("listings")
    scratch.stored(cleaning.clean_listings(raw_listings(t), account=account), "cleaned")
    return cleaning.account_rows(t.spark, account)


@entry(
    "account_of_malformed_lines",
    account_sql(
        "count(*) FILTER ({k} IN (9, 10))",
        ("price", "{k} = 11", "{k} = 7"),
        ("listed_on", "{k} = 9", "{k} = 3"),
    ),
)
def _(t):
    """Lines that lack their last field and lines with one too many, in plain files."""
    k, path = F.col("o_orderkey") % 50, scratch.new_folder(t.spark, "lines")
    price = F.when(k == 7, "abc").when(k == 11, " ").otherwise(F.col("o_totalprice").cast("string"))
    day = F.when(k == 3, "2025-13-99").otherwise(F.date_format(F.coalesce("o_orderdate", F.lit("2000-01-01")), "yyyy-MM-dd"))
    fields = F.when(k == 9, F.array(price)).when(k == 10, F.array(price, day, F.lit("x"))).otherwise(F.array(price, day))
    lines = t["orders"].select(F.concat_ws(",", F.col("o_orderkey").cast("string"), F.array_join(fields, ",")).alias("id,price,listed_on"))
    # The separator does not occur, so the writer quotes nothing and the header has three names.
    lines.write.options(header=True, sep="\u0001").csv(f"{path}/listings.csv")
    account = Observation("lines")
    raw = tables.read_city_csv(t.spark, path, "listings", "porto", multiline=False, keep_malformed=True)
    readings = {"price": parsing.money("price"), "listed_on": parsing.iso_date("listed_on")}
    scratch.stored(cleaning.read_columns(raw, readings, account), "cleaned")
    return cleaning.account_rows(t.spark, account)


@entry(
    "detailed_cities",
    """
    SELECT CAST(id AS VARCHAR) AS id, city, room_type, CAST(CASE WHEN city <> 'AFRICA' THEN id % 4 END AS DOUBLE) AS bedrooms,
           CASE WHEN city <> 'AFRICA' AND id % 2 = 0 THEN round(price + 1, 2) ELSE price END AS price
    FROM r_listings WHERE city IN ('AFRICA', 'ASIA', 'EUROPE')""",
    roles="r_listings",
)
def _(t):
    """One city has compressed files, one no detailed file, and only one detailed file names superhosts."""
    raw, interim = scratch.new_folder(t.spark, "raw"), scratch.new_folder(t.spark, "interim")
    cities = {c: c.lower() for c in ("AFRICA", "ASIA", "EUROPE")}
    shown = lambda price: F.concat(F.lit("$"), F.format_number(price, 2))
    for city, folder in cities.items():
        homes = roles.listings(t).where(F.col("city") == city)
        packed = {"suffix": ".csv.gz", "compression": "gzip"} if city == "EUROPE" else {"suffix": ".csv", "compression": "none"}
        rows = homes.select("id", "room_type", shown(F.col("price")).alias("price"))
        rows.write.options(header=True, compression=packed["compression"]).csv(f"{raw}/{folder}/listings{packed['suffix']}")
        if city != "AFRICA":
            better = F.when(F.col("id") % 2 == 0, shown(F.col("price") + 1))
            flags = [F.lit("t").alias("host_is_superhost")] if city == "ASIA" else []
            details = homes.select("id", better.alias("price"), (F.col("id") % 4).alias("bedrooms"), *flags)
            details.write.options(header=True).csv(f"{raw}/{folder}/{ingestion.DETAILED}.csv")
    ingestion.ingest(t.spark, raw, interim, cities, ["listings"])
    stacked = tables.read_table(t.spark, f"{interim}/listings")
    return cleaning.clean_listings(stacked, ingestion.detailed_listings(t.spark, raw, cities))


def market_of(t) -> market.Market:
    return market.Market(roles.listings(t), roles.calendar(t), roles.reviews(t), roles.neighbourhoods(t))


@entry("workload_by_name", ENTRIES["w5_full_pipeline"].sql)
def _(t):
    return rounded(workloads.WORKLOADS["full_pipeline"](market_of(t)))


__all__ = ["ENTRIES"]
