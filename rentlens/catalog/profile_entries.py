"""Profiles, distributions and dashboard figures."""

from pyspark.sql import functions as F

from ..functions import labels
from ..operators import cleaning, distributions, occupancy, profiling, rankings, trends
from . import roles
from .registry import entry, rounded, sql_avg

PRICE_TOP = 450000
PIVOT_CITIES = ", ".join(
    f"coalesce(count(*) FILTER (city = '{c}'), 0) AS \"{c}\"" for c in roles.CITIES
)


@entry(
    "dataset_overview",
    """
    WITH counts AS (
      SELECT 'listings' AS dataset, 8 AS columns, city, count(*) AS rows FROM r_listings GROUP BY city
      UNION ALL SELECT 'calendar', 5, city, count(*) FROM r_lines GROUP BY city
      UNION ALL SELECT 'reviews', 4, city, count(*) FROM r_lines GROUP BY city)
    SELECT dataset, CAST(columns AS INTEGER) AS columns, city, rows,
           CAST(sum(rows) OVER (PARTITION BY dataset) AS BIGINT) AS total_rows,
           CAST(round(CAST(100.0 * rows / sum(rows) OVER (PARTITION BY dataset) AS DECIMAL(30,9)), 1) AS DOUBLE) AS pct FROM counts""",
    roles="r_listings r_lines",
)
def _(t):
    return profiling.dataset_overview(
        {"listings": roles.listings(t), "calendar": roles.city_calendar(t), "reviews": roles.city_reviews(t)}
    )


@entry(
    "missing_profile",
    """
    WITH total AS (SELECT count(*) AS n, count(*) FILTER (availability_365 IS NULL) AS a,
                          count(*) FILTER (number_of_reviews IS NULL) AS r,
                          count(*) FILTER (room_type IS NULL OR room_type = '5-LOW') AS e FROM r_listings)
    SELECT * FROM (
      SELECT 'availability_365' AS "column", a AS missing, CAST(round(CAST(100.0 * a / n AS DECIMAL(30,9)), 1) AS DOUBLE) AS pct FROM total
      UNION ALL SELECT 'number_of_reviews', r, CAST(round(CAST(100.0 * r / n AS DECIMAL(30,9)), 1) AS DOUBLE) FROM total
      UNION ALL SELECT 'room_type', e, CAST(round(CAST(100.0 * e / n AS DECIMAL(30,9)), 1) AS DOUBLE) FROM total) WHERE missing > 0""",
    roles="r_listings",
)
def _(t):
    rows = roles.listings(t, activity=True).select(
        "id",
        "city",
        "price",
        "availability_365",
        "number_of_reviews",
        F.when(F.col("room_type") == "5-LOW", "").otherwise(F.col("room_type")).alias("room_type"),
    )
    return profiling.missing_profile(rows)


@entry(
    "group_share_topn",
    """
    WITH counts AS (SELECT city, neighbourhood, count(*) AS n FROM r_listings GROUP BY ALL),
    ranked AS (SELECT *, 100.0 * n / sum(n) OVER (PARTITION BY city) AS share,
               CAST(row_number() OVER (PARTITION BY city ORDER BY n DESC, neighbourhood) AS INTEGER) AS rank FROM counts)
    SELECT city, neighbourhood, n, round(share, 6) AS share, rank,
           CASE WHEN length(neighbourhood) > 12 THEN concat(substr(neighbourhood, 1, 9), '...') ELSE neighbourhood END AS label
    FROM ranked WHERE rank <= 6""",
    roles="r_listings",
)
def _(t):
    return rounded(rankings.top_share(roles.listings(t), label=labels.shorten("neighbourhood", 12)))


@entry(
    "value_distribution",
    "SELECT city, number_of_reviews, count(*) AS n FROM r_listings WHERE number_of_reviews IS NOT NULL GROUP BY ALL",
    roles="r_listings",
)
def _(t):
    return profiling.value_distribution(roles.listings(t, activity=True), "number_of_reviews", ["city"])


@entry(
    "quartile_stats",
    f"""
    SELECT city, CAST(round(CAST({sql_avg("availability_365")} AS DECIMAL(30,9)), 1) AS DOUBLE) AS mean,
           CAST(quantile_disc(availability_365, 0.5) AS BIGINT) AS median,
           CAST(quantile_disc(availability_365, 0.25) AS BIGINT) AS q1,
           CAST(quantile_disc(availability_365, 0.75) AS BIGINT) AS q3
    FROM r_listings GROUP BY city""",
    roles="r_listings",
)
def _(t):
    return distributions.quartile_stats(roles.listings(t, activity=True), "availability_365")


def _quantiles(points: dict[str, float], column: str = "price") -> str:
    return ", ".join(f"quantile_disc({column}, {p}) AS {name}" for name, p in points.items())


@entry(
    "price_summary",
    f"""
    SELECT city, count(*) AS n, CAST(round(CAST({sql_avg("price")} AS DECIMAL(30,9)), 2) AS DOUBLE) AS avg, min(price) AS min, max(price) AS max,
           CAST(round(CAST(stddev_samp(price) AS DECIMAL(30,9)), 2) AS DOUBLE) AS std,
           {_quantiles({"p25": 0.25, "median": 0.5, "p75": 0.75, "p90": 0.9, "p95": 0.95, "p99": 0.99})}
    FROM r_listings WHERE price > 0 AND price < {PRICE_TOP} GROUP BY city""",
    roles="r_listings",
)
def _(t):
    return distributions.price_summary(roles.listings(t), below=PRICE_TOP)


@entry(
    "quantile_array",
    f"""
    SELECT city, {_quantiles({"q25": 0.25, "median_q50": 0.5, "q75": 0.75, "q90": 0.9, "q95": 0.95, "q99": 0.99})}
    FROM r_listings GROUP BY city""",
    roles="r_listings",
)
def _(t):
    return distributions.sketch_table(roles.listings(t))


LIMITS = "(SELECT unnest([100000, 250000, 499950]) AS threshold)"


@entry(
    "outliers_long",
    f"""
    WITH totals AS (SELECT city, count(*) AS total FROM r_listings WHERE price > 0 GROUP BY city),
    above AS (SELECT city, CAST(threshold AS INTEGER) AS threshold, count(*) AS outlier_count
              FROM r_listings JOIN {LIMITS} ON price > threshold GROUP BY ALL)
    SELECT city, threshold, outlier_count, total, CAST(round(CAST(100.0 * outlier_count / total AS DECIMAL(30,9)), 2) AS DOUBLE) AS percentage
    FROM above JOIN totals USING (city)""",
    roles="r_listings",
)
def _(t):
    return distributions.thresholds_long(roles.listings(t), [100000, 250000, 499950])


@entry(
    "outliers_global",
    """
    WITH lim AS (SELECT unnest([100000, 250000, 600000]) AS threshold)
    SELECT CAST(threshold AS INTEGER) AS threshold, count(*) FILTER (o_totalprice > threshold) AS outlier_count,
           count(*) AS total, CAST(round(CAST(100.0 * count(*) FILTER (o_totalprice > threshold) / count(*) AS DECIMAL(30,9)), 2) AS DOUBLE) AS percentage
    FROM orders, lim WHERE o_totalprice > 0 GROUP BY threshold""",
)
def _(t):
    return distributions.thresholds_long(t["orders"], [100000, 250000, 600000], (), "o_totalprice")


@entry(
    "price_by_category",
    f"""
    SELECT city, room_type, CAST(round(CAST({sql_avg("price")} AS DECIMAL(30,9)), 2) AS DOUBLE) AS avg_price, quantile_disc(price, 0.5) AS median_price,
           count(*) AS n
    FROM r_listings WHERE price > 0 AND price < {PRICE_TOP} GROUP BY ALL""",
    roles="r_listings",
)
def _(t):
    return distributions.price_by_category(roles.listings(t), below=PRICE_TOP)


@entry(
    "top_avg_min_n",
    f"""
    WITH stats AS (SELECT city, neighbourhood, CAST(round(CAST({sql_avg("price")} AS DECIMAL(30,9)), 2) AS DOUBLE) AS avg_price, count(*) AS n
                   FROM r_listings WHERE price > 0 AND price < {PRICE_TOP} GROUP BY ALL HAVING count(*) >= 30)
    SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY city ORDER BY avg_price DESC, neighbourhood) AS INTEGER)
                   AS rank FROM stats) WHERE rank <= 10""",
    roles="r_listings",
)
def _(t):
    return rankings.top_mean(roles.listings(t), below=PRICE_TOP)


@entry(
    "date_range",
    "SELECT min(CAST(l_shipdate AS DATE)) AS start_date, max(CAST(l_shipdate AS DATE)) AS end_date FROM lineitem",
)
def _(t):
    return profiling.date_range(roles.calendar(t))


@entry(
    "calendar_overview",
    f"""
    SELECT city, count(*) AS total_rows, count(DISTINCT l_partkey) AS unique_listings,
           count(*) FILTER (available) AS available_days, count(*) FILTER (NOT available) AS blocked_days,
           CAST(round(CAST({sql_avg("l_extendedprice")} AS DECIMAL(30,9)), 2) AS DOUBLE) AS avg_price,
           CAST(round(CAST(100.0 * count(*) FILTER (available) / count(*) AS DECIMAL(30,9)), 2) AS DOUBLE) AS available_pct,
           CAST(round(CAST(100.0 * count(*) FILTER (NOT available) / count(*) AS DECIMAL(30,9)), 2) AS DOUBLE) AS blocked_pct
    FROM r_lines GROUP BY city""",
    roles="r_lines",
)
def _(t):
    return occupancy.calendar_overview(roles.city_calendar(t), price="adjusted_price")



@entry(
    "monthly_rate",
    """
    SELECT city, year, month, count(*) AS total, count(*) FILTER (available) AS available_count,
           round(count(*) FILTER (available) / CAST(count(*) AS DOUBLE), 6) AS availability_rate
    FROM r_lines GROUP BY ALL""",
    roles="r_lines",
)
def _(t):
    return rounded(occupancy.monthly_rate(roles.city_calendar(t)))


@entry(
    "monthly_rate_known",
    """
    SELECT city, year, month, count(available) AS total, count(*) FILTER (available) AS available_count,
           round(count(*) FILTER (available) / CAST(count(available) AS DOUBLE), 6) AS availability_rate
    FROM r_lines GROUP BY ALL""",
    roles="r_lines",
)
def _(t):
    return rounded(occupancy.monthly_rate(roles.city_calendar(t), unknown="ignore"))


@entry(
    "coverage",
    """
    SELECT city, count(available) AS non_null, count(*) AS total,
           CAST(round(CAST(100.0 * count(available) / count(*) AS DECIMAL(30,9)), 1) AS DOUBLE) AS pct_non_null FROM r_lines GROUP BY city""",
    roles="r_lines",
)
def _(t):
    return occupancy.coverage(roles.city_calendar(t), "available")


@entry(
    "monthly_mean_positive",
    f"""
    SELECT city, year, month, CAST(round(CAST({sql_avg("l_extendedprice")} AS DECIMAL(30,9)), 2) AS DOUBLE) AS avg_adjusted_price
    FROM r_lines WHERE l_extendedprice > 0 GROUP BY ALL""",
    roles="r_lines",
)
def _(t):
    return occupancy.monthly_mean_positive(roles.city_calendar(t), "adjusted_price")


@entry(
    "activity_overview",
    """
    SELECT city, count(*) AS total_reviews, count(DISTINCT l_partkey) AS reviewed_listings,
           count(DISTINCT l_suppkey) AS unique_reviewers, min(date) AS first_review, max(date) AS last_review
    FROM r_lines GROUP BY city""",
    roles="r_lines",
)
def _(t):
    return profiling.activity_overview(roles.city_reviews(t))


@entry(
    "group_with_fallback",
    """
    WITH named AS (SELECT city, CASE WHEN city = 'ASIA' THEN neighbourhood ELSE neighbourhood_group END AS label,
                          CASE WHEN city = 'ASIA' THEN 2 ELSE 1 END AS level FROM r_listings),
    counts AS (SELECT city, level, label, count(*) AS n FROM named GROUP BY ALL)
    SELECT city, CAST(level AS INTEGER) AS level, label, n, rank FROM (
      SELECT *, CAST(row_number() OVER (PARTITION BY city ORDER BY n DESC, label) AS INTEGER) AS rank FROM counts)
    WHERE level = 1 OR rank <= 15""",
    roles="r_listings",
)
def _(t):
    return rankings.group_with_fallback(roles.listings_gaps(t))


@entry(
    "city_summary",
    f"""
    WITH dom AS (SELECT city, room_type FROM (
      SELECT city, room_type, row_number() OVER (PARTITION BY city ORDER BY count(*) DESC, room_type) AS rn
      FROM r_listings GROUP BY city, room_type) WHERE rn = 1),
    cal AS (SELECT city, count(*) AS total_reviews,
                   CAST(round(CAST(100.0 * count(*) FILTER (available) / count(available) AS DECIMAL(30,9)), 1) AS DOUBLE) AS availability_rate_pct
            FROM r_lines GROUP BY city)
    SELECT city, count(id) AS n_listings, CAST(round(CAST({sql_avg("price")} AS DECIMAL(30,9)), 0) AS DOUBLE) AS avg_price,
           CAST(round(CAST(quantile_disc(price, 0.5) AS DECIMAL(30,9)), 0) AS DOUBLE) AS median_price,
           CAST(round(CAST({sql_avg("number_of_reviews")} AS DECIMAL(30,9)), 1) AS DOUBLE) AS avg_reviews_per_listing,
           CAST(round(CAST({sql_avg("reviews_per_month")} AS DECIMAL(30,9)), 2) AS DOUBLE) AS avg_rating,
           CAST(round(CAST({sql_avg("availability_365")} AS DECIMAL(30,9)), 0) AS DOUBLE) AS avg_availability,
           first(dom.room_type) AS dominant_room_type, first(total_reviews) AS total_reviews,
           first(availability_rate_pct) AS availability_rate_pct
    FROM r_listings JOIN dom USING (city) JOIN cal USING (city) WHERE price > 0 GROUP BY city""",
    roles="r_listings r_lines",
)
def _(t):
    return profiling.city_summary(
        roles.listings(t, activity=True), roles.city_calendar(t), roles.city_reviews(t), rating="reviews_per_month"
    )


@entry(
    "hash_sample",
    """
    SELECT id, city, price FROM r_listings
    WHERE CAST('0x' || substr(md5('42:' || CAST(id AS VARCHAR)), 1, 8) AS BIGINT) % 100 < 5""",
    roles="r_listings",
)
def _(t):
    return distributions.hash_sample(roles.listings(t).select("id", "city", "price"))


HISTOGRAM = """
    WITH kept AS (SELECT city, price FROM r_listings WHERE price > 0 AND price < 450000),
    edges AS (SELECT city, min(price) AS lo, max(price) AS hi, count(*) AS total FROM kept GROUP BY city),
    placed AS (SELECT city, lo, (hi - lo) / {bins}::DOUBLE AS width, total,
                      CAST(least(floor((price - lo) / ((hi - lo) / {bins}::DOUBLE)), {bins} - 1) AS INTEGER) AS bin
               FROM kept JOIN edges USING (city))
    SELECT city, bin, round(first(lo) + bin * first(width), 6) AS left_edge, count(*) AS n{density}
    FROM placed GROUP BY city, bin"""


@entry("histogram", HISTOGRAM.format(bins=80, density=""), roles="r_listings")
def _(t):
    return rounded(distributions.histogram(roles.listings(t), bins=80, below=PRICE_TOP))


@entry(
    "histogram_density",
    HISTOGRAM.format(bins=55, density=", round(1e6 * count(*) / (first(total) * first(width)), 6) AS density"),
    roles="r_listings",
)
def _(t):
    out = distributions.histogram(roles.listings(t), bins=55, below=PRICE_TOP, density=True)
    # Densities of six-digit prices are small; per million they keep their digits when rounded.
    return rounded(out.withColumn("density", 1e6 * F.col("density")))


@entry("crosstab", f"SELECT room_type, {PIVOT_CITIES} FROM r_listings GROUP BY room_type", roles="r_listings")
def _(t):
    return trends.crosstab(roles.listings(t), "room_type", "city", roles.CITIES)


@entry(
    "crosstab_pct",
    "SELECT room_type, "
    + ", ".join(f"CAST(round(CAST(100.0 * count(*) FILTER (city = '{c}') / count(*) AS DECIMAL(30,9)), 2) AS DOUBLE) AS \"{c}\"" for c in roles.CITIES)
    + " FROM r_listings GROUP BY room_type",
    roles="r_listings",
)
def _(t):
    return trends.crosstab(roles.listings(t), "room_type", "city", roles.CITIES, percent_of="row")


@entry(
    "city_stats",
    f"""
    SELECT city, count(*) AS total_listings, CAST(round(CAST({sql_avg("minimum_nights")} AS DECIMAL(30,9)), 2) AS DOUBLE) AS avg_minimum_nights,
           CAST(round(CAST({sql_avg("availability_365")} AS DECIMAL(30,9)), 1) AS DOUBLE) AS avg_availability_365,
           CAST(round(CAST({sql_avg("reviews_per_month")} AS DECIMAL(30,9)), 3) AS DOUBLE) AS avg_reviews_per_month,
           CAST(round(CAST({sql_avg("number_of_reviews")} AS DECIMAL(30,9)), 1) AS DOUBLE) AS avg_number_of_reviews
    FROM r_listings GROUP BY city""",
    roles="r_listings",
)
def _(t):
    means = {
        "avg_minimum_nights": ("minimum_nights", 2),
        "avg_availability_365": ("availability_365", 1),
        "avg_reviews_per_month": ("reviews_per_month", 3),
        "avg_number_of_reviews": ("number_of_reviews", 1),
    }
    return profiling.rounded_means(roles.listings(t, activity=True), means)


@entry(
    "boxplot_stats",
    """
    WITH q AS (SELECT city, room_type, count(*) AS n, quantile_cont(price, 0.25) AS q1,
                      quantile_cont(price, 0.5) AS median, quantile_cont(price, 0.75) AS q3
               FROM r_listings GROUP BY ALL)
    SELECT city, room_type, n, round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3,
           round(least(q1, min(price) FILTER (price >= q1 - 0.2 * (q3 - q1))), 6) AS whisker_low,
           round(greatest(q3, max(price) FILTER (price <= q3 + 0.2 * (q3 - q1))), 6) AS whisker_high,
           count(*) FILTER (price < q1 - 0.2 * (q3 - q1) OR price > q3 + 0.2 * (q3 - q1)) AS n_fliers
    FROM r_listings JOIN q USING (city, room_type) GROUP BY city, room_type, n, q1, median, q3""",
    roles="r_listings",
)
def _(t):
    # Prices are spread evenly here; a short reach makes sure that some lie beyond the whiskers.
    return rounded(distributions.boxplot(roles.listings(t), by=["city", "room_type"], reach=0.2))


@entry(
    "headline_metrics",
    """
    SELECT city, count(*) AS n_listings, count(DISTINCT host_id) AS n_hosts,
           round(100.0 * count(*) FILTER (host_type = 'multi') / count(*), 6) AS multi_share_pct,
           round(quantile_cont(price, 0.5), 6) AS median_price
    FROM r_listings GROUP BY city""",
    roles="r_listings",
)
def _(t):
    return rounded(profiling.headline_metrics(roles.listings(t, hosts_counted=True)))


@entry(
    "municipality_breakdown",
    """
    SELECT city, neighbourhood_group, count(id) AS n_listings, round(quantile_cont(price, 0.5), 6) AS median_price
    FROM r_listings WHERE city <> 'ASIA' GROUP BY ALL""",
    roles="r_listings",
)
def _(t):
    return rounded(profiling.group_breakdown(roles.listings_gaps(t)))


SLICE = """city IN ('ASIA', 'EUROPE', 'AFRICA') AND room_type IN ('1-URGENT', '5-LOW', '2-HIGH')
      AND price BETWEEN 50000 AND 400000"""


def _slice(t):
    return cleaning.slice_rows(
        roles.listings(t),
        {"city": ["ASIA", "EUROPE", "AFRICA"], "room_type": ["1-URGENT", "5-LOW", "2-HIGH"]},
        {"price": (50000, 400000)},
    )


@entry(
    "slice_median",
    f"""
    SELECT 'room_type' AS dimension, room_type AS value, count(*) AS n, round(quantile_cont(price, 0.5), 6) AS median_price
    FROM r_listings WHERE {SLICE} GROUP BY room_type
    UNION ALL
    SELECT 'neighbourhood_group', neighbourhood_group, count(*), round(quantile_cont(price, 0.5), 6)
    FROM r_listings WHERE {SLICE} GROUP BY neighbourhood_group""",
    roles="r_listings",
)
def _(t):
    rows = _slice(t)
    tagged = rows.select("price", F.stack(
        F.lit(2), F.lit("room_type"), F.col("room_type"), F.lit("neighbourhood_group"), F.col("neighbourhood_group")
    ).alias("dimension", "value"))
    return rounded(distributions.medians(tagged, ["dimension", "value"]))


@entry(
    "rounded_histogram",
    """
    SELECT CAST(round_even(o_totalprice, -4) AS DOUBLE) AS level, count(*) AS n FROM orders
    GROUP BY 1 ORDER BY 1 LIMIT 40""",
)
def _(t):
    return distributions.rounded_histogram(t["orders"], "o_totalprice", 4)


@entry(
    "quartile_bucket",
    """
    WITH kept AS (SELECT id, price FROM r_listings WHERE city = 'EUROPE' AND price <= 2 * 200000),
    q AS (SELECT quantile_cont(price, 0.25) AS q1, quantile_cont(price, 0.5) AS q2, quantile_cont(price, 0.75) AS q3 FROM kept)
    SELECT id, price, CASE WHEN price <= q1 THEN 'lowest' WHEN price <= q2 THEN 'second' WHEN price <= q3 THEN 'third'
           ELSE 'highest' END AS quartile FROM kept, q""",
    roles="r_listings",
)
def _(t):
    rows = roles.listings(t).where("city = 'EUROPE'").select("id", "price")
    return distributions.quartile_bucket(rows, cap=200000)


@entry(
    "group_centroid",
    f"""
    SELECT neighbourhood_group, round({sql_avg("latitude")}, 6) AS center_latitude,
           round({sql_avg("longitude")}, 6) AS center_longitude FROM r_listings GROUP BY ALL""",
    roles="r_listings",
)
def _(t):
    return rounded(profiling.group_centroid(roles.listings(t, places=True)))


@entry(
    "group_mean_top",
    f"""
    SELECT neighbourhood, round({sql_avg("price")}, 6) AS mean_price FROM r_listings GROUP BY neighbourhood
    ORDER BY {sql_avg("price")} DESC, neighbourhood LIMIT 20""",
    roles="r_listings",
)
def _(t):
    return rounded(rankings.mean_by_group_top(roles.listings(t), "neighbourhood", "price"))


@entry(
    "group_mean_rate_top",
    f"""
    WITH rates AS (SELECT neighbourhood, reviews_per_month / number_of_reviews / 10 AS rate FROM r_listings)
    SELECT neighbourhood, round({sql_avg("rate")}, 9) AS mean_rate FROM rates GROUP BY neighbourhood
    ORDER BY {sql_avg("rate")} DESC, neighbourhood LIMIT 20""",
    roles="r_listings",
)
def _(t):
    """A metric far below a hundredth, so that its order shows any rounding of the values."""
    rate = F.col("reviews_per_month") / F.col("number_of_reviews") / F.lit(10)
    rows = roles.listings(t, activity=True).withColumn("rate", rate)
    return rounded(rankings.mean_by_group_top(rows, "neighbourhood", "rate"), 9)


@entry(
    "comparables",
    """
    SELECT city, neighbourhood_group, room_type, count(*) AS n, round(quantile_cont(price, 0.5), 6) AS median_price,
           round(quantile_cont(price, 0.25), 6) AS p25, round(quantile_cont(price, 0.75), 6) AS p75
    FROM r_listings GROUP BY ALL""",
    roles="r_listings",
)
def _(t):
    points = {"median_price": 0.5, "p25": 0.25, "p75": 0.75}
    by = ["city", "neighbourhood_group", "room_type"]
    return rounded(distributions.exact_quantiles(roles.listings(t), "price", points, by))
