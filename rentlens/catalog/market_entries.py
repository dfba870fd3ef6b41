"""Market questions and heavy workloads."""

from pyspark.sql import functions as F

from ..ml import models
from ..operators import concentration, distributions, occupancy, profiling, rankings, trends
from . import roles
from .registry import entry, rounded, sql_avg, sql_sum


@entry(
    "q01_top_bottom",
    f"""
    WITH stats AS (
      SELECT city, neighbourhood_group, neighbourhood, quantile_disc(price, 0.5) AS median_price,
             round({sql_avg("price")}, 6) AS mean_price, count(id) AS n_listings
      FROM r_listings GROUP BY ALL HAVING count(id) >= 10),
    ranked AS (
      SELECT *, 'top' AS bucket, CAST(row_number() OVER (PARTITION BY city ORDER BY median_price DESC,
             neighbourhood_group, neighbourhood) AS INTEGER) AS rank FROM stats
      UNION ALL
      SELECT *, 'bottom', CAST(row_number() OVER (PARTITION BY city ORDER BY median_price,
             neighbourhood_group, neighbourhood) AS INTEGER) FROM stats)
    SELECT * FROM ranked WHERE rank <= 10""",
    roles="r_listings",
)
def _(t):
    return rounded(rankings.top_bottom(roles.listings(t)))


SEASON = f"""
    SELECT city, year, month, count(*) AS n_calendar_days,
           round(count(*) FILTER (available) / CAST(count(available) AS DOUBLE), 6) AS availability_rate,
           round(1 - count(*) FILTER (available) / CAST(count(available) AS DOUBLE), 6) AS occupancy_rate,
           {sql_sum("CASE WHEN NOT available THEN price ELSE 0 END")} AS estimated_revenue_proxy
    FROM r_calendar JOIN r_listings ON listing_id = id GROUP BY city, year, month"""


@entry("q02_seasonality", SEASON, roles="r_calendar r_listings")
def _(t):
    return rounded(occupancy.seasonality(roles.calendar(t), roles.listings(t)))


@entry(
    "q03_room_type",
    f"""
    SELECT city, room_type, round({sql_avg("availability_365")}, 6) AS avg_availability_365,
           round(1 - {sql_avg("availability_365")} / 365, 6) AS avg_occupancy_rate, count(id) AS n_listings
    FROM r_listings WHERE availability_365 IS NOT NULL GROUP BY city, room_type""",
    roles="r_listings",
)
def _(t):
    return rounded(profiling.category_rates(roles.listings(t, activity=True)))


GROUP_MEASURES = f"""
    quantile_disc(price, 0.5) AS median_price, round({sql_avg("price")}, 6) AS mean_price,
    round({sql_avg("reviews_per_month")}, 6) AS mean_reviews_per_month,
    round(1 - {sql_avg("availability_365")} / 365, 6) AS avg_occupancy_rate,
    count(id) AS n_listings, count(DISTINCT host_id) AS n_hosts"""


@entry(
    "q04_host_type",
    f"SELECT city, host_type, {GROUP_MEASURES} FROM r_listings GROUP BY city, host_type",
    roles="r_listings",
)
def _(t):
    rows = roles.listings(t, hosts_counted=True, activity=True)
    return rounded(profiling.compare_groups(rows, ["city", "host_type"]))


PARETO = """
    per_host AS (SELECT city, host_id, count(id) AS n FROM r_listings GROUP BY city, host_id),
    ranked AS (
      SELECT city, row_number() OVER w / CAST(count(*) OVER (PARTITION BY city) AS DOUBLE) AS host_pct,
             sum(n) OVER (w ROWS UNBOUNDED PRECEDING) / CAST(sum(n) OVER (PARTITION BY city) AS DOUBLE) AS share
      FROM per_host WINDOW w AS (PARTITION BY city ORDER BY n DESC, host_id)),
    points AS (
      SELECT city, d AS host_share, round(max(share), 6) AS listings_share
      FROM ranked JOIN (SELECT unnest([0.01, 0.05, 0.1, 0.2, 0.5, 1.0])::DOUBLE AS d) ON host_pct <= d
      GROUP BY city, d)"""


@entry("q05_pareto", f"WITH {PARETO} SELECT * FROM points", roles="r_listings")
def _(t):
    return rounded(concentration.pareto(roles.listings(t)))


@entry(
    "pareto_curve",
    f"WITH {PARETO} SELECT * FROM points UNION ALL SELECT DISTINCT city, 0.0::DOUBLE, 0.0::DOUBLE FROM points",
    roles="r_listings",
)
def _(t):
    return rounded(concentration.pareto_curve(roles.listings(t)))


@entry(
    "q06_corr",
    """
    SELECT city, neighbourhood_group, neighbourhood, count(id) AS n_listings,
           CASE WHEN isnan(corr(number_of_reviews, price)) THEN NULL
                ELSE round(corr(number_of_reviews, price), 6) END AS corr
    FROM r_listings WHERE number_of_reviews IS NOT NULL
    GROUP BY ALL HAVING count(id) >= 20""",
    roles="r_listings",
)
def _(t):
    rows = roles.listings(t, activity=True)
    return rounded(rankings.corr_by_group(rows, "number_of_reviews"))


@entry(
    "q07_top_revenue",
    f"""
    WITH revenue AS (SELECT *, price * (365 - availability_365) AS earned FROM r_listings),
    stats AS (
      SELECT city, neighbourhood_group, neighbourhood, {sql_sum("earned")} AS total_estimated_revenue,
             round({sql_avg("earned")}, 6) AS avg_estimated_revenue, quantile_disc(price, 0.5) AS median_price,
             count(id) AS n_listings
      FROM revenue WHERE earned IS NOT NULL GROUP BY ALL)
    SELECT * FROM (
      SELECT *, CAST(row_number() OVER (PARTITION BY city ORDER BY total_estimated_revenue DESC,
             neighbourhood_group, neighbourhood) AS INTEGER) AS rank FROM stats) WHERE rank <= 10""",
    roles="r_listings",
)
def _(t):
    from ..operators import cleaning

    return rounded(rankings.top_by_total(cleaning.occupancy_columns(roles.listings(t, activity=True))))


@entry(
    "q08_share",
    """
    SELECT city, room_type, count(id) AS n_listings,
           round(count(id) / CAST(sum(count(id)) OVER (PARTITION BY city) AS DOUBLE), 6) AS share
    FROM r_listings GROUP BY city, room_type""",
    roles="r_listings",
)
def _(t):
    return rounded(rankings.share_of_parent(roles.listings(t)))


@entry(
    "q09_yoy",
    """
    WITH monthly AS (SELECT city, year, month, count(*) AS n_reviews FROM r_lines WHERE year >= 1996 GROUP BY ALL),
    lagged AS (SELECT *, lag(n_reviews) OVER (PARTITION BY city, month ORDER BY year) AS prev_year_reviews FROM monthly)
    SELECT *, round(CASE WHEN prev_year_reviews > 0 THEN
           (n_reviews - prev_year_reviews) / CAST(prev_year_reviews AS DOUBLE) END, 6) AS yoy_growth FROM lagged""",
    roles="r_lines",
)
def _(t):
    return rounded(trends.yoy_monthly(roles.city_reviews(t), since=1996))


@entry(
    "q10_thresholds",
    """
    SELECT city, room_type, count(id) AS n_listings, quantile_disc(price, 0.5) AS median_price,
           max(price) AS max_price,
           count(*) FILTER (price > 100000) AS n_above_100000, count(*) FILTER (price > 250000) AS n_above_250000,
           count(*) FILTER (price > 400000) AS n_above_400000,
           round(count(*) FILTER (price > 100000) / CAST(count(id) AS DOUBLE), 6) AS pct_above_100000,
           round(count(*) FILTER (price > 250000) / CAST(count(id) AS DOUBLE), 6) AS pct_above_250000,
           round(count(*) FILTER (price > 400000) / CAST(count(id) AS DOUBLE), 6) AS pct_above_400000
    FROM r_listings GROUP BY city, room_type""",
    roles="r_listings",
)
def _(t):
    return rounded(distributions.thresholds_wide(roles.listings(t), thresholds=roles.PRICE_LIMITS))


@entry(
    "q11_municipality",
    f"""
    WITH known AS (SELECT city, neighbourhood_group, count(DISTINCT neighbourhood) AS n_neighbourhoods
                   FROM r_neighbourhoods GROUP BY ALL),
    stats AS (SELECT city, neighbourhood_group, {GROUP_MEASURES},
                     round({sql_avg("minimum_nights")}, 6) AS avg_minimum_nights
              FROM r_listings GROUP BY ALL)
    SELECT stats.*, n_neighbourhoods,
           round(n_listings / CAST(n_neighbourhoods AS DOUBLE), 6) AS listings_per_neighbourhood
    FROM stats LEFT JOIN known USING (city, neighbourhood_group)""",
    roles="r_listings r_neighbourhoods",
)
def _(t):
    return rounded(
        profiling.compare_areas(
            roles.listings(t, activity=True),
            roles.neighbourhoods(t),
            extra_means={"avg_minimum_nights": "minimum_nights"},
        )
    )


@entry(
    "w1_seasonality",
    f"SELECT city, year, month, availability_rate, n_calendar_days FROM ({SEASON})",
    roles="r_calendar r_listings",
)
def _(t):
    return rounded(occupancy.seasonality(roles.calendar(t), roles.listings(t), price=None))


@entry(
    "w2_train_rf",
    "SELECT count(*) AS n_rows, true AS sound FROM r_listings WHERE price BETWEEN 10 AND 450000",
    roles="r_listings",
)
def _(t):
    rows = roles.listings(t, hosts_counted=True, activity=True, places=True)
    trained = models.train_forest_benchmark(
        rows,
        numbers=[
            "host_listings",
            "availability_365",
            "minimum_nights",
            "number_of_reviews",
            "number_of_reviews_ltm",
            "reviews_per_month",
            "latitude",
            "longitude",
        ],
        high=450000,
    )
    return trained.select("n_rows", F.expr("rmse > 0 AND r2 <= 1 AND NOT isnan(rmse)").alias("sound"))


@entry(
    "w3_review_demand",
    f"""
    SELECT city, year, month, room_type,
           CASE WHEN price < 100000 THEN 'low' WHEN price < 250000 THEN 'mid' WHEN price < 400000 THEN 'upper'
                ELSE 'top' END AS price_range,
           count(*) AS n_reviews, count(DISTINCT listing_id) AS n_unique_listings,
           round({sql_avg("price")}, 6) AS avg_price
    FROM r_reviews JOIN r_listings ON listing_id = id GROUP BY ALL""",
    roles="r_reviews r_listings",
)
def _(t):
    return rounded(
        occupancy.review_demand(
            roles.reviews(t), roles.listings(t), limits=roles.BAND_LIMITS, top=roles.BAND_TOP
        )
    )


@entry(
    "w4_calendar_revenue",
    f"""
    WITH days AS (SELECT *, CASE WHEN NOT available THEN price ELSE 0 END AS earned
                  FROM r_calendar JOIN r_listings ON listing_id = id),
    areas AS (
      SELECT city, neighbourhood, year, month, {sql_sum("earned")} AS total_revenue,
             round({sql_avg("earned")}, 6) AS avg_daily_revenue, count(*) AS n_days,
             CAST(sum(CASE WHEN NOT available THEN 1 WHEN available THEN 0 END) AS BIGINT) AS booked_days,
             CAST(sum(CASE WHEN available THEN 1 WHEN NOT available THEN 0 END) AS BIGINT) AS available_days,
             count(DISTINCT listing_id) AS n_listings
      FROM days GROUP BY ALL)
    SELECT *, round(booked_days / CAST(booked_days + available_days AS DOUBLE), 6) AS occupancy_rate,
           CAST(row_number() OVER (PARTITION BY city, year, month ORDER BY total_revenue DESC, neighbourhood)
                AS INTEGER) AS revenue_rank
    FROM areas""",
    roles="r_calendar r_listings",
)
def _(t):
    return rounded(occupancy.area_revenue(roles.calendar(t), roles.listings(t)))


@entry(
    "w5_full_pipeline",
    f"""
    WITH occupied AS (
      SELECT listing_id, year, month, sum(CASE WHEN NOT available THEN 1 WHEN available THEN 0 END) AS booked,
             count(*) AS days FROM r_calendar GROUP BY ALL),
    reviewed AS (SELECT listing_id, year, month, count(*) AS n FROM r_reviews GROUP BY ALL)
    SELECT city, room_type, o.year, o.month,
           round({sql_avg("booked / CAST(days AS DOUBLE)")}, 6) AS avg_occupancy,
           round({sql_avg("price")}, 6) AS avg_price, CAST(sum(coalesce(n, 0)) AS BIGINT) AS total_reviews,
           count(DISTINCT o.listing_id) AS n_listings,
           round(sum(booked) / CAST(count(booked) AS DOUBLE), 6) AS avg_booked_days
    FROM occupied o JOIN r_listings ON o.listing_id = id
    LEFT JOIN reviewed r ON r.listing_id = o.listing_id AND r.year = o.year AND r.month = o.month
    GROUP BY ALL""",
    roles="r_calendar r_listings r_reviews",
)
def _(t):
    return rounded(occupancy.market_months(roles.calendar(t), roles.listings(t), roles.reviews(t)))


@entry(
    "top_decile_share",
    """
    WITH per_host AS (SELECT city, host_id, count(id) AS n FROM r_listings GROUP BY city, host_id),
    sized AS (SELECT *, row_number() OVER (PARTITION BY city ORDER BY n DESC, host_id) AS rn,
                     count(*) OVER (PARTITION BY city) AS hosts FROM per_host)
    SELECT city, hosts AS total_hosts, CAST(greatest(1, ceil(hosts * 0.1)) AS BIGINT) AS top_hosts,
           CAST(sum(n) FILTER (rn <= greatest(1, ceil(hosts * 0.1))) AS BIGINT) AS listings_by_top,
           CAST(round(CAST(100.0 * sum(n) FILTER (rn <= greatest(1, ceil(hosts * 0.1))) / sum(n) AS DECIMAL(30,9)), 1) AS DOUBLE) AS pct_of_total_listings
    FROM sized GROUP BY city, hosts""",
    roles="r_listings",
)
def _(t):
    return concentration.top_share_by_head(roles.listings(t))


@entry(
    "yoy_yearly",
    """
    WITH yearly AS (SELECT city, year, count(*) AS n_reviews FROM r_lines WHERE year >= 1996 GROUP BY ALL),
    lagged AS (SELECT *, lag(n_reviews) OVER (PARTITION BY city ORDER BY year) AS p FROM yearly)
    SELECT city, year, n_reviews, CAST(round(CAST(CASE WHEN p > 0 THEN 100.0 * (n_reviews - p) / p ELSE 0 END AS DECIMAL(30,9)), 1) AS DOUBLE) AS yoy_growth_pct
    FROM lagged WHERE p IS NOT NULL""",
    roles="r_lines",
)
def _(t):
    return trends.yoy_yearly(roles.city_reviews(t), since=1996)


@entry(
    "yoy_pivot",
    """
    WITH yearly AS (SELECT city, year, count(*) AS n_reviews FROM r_lines WHERE year >= 1996 GROUP BY ALL),
    lagged AS (SELECT *, lag(n_reviews) OVER (PARTITION BY city ORDER BY year) AS p FROM yearly),
    growth AS (SELECT city, year, CAST(round(CAST(CASE WHEN p > 0 THEN 100.0 * (n_reviews - p) / p ELSE 0 END AS DECIMAL(30,9)), 1) AS DOUBLE) AS g
               FROM lagged WHERE p IS NOT NULL)
    SELECT year, max(g) FILTER (city = 'AFRICA') AS "AFRICA", max(g) FILTER (city = 'AMERICA') AS "AMERICA",
           max(g) FILTER (city = 'ASIA') AS "ASIA", max(g) FILTER (city = 'EUROPE') AS "EUROPE",
           max(g) FILTER (city = 'MIDDLE EAST') AS "MIDDLE EAST"
    FROM growth GROUP BY year""",
    roles="r_lines",
)
def _(t):
    return trends.yoy_pivot(roles.city_reviews(t), roles.CITIES, since=1996)


@entry(
    "per_entity_monthly",
    """
    WITH monthly AS (SELECT city, CAST(date_trunc('month', date) AS DATE) AS month, count(*) AS review_count
                     FROM r_lines GROUP BY ALL),
    totals AS (SELECT city, count(DISTINCT l_partkey) AS total_listings FROM r_lines GROUP BY city)
    SELECT city, month, review_count, total_listings,
           round(review_count / CAST(total_listings AS DOUBLE), 6) AS reviews_per_listing
    FROM monthly LEFT JOIN totals USING (city)""",
    roles="r_lines",
)
def _(t):
    rows = roles.city_reviews(t)
    return rounded(trends.per_entity_monthly(rows, rows, entity="listing_id"))


RATES = """
    rates AS (SELECT city, year, month,
                     1 - count(*) FILTER (available) / CAST(count(available) AS DOUBLE) AS rate
              FROM r_lines GROUP BY ALL)"""


def _rates(t):
    monthly = occupancy.monthly_rate(roles.city_calendar(t), unknown="ignore")
    return monthly.withColumn("occupancy_rate", F.lit(1.0) - F.col("availability_rate"))


@entry(
    "series_extremes",
    f"""
    WITH {RATES},
    ranked AS (SELECT *, row_number() OVER (PARTITION BY city ORDER BY rate, year, month) AS lo,
                      row_number() OVER (PARTITION BY city ORDER BY rate DESC, year, month) AS hi FROM rates)
    SELECT city, max(year) FILTER (lo = 1) AS min_year, max(month) FILTER (lo = 1) AS min_month,
           round(max(rate) FILTER (lo = 1), 6) AS min_value, max(year) FILTER (hi = 1) AS max_year,
           max(month) FILTER (hi = 1) AS max_month, round(max(rate) FILTER (hi = 1), 6) AS max_value
    FROM ranked GROUP BY city""",
    roles="r_lines",
)
def _(t):
    return rounded(trends.series_extremes(_rates(t), value="occupancy_rate"))


@entry(
    "peak_trough",
    f"""
    WITH {RATES},
    ranked AS (SELECT *, row_number() OVER (PARTITION BY city ORDER BY rate, year, month) AS lo,
                      row_number() OVER (PARTITION BY city ORDER BY rate DESC, year, month) AS hi FROM rates)
    SELECT city, max(month) FILTER (hi = 1) AS peak_month, round(max(rate) FILTER (hi = 1), 6) AS peak_value,
           max(month) FILTER (lo = 1) AS trough_month, round(max(rate) FILTER (lo = 1), 6) AS trough_value
    FROM ranked GROUP BY city""",
    roles="r_lines",
)
def _(t):
    return rounded(trends.peak_trough(_rates(t)))


MEANS = f"{RATES}, means AS (SELECT city, month, {sql_avg('rate')} AS v FROM rates GROUP BY city, month)"


@entry(
    "city_month_matrix",
    f"""
    WITH {MEANS}
    SELECT CAST(m AS INTEGER) AS month, round(max(v) FILTER (city = 'AFRICA'), 6) AS "AFRICA",
           round(max(v) FILTER (city = 'AMERICA'), 6) AS "AMERICA", round(max(v) FILTER (city = 'ASIA'), 6) AS "ASIA",
           round(max(v) FILTER (city = 'EUROPE'), 6) AS "EUROPE",
           round(max(v) FILTER (city = 'MIDDLE EAST'), 6) AS "MIDDLE EAST"
    FROM range(1, 13) months(m) LEFT JOIN means ON month = m GROUP BY m""",
    roles="r_lines",
)
def _(t):
    return rounded(trends.city_month_matrix(_rates(t), roles.CITIES))


@entry(
    "season_lift",
    f"""
    WITH {MEANS},
    stats AS (SELECT city, {sql_avg("v")} AS annual,
                     {sql_avg("CASE WHEN month IN (6, 7, 8) THEN v END")} AS season FROM means GROUP BY city),
    peaks AS (SELECT *, row_number() OVER (PARTITION BY city ORDER BY v DESC, month) AS rn FROM means)
    SELECT city, CAST(round(CAST(annual AS DECIMAL(30,9)), 3) AS DOUBLE) AS annual_mean, CAST(round(CAST(season AS DECIMAL(30,9)), 3) AS DOUBLE) AS season_mean,
           CAST(round(CAST(100 * (season - annual) / annual AS DECIMAL(30,9)), 1) AS DOUBLE) AS lift_pct, month AS peak_month, CAST(round(CAST(v AS DECIMAL(30,9)), 3) AS DOUBLE) AS peak_value
    FROM stats JOIN peaks USING (city) WHERE rn = 1""",
    roles="r_lines",
)
def _(t):
    return trends.season_lift(_rates(t))


LARGE = f"""large AS (SELECT city, year, month, fsum(l_extendedprice) * 1000 AS v FROM r_lines GROUP BY ALL),
    large_means AS (SELECT city, month, {sql_avg("v")} AS v FROM large GROUP BY ALL)"""


def _large(t):
    """Monthly values far above ten million."""
    lines = roles.city_calendar(t).groupBy("city", F.year("date").alias("year"), F.month("date").alias("month"))
    return lines.agg((F.sum("adjusted_price") * 1000).alias("value"))


@entry(
    "city_month_matrix_large",
    f"""
    WITH {LARGE}
    SELECT CAST(m AS INTEGER) AS month, round(max(v) FILTER (city = 'AFRICA'), 0) AS "AFRICA",
           round(max(v) FILTER (city = 'AMERICA'), 0) AS "AMERICA", round(max(v) FILTER (city = 'ASIA'), 0) AS "ASIA",
           round(max(v) FILTER (city = 'EUROPE'), 0) AS "EUROPE", round(max(v) FILTER (city = 'MIDDLE EAST'), 0) AS "MIDDLE EAST"
    FROM range(1, 13) months(m) LEFT JOIN large_means ON month = m GROUP BY m""",
    roles="r_lines",
)
def _(t):
    return rounded(trends.city_month_matrix(_large(t), roles.CITIES, value="value"), 0)


@entry(
    "season_lift_large",
    f"""
    WITH {LARGE},
    stats AS (SELECT city, {sql_avg("v")} AS annual, {sql_avg("CASE WHEN month IN (6, 7, 8) THEN v END")} AS season
              FROM large_means GROUP BY city),
    peaks AS (SELECT *, row_number() OVER (PARTITION BY city ORDER BY v DESC, month) AS rn FROM large_means)
    SELECT city, round(annual, 0) AS annual_mean, round(season, 0) AS season_mean,
           CAST(round(CAST(100 * (season - annual) / annual AS DECIMAL(30,9)), 1) AS DOUBLE) AS lift_pct, month AS peak_month,
           round(v, 0) AS peak_value FROM stats JOIN peaks USING (city) WHERE rn = 1""",
    roles="r_lines",
)
def _(t):
    return trends.season_lift(_large(t), value="value").withColumns(
        {c: F.round(c, 0) for c in ("annual_mean", "season_mean", "peak_value")}
    )


def part_listings(t):
    """Parts as listings, for calendars that carry their own city."""
    return t["part"].select(F.col("p_partkey").alias("id"), F.col("p_brand").alias("room_type"), F.col("p_retailprice").alias("price"))


@entry(
    "w1_city_calendar",
    """
    SELECT city, year, month, round(count(*) FILTER (available) / CAST(count(available) AS DOUBLE), 6) AS availability_rate,
           count(*) AS n_calendar_days
    FROM r_lines JOIN part ON l_partkey = p_partkey GROUP BY city, year, month""",
    roles="r_lines",
)
def _(t):
    return rounded(occupancy.seasonality(roles.city_calendar(t), part_listings(t), price=None))


@entry(
    "w5_city_calendar",
    f"""
    WITH occupied AS (
      SELECT l_partkey AS listing_id, city, year, month, sum(CASE WHEN NOT available THEN 1 WHEN available THEN 0 END) AS booked,
             count(*) AS days FROM r_lines GROUP BY ALL),
    reviewed AS (SELECT l_partkey AS listing_id, year, month, count(*) AS n FROM r_lines GROUP BY ALL)
    SELECT city, p_brand AS room_type, o.year, o.month, round({sql_avg("booked / CAST(days AS DOUBLE)")}, 6) AS avg_occupancy,
           round({sql_avg("p_retailprice")}, 6) AS avg_price, CAST(sum(coalesce(n, 0)) AS BIGINT) AS total_reviews,
           count(DISTINCT o.listing_id) AS n_listings, round(sum(booked) / CAST(count(booked) AS DOUBLE), 6) AS avg_booked_days
    FROM occupied o JOIN part ON o.listing_id = p_partkey
    LEFT JOIN reviewed r ON r.listing_id = o.listing_id AND r.year = o.year AND r.month = o.month GROUP BY ALL""",
    roles="r_lines",
)
def _(t):
    return rounded(occupancy.market_months(roles.city_calendar(t), part_listings(t), roles.city_reviews(t)))
