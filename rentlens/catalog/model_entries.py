"""Features, models, evaluation, scoring and run logs."""

from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import labels, numeric
from ..ml import evaluation, features, models
from ..plans import scaling
from ..sources import run_logs, scratch
from . import roles
from .registry import entry, rounded, sql_avg

BUCKET = "CAST('0x' || substr(md5('42:' || CAST(id AS VARCHAR)), 1, 8) AS BIGINT) % 100"
TRAIN = f"train AS (SELECT * FROM r_listings WHERE {BUCKET} < 80)"


def rental_listings(t):
    """Listings with every column that the roles can fill for the models."""
    return roles.listings(t, hosts_counted=True, activity=True, places=True).withColumnRenamed(
        "host_listings", "calculated_host_listings_count"
    )


@entry("hash_split", f"SELECT id, {BUCKET} < 80 AS in_train FROM r_listings", roles="r_listings")
def _(t):
    train, test = features.split(roles.listings(t).select("id"))
    return train.withColumn("in_train", F.lit(True)).unionByName(test.withColumn("in_train", F.lit(False)))


ENCODING = f"""
    groups AS (SELECT neighbourhood, {sql_avg("ln(1 + price)")} AS m, count(id) AS n FROM train
               GROUP BY ALL),
    defaults AS (SELECT {sql_avg("ln(1 + price)")} AS m,
                        count(*) / CAST(count(DISTINCT neighbourhood) AS DOUBLE) AS n FROM train)"""


def _encoding(t):
    train, _ = features.split(roles.listings(t))
    return features.fit_target_encoding(train)


@entry(
    "target_encoding",
    f"""
    WITH {TRAIN}, {ENCODING}
    SELECT neighbourhood, round(m, 6) AS neighbourhood_mean_log_price, n AS neighbourhood_listing_count FROM groups""",
    roles="r_listings",
)
def _(t):
    groups = _encoding(t).groups
    return rounded(groups.select("neighbourhood", "neighbourhood_mean_log_price", "neighbourhood_listing_count"))


@entry(
    "apply_encoding",
    f"""
    WITH {TRAIN}, {ENCODING}
    SELECT id, round(coalesce(g.m, d.m), 6) AS neighbourhood_mean_log_price,
           round(coalesce(CAST(g.n AS DOUBLE), d.n), 6) AS neighbourhood_listing_count
    FROM r_listings LEFT JOIN groups g USING (neighbourhood), defaults d""",
    roles="r_listings",
)
def _(t):
    rows = _encoding(t).apply(roles.listings(t))
    return rounded(rows.select("id", "neighbourhood_mean_log_price", "neighbourhood_listing_count"))


@entry(
    "encoding_sidecar_roundtrip",
    f"""
    WITH {TRAIN}, {ENCODING}
    SELECT neighbourhood, round(groups.m, 6) AS group_mean, groups.n AS group_count, round(defaults.m, 6) AS mean_log,
           round(defaults.n, 6) AS mean_count FROM groups, defaults""",
    roles="r_listings",
)
def _(t):
    path = scratch.new_folder(t.spark, "encoding")
    _encoding(t).save(path)
    stored = features.TargetEncoding.load(t.spark, path)
    default = stored.defaults.select(F.struct("mean_log", "mean_count")).scalar()
    return rounded(
        stored.groups.select(
            "neighbourhood",
            F.col("neighbourhood_mean_log_price").alias("group_mean"),
            F.col("neighbourhood_listing_count").alias("group_count"),
            default["mean_log"].alias("mean_log"),
            default["mean_count"].alias("mean_count"),
        )
    )


@entry(
    "activity_ratio",
    """
    SELECT id, round(number_of_reviews_ltm / (number_of_reviews + 1.0::DOUBLE), 6) AS recent_activity_ratio
    FROM r_listings""",
    roles="r_listings",
)
def _(t):
    rows = roles.listings(t, activity=True)
    return rounded(rows.select("id", features.activity_ratio().alias("recent_activity_ratio")))


@entry(
    "nights_bucket",
    """
    SELECT p_partkey, CASE WHEN p_size = 2 THEN 'one_night' WHEN p_size IN (4, 5, 6) THEN 'weekend'
                           WHEN p_size BETWEEN 8 AND 12 THEN 'week_short' ELSE 'long_stay' END AS min_nights_cat
    FROM part""",
)
def _(t):
    nights = F.when(F.col("p_size") > 1, F.col("p_size") / 2.0)
    return t["part"].select("p_partkey", labels.nights_bucket(nights).alias("min_nights_cat"))


BUCKETS = """CASE WHEN minimum_nights = 1 THEN 'one_night' WHEN minimum_nights IN (2, 3) THEN 'weekend'
                  WHEN minimum_nights IN (4, 5, 6) THEN 'week_short' ELSE 'long_stay' END"""


@entry(
    "engineer_features",
    f"""
    WITH {TRAIN}, {ENCODING}
    SELECT id, round(1 - availability_365 / 365.0, 6) AS occupancy_rate,
           round(ln(1 + number_of_reviews), 6) AS log_reviews, round(ln(1 + host_listings), 6) AS log_host_listings,
           round(number_of_reviews_ltm / (number_of_reviews + 1.0::DOUBLE), 6) AS recent_activity_ratio,
           {BUCKETS} AS min_nights_cat, round(coalesce(g.m, d.m), 6) AS neighbourhood_mean_log_price,
           round(coalesce(CAST(g.n AS DOUBLE), d.n), 6) AS neighbourhood_listing_count
    FROM r_listings LEFT JOIN groups g USING (neighbourhood), defaults d""",
    roles="r_listings",
)
def _(t):
    rows = features.engineer(rental_listings(t), _encoding(t))
    names = [*features.DERIVED_NUMERIC, "min_nights_cat"]
    return rounded(rows.select("id", *names))


@entry(
    "select_and_fill",
    f"""
    SELECT id, price, coalesce(minimum_nights, 1) AS minimum_nights,
           coalesce(number_of_reviews, 0) AS number_of_reviews, coalesce(number_of_reviews_ltm, 0) AS number_of_reviews_ltm,
           coalesce(reviews_per_month, 0) AS reviews_per_month, host_listings AS calculated_host_listings_count,
           round(latitude, 6)::DOUBLE AS latitude, round(longitude, 6)::DOUBLE AS longitude, city, room_type,
           CASE WHEN city = 'ASIA' THEN 'unknown' ELSE neighbourhood_group END AS neighbourhood_group,
           CASE WHEN host_listings > 10 THEN 'true' ELSE 'false' END AS host_is_superhost
    FROM r_listings""",
    roles="r_listings",
)
def _(t):
    named = F.when(F.col("city") != "ASIA", F.col("neighbourhood_group"))
    rows = rental_listings(t).withColumns(
        {"neighbourhood_group": named, "host_is_superhost": F.col("calculated_host_listings_count") > 10}
    )
    return rounded(features.select_and_fill(rows, features.AVAILABILITY_LEAKS))


INDEXED = """
    brands AS (SELECT p_partkey, CASE WHEN p_size > 1 THEN p_brand END AS brand FROM part),
    ranks AS (SELECT brand, row_number() OVER (ORDER BY count(*) DESC, brand) - 1 AS idx FROM brands
              WHERE brand IS NOT NULL GROUP BY brand),
    placed AS (SELECT p_partkey, coalesce(idx, (SELECT count(*) FROM ranks)) AS idx FROM brands LEFT JOIN ranks USING (brand))"""


def _brands(t):
    return t["part"].select("p_partkey", F.when(F.col("p_size") > 1, F.col("p_brand")).alias("brand"))


@entry("string_index", f"WITH {INDEXED} SELECT p_partkey, CAST(idx AS DOUBLE) AS brand_idx FROM placed")
def _(t):
    rows = _brands(t)
    indexer = features.feature_stages(["brand"], [], scaled=False)[0]
    return indexer.fit(rows).transform(rows).select("p_partkey", "brand_idx")


@entry(
    "one_hot",
    f"WITH {INDEXED} SELECT p_partkey, CAST(idx AS INTEGER) AS slot, 1.0::DOUBLE AS value FROM placed",
)
def _(t):
    rows = _brands(t)
    encoder = Pipeline(stages=features.feature_stages(["brand"], [], scaled=False)[:2])
    encoded = encoder.fit(rows).transform(rows)
    slots = encoded.select("p_partkey", F.posexplode(vector_to_array("brand_oh")).alias("slot", "value"))
    return slots.where("value <> 0")


@entry(
    "assemble",
    """
    SELECT p_partkey, 0::INTEGER AS slot, CAST(CASE WHEN p_size > 1 THEN p_size END AS DOUBLE) AS value FROM part
    UNION ALL SELECT p_partkey, 1, p_retailprice FROM part""",
)
def _(t):
    rows = t["part"].select("p_partkey", F.when(F.col("p_size") > 1, F.col("p_size")).alias("p_size"), "p_retailprice")
    assembler = features.feature_stages([], ["p_size", "p_retailprice"], scaled=False)[0]
    cells = assembler.transform(rows).select(
        "p_partkey", F.posexplode(vector_to_array("features")).alias("slot", "value")
    )
    return cells.withColumn("value", F.when(~F.isnan("value"), F.col("value")))


@entry(
    "standard_scale",
    """
    SELECT p_partkey, round(p_size / (SELECT stddev_samp(p_size) FROM part), 6) AS size,
           round(p_retailprice / (SELECT stddev_samp(p_retailprice) FROM part), 6) AS retail FROM part""",
)
def _(t):
    rows = t["part"].select("p_partkey", "p_size", "p_retailprice")
    scaled = features.fit_features(rows, [], ["p_size", "p_retailprice"]).transform(rows)
    values = vector_to_array("features")
    return rounded(scaled.select("p_partkey", values[0].alias("size"), values[1].alias("retail")))


@entry(
    "cyclic_month",
    """
    SELECT o_orderkey, round(sin(2 * pi() * month(o_orderdate) / 12), 6) + 0.0 AS sin_month,
           round(cos(2 * pi() * month(o_orderdate) / 12), 6) + 0.0 AS cos_month FROM orders""",
)
def _(t):
    sine, cosine = numeric.cyclic(F.month("o_orderdate"))
    # Adding zero turns a rounded negative zero into zero.
    return t["orders"].select(
        "o_orderkey",
        (F.round(sine, 6) + F.lit(0.0)).alias("sin_month"),
        (F.round(cosine, 6) + F.lit(0.0)).alias("cos_month"),
    )


@entry(
    "monthly_dataset",
    """
    WITH months AS (
      SELECT user_id AS listing_id, CAST(year(ts) AS INTEGER) AS year, month(ts) AS month, count(*) AS n_days,
             count(*) FILTER (event_type = 'purchase') / CAST(count(event_type) AS DOUBLE) AS rate
      FROM events GROUP BY ALL HAVING count(*) >= 20)
    SELECT listing_id, c_custkey AS id, c_mktsegment AS segment, year, CAST(month AS DOUBLE) AS month, n_days,
           round(rate, 6) AS monthly_occupancy_rate, round(sin(2 * pi() * month / 12), 6) AS sin_month,
           round(cos(2 * pi() * month / 12), 6) AS cos_month,
           CASE WHEN rate > 0.2 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS is_high_demand_month
    FROM months JOIN customer ON c_custkey = listing_id""",
)
def _(t):
    days = t["events"].select(
        F.col("user_id").alias("listing_id"),
        F.col("ts").cast("date").alias("date"),
        (F.col("event_type") != "purchase").alias("available"),
    )
    people = t["customer"].select(F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("segment"))
    return rounded(features.monthly_demand(days, people, busy_above=0.2))


@entry(
    "price_cap",
    """
    SELECT o_orderkey, o_totalprice FROM orders
    WHERE o_totalprice BETWEEN 10 AND (SELECT quantile_disc(o_totalprice, 0.99) FROM orders)""",
)
def _(t):
    return features.within_cap(t["orders"].select("o_orderkey", "o_totalprice"), "o_totalprice")


def labelled_documents(t):
    return t["labels"].join(t["documents"], "doc_id").select("doc_id", "quality", "toxic", "n_chars", "lang", "source")


@entry(
    "class_weights",
    """
    WITH base AS (SELECT avg(CAST(quality AS DOUBLE)) AS p FROM labels JOIN documents USING (doc_id))
    SELECT doc_id, CAST(quality AS INTEGER) AS label,
           round(CASE WHEN p BETWEEN 0.35 AND 0.65 THEN 1 WHEN quality = 1 THEN 1 / p ELSE 1 / (1 - p) END, 6) AS weight
    FROM labels JOIN documents USING (doc_id), base""",
)
def _(t):
    rows = labelled_documents(t).select("doc_id", F.col("quality").cast("int").alias("label"))
    return rounded(features.class_weights(rows))


@entry(
    "regression_metrics",
    """
    WITH scored AS (SELECT l_extendedprice AS y, l_quantity * 2000 AS p FROM lineitem),
    mean AS (SELECT avg(y) AS m FROM scored)
    SELECT round(sqrt(avg((y - p) * (y - p))), 6) AS rmse, round(avg(abs(y - p)), 6) AS mae,
           round(1 - sum((y - p) * (y - p)) / sum((y - m) * (y - m)), 6) AS r2 FROM scored, mean""",
)
def _(t):
    scored = t["lineitem"].withColumn("prediction", F.col("l_quantity") * 2000)
    return rounded(evaluation.regression_metrics(scored, "l_extendedprice"))


@entry(
    "classification_metrics",
    """
    WITH scored AS (SELECT quality = 1 AS y, n_chars > 300 AS p FROM labels JOIN documents USING (doc_id)),
    c AS (SELECT count(*)::DOUBLE AS n, count(*) FILTER (y AND p) AS tp, count(*) FILTER (NOT y AND p) AS fp,
                 count(*) FILTER (y AND NOT p) AS fn, count(*) FILTER (NOT y AND NOT p) AS tn FROM scored)
    SELECT round(((tp + fn) * 2.0 * tp / (2 * tp + fp + fn) + (tn + fp) * 2.0 * tn / (2 * tn + fp + fn)) / n, 6)::DOUBLE AS f1,
           round((tp + tn) / n, 6) AS accuracy, round((tp + fn) / n, 6) AS base_rate FROM c""",
)
def _(t):
    scored = labelled_documents(t).select(
        F.col("quality").alias("label"), (F.col("n_chars") > 300).cast("double").alias("prediction")
    )
    return rounded(evaluation.classification_metrics(scored))


CAPPED = f"""capped AS (SELECT *, {BUCKET} < 80 AS in_train FROM r_listings
              WHERE price BETWEEN 10 AND (SELECT quantile_disc(price, 0.99) FROM r_listings))"""
PRICED = """SELECT '{}' AS algo, count(*) FILTER (in_train) AS n_train, count(*) FILTER (NOT in_train) AS n_test,
                   round((SELECT quantile_disc(price, 0.99) FROM r_listings), 6) AS price_cap, true AS sound FROM capped"""
TESTED = """SELECT '{}' AS algo, count(*) FILTER (in_train) AS n_train, count(*) FILTER (NOT in_train) AS n_test,
                   round(avg(CASE WHEN busy THEN 1.0 ELSE 0.0 END) FILTER (NOT in_train), 6) AS base_rate, true AS sound"""


def settled_price(metrics):
    """What is certain of a price model: sizes, cap, and errors that agree with each other."""
    sound = " AND ".join(
        f"rmse_{s} >= mae_{s} AND mae_{s} > 0 AND r2_{s} <= 1 AND NOT isnan(rmse_{s})" for s in ("log", "price")
    )
    return rounded(metrics.select("algo", "n_train", "n_test", "price_cap", F.expr(sound).alias("sound")))


def settled_demand(metrics):
    sound = "f1 BETWEEN 0 AND 1 AND accuracy BETWEEN 0 AND 1 AND auc BETWEEN 0 AND 1"
    return rounded(metrics.select("algo", "n_train", "n_test", "base_rate", F.expr(sound).alias("sound")))


@entry("price_lr", f"WITH {CAPPED} {PRICED.format('lr')}", roles="r_listings")
def _(t):
    return settled_price(models.train_price(rental_listings(t), "lr").metrics)


@entry("price_rf", f"WITH {CAPPED} {PRICED.format('rf')}", roles="r_listings")
def _(t):
    return settled_price(models.train_price(rental_listings(t), "rf").metrics)


@entry("price_gbt", f"WITH {CAPPED} {PRICED.format('gbt')}", roles="r_listings")
def _(t):
    return settled_price(models.train_price(rental_listings(t), "gbt").metrics)


@entry(
    "price_line",
    """
    SELECT round(regr_slope(o_totalprice, o_custkey), 6) AS slope, round(regr_intercept(o_totalprice, o_custkey), 2) AS base
    FROM orders""",
)
def _(t):
    """One feature without penalty is the least-squares line; the slope is brought back to the feature's own scale."""
    rows = t["orders"].select("o_orderkey", F.col("o_custkey").cast("double").alias("x"), F.col("o_totalprice").alias("label"))
    line = models._estimator(models.PRICE_MODELS, "lr", {"regParam": 0.0, "solver": "normal"})
    fitted = models.fit(rows, line, ["x"], [], "o_orderkey")
    at = t.spark.range(2).select(F.col("id").cast("double").alias("x"))
    ends = fitted.transform(at).agg(
        F.max(F.when(F.col("x") == 1, F.col("prediction"))).alias("one"), F.max(F.when(F.col("x") == 0, F.col("prediction"))).alias("base")
    )
    return ends.select(F.round(F.col("one") - F.col("base"), 6).alias("slope"), F.round("base", 2).alias("base"))


def occupied_listings(t):
    return rental_listings(t).withColumn(
        "is_high_occupancy", numeric.occupancy("availability_365") > F.lit(0.70)
    )


OCCUPIED = f"""occupied AS (SELECT {BUCKET} < 80 AS in_train, 1 - availability_365 / 365.0::DOUBLE > 0.7 AS busy
                FROM r_listings WHERE availability_365 IS NOT NULL)"""


@entry("occupancy_logreg", f"WITH {OCCUPIED} {TESTED.format('logreg')} FROM occupied", roles="r_listings")
def _(t):
    return settled_demand(models.train_occupancy(occupied_listings(t), "logreg").metrics)


@entry("occupancy_rf", f"WITH {OCCUPIED} {TESTED.format('rf')} FROM occupied", roles="r_listings")
def _(t):
    return settled_demand(models.train_occupancy(occupied_listings(t), "rf").metrics)


@entry(
    "monthly_occupancy_rf",
    f"""
    WITH months AS (
      SELECT listing_id AS id, year, month, count(*) FILTER (NOT available) / CAST(count(available) AS DOUBLE) > 0.5 AS busy
      FROM r_calendar WHERE date IS NOT NULL GROUP BY ALL HAVING count(available) > 0),
    joined AS (SELECT {BUCKET} < 80 AS in_train, busy FROM months WHERE id IN (SELECT id FROM r_listings))
    {TESTED.format('monthly_rf')} FROM joined""",
    roles="r_listings r_calendar",
)
def _(t):
    """A test listing has a few days a month, so the rule of twenty days is set to one here."""
    months = features.monthly_demand(roles.calendar(t), rental_listings(t), min_days=1, keep=())
    return settled_demand(models.train_monthly_occupancy(months).metrics)


@entry(
    "model_comparison",
    f"WITH {CAPPED} " + " UNION ALL ".join(PRICED.format(a) for a in ("lr", "rf", "gbt")),
    roles="r_listings",
)
def _(t):
    return settled_price(models.compare(models.train_prices(rental_listings(t), ("lr", "rf", "gbt"))))


FEATURES = """SELECT unnest(['minimum_nights', 'number_of_reviews', 'number_of_reviews_ltm', 'reviews_per_month',
    'calculated_host_listings_count', 'availability_365', 'latitude', 'longitude', 'occupancy_rate', 'log_reviews',
    'log_host_listings', 'recent_activity_ratio', 'neighbourhood_listing_count', 'neighbourhood_mean_log_price', 'city',
    'room_type', 'neighbourhood_group', 'min_nights_cat']) AS feature, true AS in_range, 1.0::DOUBLE AS total"""


@entry("feature_importance", FEATURES)
def _(t):
    rows = rental_listings(t)
    trained = models.train_price(rows, "rf")
    found = models.feature_importance(trained.model, features.model_input(rows, trained.encoding))
    total = F.round(F.sum("importance").over(Window.partitionBy(F.lit(0))), 6)
    return found.select("feature", F.col("importance").between(0, 1).alias("in_range"), total.alias("total"))


@entry("batch_score", "SELECT id, true AS priced FROM r_listings", roles="r_listings")
def _(t):
    """Trained, saved, loaded and applied to the whole table: every row is scored once."""
    rows, path = rental_listings(t), scratch.new_folder(t.spark, "price-model")
    trained = models.train_price(rows, "rf")
    trained.save(path)
    trained.discard()
    scored = models.score(rows, *models.load(t.spark, path))
    return scored.select("id", (F.col("predicted_price") > 0).alias("priced"))


@entry(
    "area_under_roc",
    """
    WITH scored AS (SELECT quality AS y, CAST(n_chars AS DOUBLE) AS s FROM labels JOIN documents USING (doc_id)),
    ranked AS (SELECT y, rank() OVER (ORDER BY s) + (count(*) OVER (PARTITION BY s) - 1) / 2.0 AS r FROM scored),
    sums AS (SELECT sum(r) FILTER (y = 1) AS r1, count(*) FILTER (y = 1) AS n1, count(*) FILTER (y = 0) AS n0 FROM ranked)
    SELECT round((r1 - n1 * (n1 + 1) / 2.0) / (CAST(n1 AS DOUBLE) * n0), 6)::DOUBLE AS auc FROM sums""",
)
def _(t):
    scored = labelled_documents(t).select(F.col("quality").cast("double").alias("label"), F.col("n_chars").cast("double").alias("rawPrediction"))
    return t.spark.createDataFrame([(round(evaluation.area_under_roc(scored), 6),)], "auc double")


def write_run_logs(t) -> str:
    """Every line item as one timed run in the log of its workload and size; R has no one-worker log."""
    workers = F.col("l_linenumber") + F.when(F.col("l_returnflag") == "R", 1).otherwise(0)
    block = F.concat(
        F.lit('    {\n      "run": '),
        F.col("l_suppkey").cast("string"),
        F.lit(',\n      "wall_secs": '),
        F.col("l_extendedprice").cast("decimal(18,2)").cast("string"),
        F.lit("\n    },"),
    )
    name = F.concat(F.lit("load_"), "l_returnflag", F.lit("_"), workers.cast("string"), F.lit("w.txt"))
    path = scratch.new_folder(t.spark, "run-logs")
    t["lineitem"].select(block.alias("value"), name.alias("log")).hint("rebalance", "log").write.partitionBy("log").text(path)
    return path


RUNS = """runs AS (
      SELECT 'load_' || l_returnflag AS workload,
             CAST(l_linenumber + CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS INTEGER) AS workers,
             l_extendedprice AS wall_secs FROM lineitem)"""
STATS = f"""{RUNS},
    stats AS (SELECT workload, workers, count(*) AS runs, round(quantile_cont(wall_secs, 0.5), 4) AS median_wall_secs,
                     min(wall_secs) AS min_wall_secs, max(wall_secs) AS max_wall_secs FROM runs GROUP BY ALL)"""


@entry("parse_run_logs", f"WITH {RUNS} SELECT * FROM runs")
def _(t):
    return run_logs.read_run_logs(t.spark, write_run_logs(t))


@entry(
    "scaling_summary",
    f"""
    WITH {STATS}, base AS (SELECT workload, median_wall_secs AS b FROM stats WHERE workers = 1)
    SELECT stats.*, round(b / median_wall_secs, 4) AS speedup, round(b / median_wall_secs / workers, 4) AS efficiency
    FROM stats LEFT JOIN base USING (workload)""",
)
def _(t):
    return scaling.scaling_summary(run_logs.read_run_logs(t.spark, write_run_logs(t)))


@entry(
    "scaling_min_baseline",
    f"""
    WITH {STATS}, base AS (SELECT workload, arg_min(median_wall_secs, workers) AS b FROM stats GROUP BY workload)
    SELECT workload AS platform, workers AS parallelism, runs, median_wall_secs, min_wall_secs, max_wall_secs,
           round(b / median_wall_secs, 4) AS speedup, round(b / median_wall_secs / workers, 4) AS efficiency
    FROM stats JOIN base USING (workload)""",
)
def _(t):
    runs = run_logs.read_run_logs(t.spark, write_run_logs(t))
    return scaling.scaling_from_smallest(runs.withColumnsRenamed({"workload": "platform", "workers": "parallelism"}))


@entry(
    "fastest_config",
    f"""
    WITH {STATS}
    SELECT workload, concat(workers, ' workers') AS best_config, median_wall_secs FROM (
      SELECT *, row_number() OVER (PARTITION BY workload ORDER BY median_wall_secs, workers) AS rn FROM stats) WHERE rn = 1""",
)
def _(t):
    runs = run_logs.read_run_logs(t.spark, write_run_logs(t))
    return scaling.fastest_configuration(scaling.scaling_summary(runs))


@entry(
    "scaling_pivot",
    f"""
    WITH {STATS}
    SELECT workers, max(median_wall_secs) FILTER (workload = 'load_A') AS "load_A",
           max(median_wall_secs) FILTER (workload = 'load_N') AS "load_N",
           max(median_wall_secs) FILTER (workload = 'load_R') AS "load_R" FROM stats GROUP BY workers""",
)
def _(t):
    runs = run_logs.read_run_logs(t.spark, write_run_logs(t))
    return scaling.wide_by_workers(scaling.scaling_summary(runs), ["load_A", "load_N", "load_R"])
