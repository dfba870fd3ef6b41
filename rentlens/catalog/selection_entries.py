"""Encoding over folds, selection over folds, importance by permutation: each on a model whose fit SQL can state."""

from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.sql import functions as F

from ..ml import features, models, selection
from . import roles
from .model_entries import TRAIN
from .registry import ENTRIES, entry, rounded, sql_avg


def keyed(seed: int, buckets: str) -> str:
    return f"CAST('0x' || substr(md5('{seed}:' || CAST(id AS VARCHAR)), 1, 8) AS BIGINT) % {buckets}"


@entry(
    "out_of_fold_encoding",
    f"""
    WITH {TRAIN}, f AS (SELECT id, neighbourhood, ln(1 + price) AS y, {keyed(17, '5')} AS fold FROM train),
    places AS (SELECT DISTINCT neighbourhood, fold FROM f),
    others AS (SELECT p.neighbourhood, p.fold, {sql_avg("y")} AS m FROM places p
               JOIN f ON f.neighbourhood = p.neighbourhood AND f.fold <> p.fold GROUP BY ALL),
    rest AS (SELECT p.fold, {sql_avg("y")} AS m FROM (SELECT DISTINCT fold FROM f) p JOIN f ON f.fold <> p.fold GROUP BY ALL),
    sizes AS (SELECT neighbourhood, CAST(count(*) AS DOUBLE) AS n FROM f GROUP BY ALL)
    SELECT id, round(coalesce(o.m, r.m), 6) AS neighbourhood_mean_log_price, n AS neighbourhood_listing_count
    FROM f JOIN sizes USING (neighbourhood) JOIN rest r ON r.fold = f.fold
    LEFT JOIN others o ON o.neighbourhood = f.neighbourhood AND o.fold = f.fold""",
    roles="r_listings",
)
def _(t):
    train, _ = features.split(roles.listings(t))
    encoded = features.FoldEncoding().apply(train)
    return rounded(encoded.select("id", "neighbourhood_mean_log_price", "neighbourhood_listing_count"))


# Sum of discounts by number of lines: one feature, so the fits are lines.
ACTIVE = "active AS (SELECT id, CAST(number_of_reviews AS DOUBLE) AS x, reviews_per_month AS y FROM r_listings WHERE number_of_reviews IS NOT NULL)"


def active(t):
    rows = roles.listings(t, activity=True).where("number_of_reviews is not null")
    return rows.select(
        "id",
        F.col("number_of_reviews").cast("double").alias("x"),
        F.col("availability_365").cast("double").alias("unused"),
        F.col("reviews_per_month").alias("label"),
    )


@entry(
    "fold_sizes",
    f"""
    WITH {ACTIVE}, f AS (SELECT CAST({keyed(17, '3')} AS INTEGER) AS fold FROM active)
    SELECT fold, (SELECT count(*) FROM f) - count(*) AS n_fit, count(*) AS n_held FROM f GROUP BY fold""",
    roles="r_listings",
)
def _(t):
    return selection.fold_sizes(active(t))


@entry(
    "selection_over_folds",
    f"""
    WITH {ACTIVE}, f AS (SELECT *, {keyed(17, '3')} AS fold FROM active),
    folds AS (SELECT DISTINCT fold FROM f), grid AS (SELECT unnest([0, 1, 2]) AS candidate, unnest([0.0, 0.05, 1.0])::DOUBLE AS reg),
    lines AS (SELECT h.fold, candidate, regr_slope(y, x) / (1 + any_value(reg) / stddev_pop(y)) AS b, avg(y) AS my, avg(x) AS mx
              FROM folds h JOIN f ON f.fold <> h.fold CROSS JOIN grid GROUP BY ALL),
    errors AS (SELECT l.fold, candidate, sqrt(avg((y - my - b * (x - mx)) * (y - my - b * (x - mx)))) AS e
               FROM lines l JOIN f ON f.fold = l.fold GROUP BY ALL),
    means AS (SELECT candidate, avg(e) AS m, stddev_pop(e) AS s FROM errors GROUP BY ALL)
    SELECT CAST(candidate AS INTEGER) AS candidate, round(m, 6) AS mean_metric, round(s, 6) AS std_metric,
           m = (SELECT min(m) FROM means) AS chosen FROM means""",
    roles="r_listings",
)
def _(t):
    """Penalties of a line. With unit deviations a penalty divides the slope by one and itself over the label's deviation."""
    line = models._estimator(models.PRICE_MODELS, "lr", {"solver": "normal"})
    grid = [{"regParam": reg} for reg in (0.0, 0.05, 1.0)]
    found = selection.select_over_folds(active(t), features.feature_stages([], ["x"]) + [line], grid, RegressionEvaluator())
    return rounded(found.table.drop("parameters"))


@entry(
    "permutation_importance",
    f"""
    WITH {ACTIVE}, n AS (SELECT CAST(greatest(ceil(count(*) / 10000.0), 1) AS BIGINT) AS n_groups FROM active),
    line AS (SELECT regr_slope(y, x) AS b, regr_intercept(y, x) AS a FROM active),
    dealt AS (SELECT *, md5('9:' || CAST(id AS VARCHAR)) AS digest, {keyed(9, 'n_groups')} AS g FROM active, n),
    moved AS (SELECT *, coalesce(lead(x) OVER w, first(x) OVER (PARTITION BY g ORDER BY digest, id ROWS UNBOUNDED PRECEDING)) AS other
              FROM dealt WINDOW w AS (PARTITION BY g ORDER BY digest, id)),
    losses AS (SELECT avg((y - a - b * x) * (y - a - b * x)) AS loss, avg((y - a - b * other) * (y - a - b * other)) AS lost FROM moved, line)
    SELECT 'x' AS feature, round(loss, 6) AS loss, round(lost, 6) AS permuted_loss, round(lost - loss, 6) AS importance FROM losses
    UNION ALL SELECT 'unused', round(loss, 6), round(loss, 6), 0.0::DOUBLE FROM losses""",
    roles="r_listings",
)
def _(t):
    rows = active(t)
    line = models._estimator(models.PRICE_MODELS, "lr", {"regParam": 0.0, "solver": "normal"})
    fitted = models.fit(rows, line, ["x"], [])
    return rounded(selection.permutation_importance(fitted, rows, ["x", "unused"]))


__all__ = ["ENTRIES"]
