"""Model quality as one-row tables, each from a single aggregation."""

from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import numeric


def regression_metrics(
    predicted: DataFrame, label: str = "label", prediction: str = "prediction", suffix: str = ""
) -> DataFrame:
    """RMSE, MAE and R² in one pass."""
    y = F.col(label).cast("double")
    error = y - F.col(prediction).cast("double")
    squared = F.avg(error * error)
    return predicted.agg(
        F.sqrt(squared).alias(f"rmse{suffix}"),
        F.avg(F.abs(error)).alias(f"mae{suffix}"),
        (F.lit(1.0) - F.try_divide(squared, F.var_pop(y))).alias(f"r2{suffix}"),
    )


def classification_metrics(
    predicted: DataFrame, label: str = "label", prediction: str = "prediction"
) -> DataFrame:
    """Class-weighted F1, accuracy and base rate from the confusion counts of a binary label."""
    actual, guess = F.col(label) == 1, F.col(prediction) == 1
    counts = predicted.agg(
        F.count("*").alias("n"),
        F.count_if(actual).alias("positive"),
        F.count_if(guess).alias("guessed"),
        F.count_if(actual & guess).alias("hit"),
        F.count_if(~actual & ~guess).alias("passed"),
    )
    negative, unguessed = F.col("n") - F.col("positive"), F.col("n") - F.col("guessed")

    def f1(hits, size, guesses):
        return F.coalesce(numeric.ratio(2 * hits, size + guesses), F.lit(0.0)) * size

    weighted = f1(F.col("hit"), F.col("positive"), F.col("guessed")) + f1(F.col("passed"), negative, unguessed)
    return counts.select(
        numeric.ratio(weighted, "n").alias("f1"),
        numeric.ratio(F.col("hit") + F.col("passed"), "n").alias("accuracy"),
        numeric.ratio("positive", "n").alias("base_rate"),
    )


def area_under_roc(predicted: DataFrame, label: str = "label") -> float:
    """Over all distinct scores: by default Spark merges them into about a thousand points, by layout."""
    evaluator = BinaryClassificationEvaluator(
        labelCol=label, rawPredictionCol="rawPrediction", metricName="areaUnderROC", numBins=0
    )
    return float(evaluator.evaluate(predicted))
