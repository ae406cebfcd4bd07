"""Quality measures."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinis.operators.stats import RatingColumns


def rmse(predictions: DataFrame, truth: DataFrame, c: RatingColumns = RatingColumns()) -> DataFrame:
    """One row ``(rows, rmse)`` over the rows of ``truth`` that have a prediction for their user and item."""
    by_pair = predictions.groupBy(*c.pair).agg(F.max("prediction").alias("prediction"))
    both = by_pair.join(truth.select(*c.pair, c.stars), c.pair)
    error = F.pow(F.col("prediction") - F.col(c.stars), F.lit(2.0))
    return both.agg(F.count(F.lit(1)).alias("rows"), F.sqrt(F.avg(error)).alias("rmse"))


def prediction_range(predictions: DataFrame) -> DataFrame:
    """One row ``(lowest, highest)``."""
    return predictions.agg(F.min("prediction").alias("lowest"), F.max("prediction").alias("highest"))


def pair_precision_recall(found: DataFrame, truth: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """One row ``(found, truth, hits, precision, recall)``; pairs are compared as (a, b)."""
    mine = found.select(a, b).distinct().withColumn("mine", F.lit(1))
    right = truth.select(a, b).distinct().withColumn("right", F.lit(1))
    both = mine.join(right, [a, b], "full")
    counts = both.agg(F.count("mine").alias("found"), F.count("right").alias("truth"),
                      F.count(F.when(F.col("mine").isNotNull() & F.col("right").isNotNull(), 1)).alias("hits"))
    return counts.select("*", F.try_divide("hits", "found").alias("precision"),
                         F.try_divide("hits", "truth").alias("recall"))
