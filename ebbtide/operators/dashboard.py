"""Weekly roll-ups for the dashboard."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def historic_churn(targets: DataFrame) -> DataFrame:
    """Users per week, product and outcome, among active users of the training rows."""
    return targets.where((F.col("fresh") == 0) & (F.col("active_last_week") == 1)).groupBy(
        F.col("target_week_start_date").alias("week"), "target_churn_next_week", "destination"
    ).agg(F.count(F.lit(1)).alias("users"))


def predicted_churn(scores: DataFrame, product: str) -> DataFrame:
    """Expected and classified churners per week and learner."""
    return scores.groupBy(
        F.col("target_week_start_date").alias("week"), F.lit(product).alias("destination"),
        "learner_type", "learner_name").agg(
        F.sum("predicted_probability").alias("predicted_churn_raw"),
        F.sum(F.col("optimal_classification").cast("bigint")).alias("predicted_churn_thresholded"),
        F.count(F.lit(1)).alias("users"))
