"""Score records: one row per user and learner, the meta-learner included."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, functions as F

from ebbtide.ml.stack import META, StackModel, _safe, probability

ID = ("user_id", "target_week_start_date")


def score_export(predictions: DataFrame, model: StackModel, product: str, run_at: datetime, *,
                 keys: Sequence[str] = ID) -> DataFrame:
    """Wide predictions to score records, thresholds included; one pass, no join."""
    names = [x.name for x in model.learners]
    parts = []
    for name in [*names, META]:
        meta = name == META
        parts.append(F.struct(
            F.lit("meta-learner" if meta else "weak-learner").alias("learner_type"),
            F.lit(f"{product}-meta" if meta else name).alias("learner_name"),
            F.col(probability(name)).alias("predicted_probability"),
            F.lit(float(model.thresholds[name])).alias("optimal_threshold"),
            F.col(f"class_{_safe(name)}").alias("optimal_classification")))
    return predictions.select(*keys, F.explode(F.array(*parts)).alias("_s")).select(
        *keys, "_s.*", F.lit(run_at).cast("timestamp").alias("score_datetime"))
