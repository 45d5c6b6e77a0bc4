"""Explanations: Shapley values by sampling, linear contributions, summaries.

Attributions are a long table (row, feature, value), with the learner where
several are kept together.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, Window, functions as F

from ebbtide.functions.exprs import quoted
from ebbtide.ml.prepare import feature_of


def shapley_sampled(predict: Callable[[DataFrame], DataFrame], sample: DataFrame,
                    background: DataFrame, features: Sequence[str], *, key: str, vector: str,
                    permutations: int = 10, seed: int = 0, max_background: int = 200
                    ) -> DataFrame:
    """(row, feature): average change of the score as features switch to the row's values.

    For each row and feature order, the features take the row's value one after
    the other, starting from a background row. All of these rows are scored as
    one DataFrame. ``predict`` adds ``p`` to rows that have ``vector``. A feature and its
    indicator of missing values switch together. Every background row starts equally many walks,
    at least one, and at least ``permutations`` walks are made, so the values of a row add up to
    its score minus the mean score of the whole background. More than ``max_background`` rows
    are an error.
    """
    names_ = list(dict.fromkeys(map(feature_of, features)))
    group = np.array([names_.index(feature_of(f)) for f in features])
    n = len(names_)
    base = [[float(v) for v in r] for r in
            background.select(*features).limit(max_background + 1).collect()]
    if not 0 < len(base) <= max_background:
        raise ValueError(f"the background must have 1 to {max_background} rows")
    base.sort()
    walks = len(base) * -(-permutations // len(base))
    rng = np.random.default_rng(seed)
    orders = []
    for m in range(walks):
        order = rng.permutation(n)
        place = np.empty(n, dtype=int)
        place[order] = np.arange(n)
        orders.append((m, order.tolist(), place[group].tolist(), base[m % len(base)]))
    spark = sample.sparkSession
    plans = spark.createDataFrame(
        orders, "m int, feature_order array<int>, place array<int>, start array<double>")
    rows = sample.select(key, F.array(*[F.col(c).cast("double") for c in features]).alias("_x"),
                         F.explode(F.sequence(F.lit(0), F.lit(walks - 1))).alias("m"))
    steps = rows.join(F.broadcast(plans), "m").select(
        "*", F.explode(F.sequence(F.lit(0), F.lit(n))).alias("step"))
    mixed = F.transform(
        F.arrays_zip("_x", "start", "place"),
        lambda z: F.when(z["place"] < F.col("step"), z["_x"]).otherwise(z["start"]))
    scored = predict(steps.select(
        key, "m", "step", "feature_order", array_to_vector(mixed).alias(vector))).select(
        key, "m", "step", "feature_order", "p")
    walk = Window.partitionBy(key, "m").orderBy("step")
    names = F.array(*[F.lit(f) for f in names_])
    change = scored.select(
        key, "step", (F.col("p") - F.lag("p").over(walk)).alias("change"),
        F.get("feature_order", F.col("step") - 1).alias("_f")).where(F.col("step") > 0)
    return change.groupBy(key, F.get(names, F.col("_f")).alias("feature")).agg(
        F.avg("change").alias("value"))


def linear_contributions(df: DataFrame, coefficients: dict[str, float], *, key: str,
                         background: DataFrame | None = None) -> DataFrame:
    """(row, feature): weight times the distance from the mean, over a feature's inputs.

    ``coefficients`` are weights of the inputs as df has them, before any scaling; the mean is
    that of ``background``, or of df itself. The values of a row add up to its log-odds minus those
    of the mean row.
    """
    names = list(coefficients)
    known = df if background is None else background
    means = known.agg(*[F.avg(F.col(c).cast("double")).alias(c) for c in names]).first()
    terms: dict[str, list] = {}
    for c, w in coefficients.items():
        terms.setdefault(feature_of(c), []).append(
            (F.col(c).cast("double") - F.lit(means[c])) * F.lit(w))
    parts = [F.struct(F.lit(f).alias("feature"), sum(t[1:], t[0]).alias("value"))
             for f, t in terms.items()]
    return df.select(key, F.explode(F.array(*parts)).alias("_p")).select(key, "_p.*")


def long_inputs(df: DataFrame, features: Sequence[str], *, key: str) -> DataFrame:
    """(row, feature): input value."""
    parts = ", ".join(f"struct({quoted(c)} AS feature, CAST(`{c}` AS DOUBLE) AS input_value)"
                      for c in features)
    return df.selectExpr(key, f"inline(array({parts}))")


def attribution_table(attributions: DataFrame, inputs: DataFrame, *, key: str) -> DataFrame:
    """(row, feature): input value and attribution side by side."""
    return inputs.join(attributions, [key, "feature"])


def attribution_summary(attributions: DataFrame, groups: Sequence[str] = ("learner",)
                        ) -> DataFrame:
    """(learner, feature): mean absolute value and its rank.

    The rank runs over one row per feature.
    """
    sizes = attributions.groupBy(*groups, "feature").agg(
        F.avg(F.abs("value")).alias("mean_abs_value"))
    order = Window.partitionBy(*groups).orderBy(F.col("mean_abs_value").desc(), "feature")
    return sizes.withColumn("rank", F.row_number().over(order))


def dependence_pairs(table: DataFrame, feature: str) -> DataFrame:
    """Input value against attribution of one feature."""
    return table.where(F.col("feature") == feature).select("input_value", "value")


def decision_paths(attributions: DataFrame, *, key: str, start: float) -> DataFrame:
    """(row, step): the score as features are added, smallest mean effect first.

    ``start`` is the expected score, the mean over the background the attributions are relative
    to, so a path ends at the row's own score. It has one step per feature.
    """
    ranks = attribution_summary(attributions, []).select("feature", "rank")
    walk = Window.partitionBy(key).orderBy(F.col("rank").desc()).rowsBetween(
        Window.unboundedPreceding, 0)
    return attributions.join(ranks, "feature").select(
        key, "feature", F.row_number().over(Window.partitionBy(key).orderBy(
            F.col("rank").desc())).alias("step"),
        (F.sum("value").over(walk) + F.lit(start)).alias("score"))
