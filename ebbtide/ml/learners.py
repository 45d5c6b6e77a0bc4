"""Learners of the stack: logistic regression, boosted trees, MLP, random forest."""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

import numpy as np
from pyspark import inheritable_thread_target
from pyspark.ml import Model
from pyspark.ml.classification import (
    GBTClassifier, LogisticRegression, MultilayerPerceptronClassifier, RandomForestClassifier)
from pyspark.ml.feature import MaxAbsScaler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.pipeline import Pipeline, PipelineModel
from pyspark.sql import Column, DataFrame, functions as F

from ebbtide.ml import boosting, newton
from ebbtide.ml.prepare import (
    columns_with_nulls, feature_of, filled_texts, input_names, maxabs_fit)

# The learners' settings.
LOGISTIC = {"maxIter": 200, "fitIntercept": True, "elasticNetParam": 0.0}
BOOSTED = {"maxIter": 100, "stepSize": 0.1, "maxDepth": 5, "subsamplingRate": 0.67,
           "featureSubsetStrategy": "0.55", "validationTol": 0.001}
HIDDEN_LAYERS = (13, 13, 13)
VALIDATION = "_validation"


@dataclass
class Learner:
    """Name, algorithm (logr, gbt, mlp, rf), features and overriding settings."""

    name: str
    algorithm: str
    features: list[str]
    params: dict = field(default_factory=dict)
    with_nulls: list[str] = field(default_factory=list)

    @property
    def inputs(self) -> list[str]:
        return input_names(self.features, self.with_nulls)

    @property
    def vector(self) -> str:
        return "x_" + "".join(ch if ch.isalnum() else "_" for ch in self.name)

    def watch_gaps(self, df: DataFrame) -> Learner:
        """Notes which features have gaps in the training rows."""
        self.with_nulls = columns_with_nulls(df, self.features)
        return self

    def vector_column(self) -> Column:
        """The features as one vector; built by one expression, not by a model stage."""
        values = filled_texts(self.features, self.with_nulls).values()
        return array_to_vector(F.expr(f"array({', '.join(values)})")).alias(self.vector)


def make_estimator(learner: Learner, rows: int, label: str, seed: int = 0):
    """Estimator over the learner's vector.

    Scaling by the greatest absolute value is part of the model for the
    algorithms it matters to; tree splits do not depend on it.
    """
    x, scaled = learner.vector, f"{learner.vector}_scaled"
    out = {"labelCol": label, "predictionCol": ""}
    if learner.algorithm == "gbt":
        settings = {**BOOSTED, **learner.params}
        return GBTClassifier(
            featuresCol=x, validationIndicatorCol=VALIDATION, seed=seed, **out,
            **settings).setRawPredictionCol("").setProbabilityCol("p_")
    if learner.algorithm == "rf":
        return RandomForestClassifier(featuresCol=x, seed=seed, rawPredictionCol="",
                                      probabilityCol="p_", **out, **learner.params)
    scaler = MaxAbsScaler(inputCol=x, outputCol=scaled)
    if learner.algorithm == "logr":
        # penalty strength 1 on the summed loss
        settings = {**LOGISTIC, "regParam": 1.0 / max(rows, 1), **learner.params}
        return Pipeline(stages=[scaler, LogisticRegression(
            featuresCol=scaled, standardization=False, rawPredictionCol="", probabilityCol="p_",
            **out, **settings)])
    if learner.algorithm == "mlp":
        settings = {"maxIter": 200, **learner.params}
        layers = [len(learner.inputs), *HIDDEN_LAYERS, 2]
        return Pipeline(stages=[scaler, MultilayerPerceptronClassifier(
            featuresCol=scaled, layers=layers, seed=seed, rawPredictionCol="",
            probabilityCol="p_", **out, **settings)])
    raise ValueError(f"unknown algorithm {learner.algorithm}")


def fit_learner(learner: Learner, train: DataFrame, test: DataFrame | None, label: str, *,
                rows: int, seed: int = 0) -> Model:
    """Fits on train; boosted trees stop early on the test rows."""
    data = train.select(learner.vector, F.col(label).cast("double").alias(label),
                        F.lit(False).alias(VALIDATION))
    if learner.algorithm == "gbt":
        held = train.limit(0) if test is None else test
        data = data.unionByName(held.select(
            learner.vector, F.col(label).cast("double").alias(label),
            F.lit(True).alias(VALIDATION)))
    estimator = make_estimator(learner, rows, label, seed)
    if learner.algorithm == "gbt" and test is None:
        estimator.clear(estimator.validationIndicatorCol)
    return estimator.fit(data)


def shares_passes(learner: Learner) -> bool:
    """Whether all folds of the learner can be fitted together."""
    known = {"logr": {"regParam", "maxIter", "tol"}, "gbt": set(boosting.SETTINGS)}
    return set(learner.params) <= known.get(learner.algorithm, set()) and (
        learner.algorithm in known)


def fit_folds(fitted: Sequence[Learner], public: DataFrame, label: str, fold: str, folds: int, *,
              rows: int, keys: Sequence[str]) -> dict[str, list]:
    """Models per learner and fold, fitted on the other folds' rows in passes that folds share.

    Boosted trees of all learners share them as well, and stop early on their own fold.
    """
    out: dict[str, list] = {}
    for learner in fitted:
        if learner.algorithm == "logr":
            out[learner.name], _ = newton.fold_models(
                public, learner.vector, label, fold, folds,
                penalty=learner.params.get("regParam", 1.0 / max(rows, 1)))
    boosted = [(x.name, x.vector, x.params) for x in fitted if x.algorithm == "gbt"]
    if boosted:
        found, _ = boosting.fit_folds(public, boosted, label, fold, folds,
                                      seed=F.xxhash64(*keys))
        out |= found
    return out


def predict(model: Model | boosting.BoostedTrees, df: DataFrame, name: str) -> DataFrame:
    """Adds the probability of class 1 as ``name``."""
    if isinstance(model, boosting.BoostedTrees):
        return df.withColumn(name, boosting.probabilities([model])[0])
    scored = model.transform(df).withColumn(name, vector_to_array("p_")[1])
    return scored.drop("p_", *[c for c in scored.columns if c.endswith("_scaled")])


def _last(model: Model) -> Model:
    return model.stages[-1] if isinstance(model, PipelineModel) else model


def importances(learner: Learner, model: Model) -> dict[str, float]:
    """Gain per feature of tree learners; coefficients over the greatest one otherwise.

    The indicator of missing values counts for its feature.
    """
    last = _last(model)
    gains = isinstance(last, boosting.BoostedTrees) or hasattr(last, "featureImportances")
    if isinstance(last, boosting.BoostedTrees):
        values = last.gains
    elif gains:
        values = last.featureImportances.toArray()
    elif hasattr(last, "coefficients"):
        raw = last.coefficients.toArray()
        top = max((abs(v) for v in raw), default=0.0)
        values = raw / top if top else raw
    else:
        return {}
    out: dict[str, float] = {}
    for name, value in zip(learner.inputs, values):
        feature = feature_of(name)
        known = out.get(feature, 0.0)
        if gains:
            out[feature] = known + float(value)
        else:  # of two coefficients the greater one speaks for the feature
            out[feature] = max(known, float(value), key=abs)
    return out


def linear_weights(learner: Learner, models: Sequence[Model]) -> dict[str, float]:
    """Weight of each input as it is before scaling, averaged over the folds' models."""
    total = dict.fromkeys(learner.inputs, 0.0)
    for model in models:
        scaler, last = model.stages
        tops = scaler.maxAbs.toArray()
        for name, weight, top in zip(learner.inputs, last.coefficients.toArray(), tops):
            total[name] += float(weight) / float(top) if top else 0.0
    return {name: value / len(models) for name, value in total.items()}


# ---- feature selection ----------------------------------------------------

def feature_select_rfe(df: DataFrame, label: str, features: Sequence[str], n: int, *,
                       params: dict | None = None, share: float = 0.1) -> list[str]:
    """Drops the feature with the smallest coefficient until n are left.

    The rows become one stored array. A fit serves for the share of the features that leave after
    it, see ``newton.eliminate``.
    """
    if len(features) <= n:
        return list(features)
    maxes = maxabs_fit(df, features)
    texts = filled_texts(features, ()).values()
    data = df.select(F.expr(f"array({', '.join(texts)})").alias("_x"),
                     F.col(label).cast("double").alias("_y"), F.lit(0).alias("_fold")).persist()
    try:
        rows = data.count()
        penalty = (params or {}).get("regParam", 1.0 / max(rows, 1))
        scale = np.array([float(maxes[c]) for c in features])
        left = newton.eliminate(newton.FoldData(data, scale, 1), penalty, n, share)
    finally:
        data.unpersist()
    return [features[i] for i in left]


def feature_select_gain(df: DataFrame, label: str, features: Sequence[str], n: int, *,
                        fold: str = "fold", folds: int = 10, params: dict | None = None,
                        threads: int = 4) -> DataFrame:
    """(feature): mean gain over the folds' boosted models and rank, the best n."""
    learner = Learner("selection", "gbt", list(features), params or {}).watch_gaps(df)
    data = df.select(label, fold, F.xxhash64(*df.columns).alias("_seed"),
                     learner.vector_column()).persist()

    def fit(i: int) -> list[tuple[str, int, float]]:
        model = fit_learner(learner, data.where(F.col(fold) != i), data.where(F.col(fold) == i),
                            label, rows=0, seed=i)
        return [(f, i, v) for f, v in importances(learner, model).items()]

    try:
        if shares_passes(learner):
            models = fit_folds([learner], data, label, fold, folds, rows=0, keys=["_seed"])
            rows = [(f, i, v) for i, model in enumerate(models[learner.name])
                    for f, v in importances(learner, model).items()]
        else:
            with ThreadPoolExecutor(threads) as pool:
                rows = [r for part in pool.map(
                    inheritable_thread_target(df.sparkSession)(fit), range(folds)) for r in part]
    finally:
        data.unpersist()
    gains = df.sparkSession.createDataFrame(rows, "feature string, fold int, gain double")
    mean = importance_mean(gains, [])
    best = mean.orderBy(F.col("gain").desc(), "feature").limit(n)
    return best.select("feature", "gain")


def importance_mean(gains: DataFrame, groups: Sequence[str] = ("learner",)) -> DataFrame:
    """(learner, feature): gain averaged over folds."""
    return gains.groupBy(*groups, "feature").agg(F.avg("gain").alias("gain"))
