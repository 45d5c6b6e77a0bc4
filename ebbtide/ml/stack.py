"""The stacked ensemble: weak learners per fold, blended by a logistic meta-learner."""

from __future__ import annotations

import json
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import asdict, dataclass, field

from pyspark import inheritable_thread_target
from pyspark.ml import Model, PipelineModel
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ebbtide.functions.skew import stable
from ebbtide.ml import metrics
from ebbtide.ml.boosting import BoostedTrees, probabilities
from ebbtide.ml.learners import (
    Learner, fit_folds, fit_learner, importances, predict, shares_passes)

META = "meta"


@dataclass
class StackModel:
    """Fitted stack: models per learner and fold, thresholds, blend scaler, meta-learner."""

    learners: list[Learner]
    folds: int
    fold_models: dict[str, list[Model]]
    thresholds: dict[str, float]
    scale: dict[str, float]
    meta: LogisticRegressionModel
    gains: list[tuple[str, int, str, float]]
    scores: dict = field(default_factory=dict)

    def importances(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(
            self.gains, "learner string, fold int, feature string, gain double")

    def save(self, path: str, spark: SparkSession) -> None:
        """Spark model folders, a table of boosted trees, and one small JSON row for the rest."""
        boosted: list[tuple[str, int, str]] = []
        for name, models in self.fold_models.items():
            for i, model in enumerate(models):
                if isinstance(model, BoostedTrees):
                    boosted.append((name, i, json.dumps(model.plain())))
                    continue
                PipelineModel([model]).write().overwrite().save(f"{path}/{_safe(name)}/{i}")
        self.meta.write().overwrite().save(f"{path}/{META}")
        plain = {"learners": [asdict(x) for x in self.learners], "folds": self.folds,
                 "thresholds": self.thresholds, "scale": self.scale, "gains": self.gains,
                 "scores": self.scores}
        spark.createDataFrame(boosted, "learner string, fold int, model string").write.mode(
            "overwrite").parquet(f"{path}/boosted")
        spark.createDataFrame([(json.dumps(plain),)], "state string").write.mode(
            "overwrite").parquet(f"{path}/state")

    @classmethod
    def load(cls, path: str, spark: SparkSession) -> StackModel:
        plain = json.loads(spark.read.parquet(f"{path}/state").first()["state"])
        learners = [Learner(**x) for x in plain.pop("learners")]
        boosted = {(r["learner"], r["fold"]): BoostedTrees.of_plain(json.loads(r["model"]))
                   for r in spark.read.parquet(f"{path}/boosted").collect()}
        models = {x.name: [
            boosted[x.name, i] if (x.name, i) in boosted
            else PipelineModel.load(f"{path}/{_safe(x.name)}/{i}").stages[0]
            for i in range(plain["folds"])] for x in learners}
        gains = [tuple(g) for g in plain.pop("gains")]
        return cls(learners=learners, fold_models=models, gains=gains,
                   meta=LogisticRegressionModel.load(f"{path}/{META}"), **plain)


def _safe(name: str) -> str:
    return "".join(ch if ch.isalnum() else "_" for ch in name)


def probability(name: str) -> str:
    return f"p_{_safe(name)}"


def _fold_scores(learners: Sequence[Learner], models: dict[str, list[Model]],
                 df: DataFrame) -> DataFrame:
    """Adds per learner an array of the fold models' probabilities, in one pass."""
    for learner in learners:
        if all(isinstance(m, BoostedTrees) for m in models[learner.name]):
            df = df.withColumn(f"_{probability(learner.name)}",
                               probabilities(models[learner.name]))
            continue
        names = [f"_f{i}" for i in range(len(models[learner.name]))]
        for name, model in zip(names, models[learner.name]):
            df = predict(model, df, name)
        df = df.withColumn(f"_{probability(learner.name)}", F.array(*names)).drop(*names)
    return df


def fold_mean(learner: Learner, models: Sequence[Model], df: DataFrame, name: str) -> DataFrame:
    """Adds the mean probability over one learner's fold models."""
    scored = _fold_scores([learner], {learner.name: list(models)}, df)
    scores = f"_{probability(learner.name)}"
    return scored.withColumn(name, _mean(scores)).drop(scores)


def _mean(scores: str) -> Column:
    total = F.aggregate(scores, F.lit(0.0), lambda a, b: a + b)
    return total / F.size(scores)


def _blend_vector(learners: Sequence[Learner], scale: dict[str, float]) -> Column:
    return array_to_vector(F.array(*[
        F.col(probability(x.name)) / F.lit(scale[x.name]) for x in learners]))


def stack_fit(df: DataFrame, label: str, learners: Sequence[Learner], folds: int, *,
              keys: Sequence[str] = ("user_id",), role: str = "role", fold: str = "fold",
              threads: int = 8) -> StackModel:
    """Fits every learner on every fold of the public rows, then the meta-learner.

    Vectors are built and stored once; the driver only loops over fits.
    """
    public = df.where(F.col(role) == "public")
    learners = [x.watch_gaps(public) for x in learners]
    data = stable(df.select(*keys, label, role, fold, *[x.vector_column() for x in learners]))
    data = data.persist()
    public = data.where(F.col(role) == "public")
    rows = public.count()

    def fit(job: tuple[Learner, int]) -> Model:
        learner, i = job
        if learner.name in together:
            return together[learner.name][i]
        columns = [learner.vector, label]
        return fit_learner(learner, public.where(F.col(fold) != i).select(*columns),
                           public.where(F.col(fold) == i).select(*columns), label,
                           rows=rows * (folds - 1) // folds, seed=i)

    jobs = [(x, i) for x in learners for i in range(folds)]
    try:
        together = fit_folds([x for x in learners if shares_passes(x)], public, label, fold,
                             folds, rows=rows * (folds - 1) // folds, keys=keys)
        with ThreadPoolExecutor(threads) as pool:
            fitted = list(pool.map(inheritable_thread_target(data.sparkSession)(fit), jobs))
    except BaseException:
        data.unpersist()
        raise
    models = {x.name: [m for (y, _), m in zip(jobs, fitted) if y is x] for x in learners}
    gains = [(x.name, i, f, v) for (x, i), m in zip(jobs, fitted)
             for f, v in importances(x, m).items()]

    scored = _fold_scores(learners, models, data)
    own = F.col(role) == "public"
    blend = stable(scored.select(*keys, label, role, fold, *[
        F.when(own, F.get(f"_{probability(x.name)}", F.col(fold)))
        .otherwise(_mean(f"_{probability(x.name)}")).alias(probability(x.name))
        for x in learners]))
    data.unpersist()

    held_out = blend.where(own)
    long = held_out.select(label, fold, F.explode(F.array(*[
        F.struct(F.lit(x.name).alias("learner"), F.col(probability(x.name)).alias("score"))
        for x in learners])).alias("_p")).select(label, fold, "_p.*")
    per_fold = metrics.youden_threshold(long, label, "score", ["learner", fold])
    thresholds = {r["learner"]: r["t"] for r in
                  per_fold.groupBy("learner").agg(F.avg("threshold").alias("t")).collect()}

    top = held_out.agg(*[F.max(F.abs(probability(x.name))).alias(x.name)
                         for x in learners]).first()
    scale = {x.name: top[x.name] or 1.0 for x in learners}
    vectors = blend.withColumn("_b", _blend_vector(learners, scale))
    meta = LogisticRegression(
        featuresCol="_b", labelCol=label, standardization=False, maxIter=100,
        regParam=1.0 / max(rows, 1), rawPredictionCol="", predictionCol="",
        probabilityCol="_m").fit(vectors.where(own).select(
            "_b", F.col(label).cast("double").alias(label)))
    judged = stable(meta.transform(vectors.where(~own)).select(
        label, role, vector_to_array("_m")[1].alias("score")))
    model = StackModel(learners, folds, models, thresholds, scale, meta, gains)
    model.scores = _evaluate(judged, held_out, label, role, learners, thresholds, public, rows)
    model.thresholds[META] = model.scores["meta_threshold"]
    return model


def _evaluate(judged: DataFrame, held_out: DataFrame, label: str, role: str,
              learners: Sequence[Learner], thresholds: dict[str, float], public: DataFrame,
              rows: int) -> dict:
    """Loss and area on private and holdout rows, confusion of learners and of the stack."""
    loss = {r[role]: r["log_loss"]
            for r in metrics.log_loss(judged, label, "score", [role]).collect()}
    area = {r[role]: r["auc"] for r in metrics.roc_auc(judged, label, "score", [role]).collect()}
    cuts = [r["threshold"] for r in
            metrics.youden_threshold(judged, label, "score", [role]).collect()]
    cut = sum(cuts) / len(cuts) if cuts else 0.5
    private = judged.where(F.col(role) == "private")
    confusion = metrics.confusion_metrics(private, label, "score", cut).first().asDict()
    weak = {x.name: metrics.confusion_metrics(
        held_out, label, probability(x.name), thresholds[x.name]).first().asDict()
        for x in learners}
    positives = public.agg(F.sum(F.col(label).cast("bigint"))).first()[0] or 0
    return {"log_loss": loss, "auc": area, "meta_threshold": cut, "confusion": confusion,
            "weak_confusion": weak, "public_rows": rows, "positives": positives}


def stack_predict(model: StackModel, df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(row): probability and class per learner, and of the meta-learner."""
    vectors = df.select(*keys, *[x.vector_column() for x in model.learners])
    scored = _fold_scores(model.learners, model.fold_models, vectors)
    blend = scored.select(*keys, *[
        _mean(f"_{probability(x.name)}").alias(probability(x.name)) for x in model.learners])
    out = model.meta.transform(blend.withColumn(
        "_b", _blend_vector(model.learners, model.scale))).withColumn(
        probability(META), vector_to_array("_m")[1])
    names = [*[x.name for x in model.learners], META]
    classes = [(F.col(probability(n)) >= F.lit(model.thresholds[n])).cast("int")
               .alias(f"class_{_safe(n)}") for n in names]
    return out.select(*keys, *[probability(n) for n in names], *classes)
