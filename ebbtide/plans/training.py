"""Training and scoring jobs: feature set to fitted stack, fresh rows to score records."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, functions as F

from ebbtide.functions.skew import stable, staged_tables
from ebbtide.ml import explain, registry, shapley, what_if
from ebbtide.ml.learners import (
    Learner, feature_select_gain, feature_select_rfe, importance_mean, linear_weights, predict)
from ebbtide.ml.prepare import Preparation, columns_with_nulls, filled_features
from ebbtide.ml.scores import score_export
from ebbtide.ml.stack import StackModel, fold_mean, stack_fit, stack_predict
from ebbtide.operators.sampling import random_sample_n, split_roles, stratified_folds
from ebbtide.sources import publish, sinks

LABEL = "target_churn_next_week"
KEYS = ("user_id", "target_week_start_date")
KEEP = (*KEYS, LABEL, "cohort", "active_last_week", "train_eligible")


@dataclass
class Prepared:
    """Numeric training rows with role and fold, the steps that made them, imputed rows."""

    rows: DataFrame
    preparation: Preparation
    filled: DataFrame


def prepare_training(features: DataFrame, product: str, *, folds: int = 10,
                     active_only: bool = True, roots: Sequence[str] = ()) -> Prepared:
    """Learns the preparation on all training rows, then keeps and splits the population."""
    preparation, filled = Preparation.fit(features.where(F.col("fresh") == 0), product,
                                          roots=roots)
    rows = preparation.encode(filled, KEEP).where(F.col(LABEL).isNotNull())
    if active_only:
        rows = rows.where((F.col("active_last_week") == 1) & (F.col("train_eligible") == 1))
    split = split_roles(rows, "user_id")
    return Prepared(
        stable(stratified_folds(split, LABEL, folds, "user_id", groups=["role"])),
        preparation, filled)


def build_learners(prepared: Prepared, stack: str, product: str, *, folds: int = 10,
                   params: dict[str, dict] | None = None) -> list[Learner]:
    """Learners of a named stack; selection steps run on all public rows."""
    public = prepared.rows.where(F.col("role") == "public")
    config = registry.stack_config(stack, product, prepared.preparation.eligible)
    settings = params or {}
    learners: dict[str, Learner] = {}
    for name, entry in config.items():
        features = entry["features"]
        how, n = entry["select"] or (None, 0)
        extra = settings.get(entry["algorithm"], {})
        if how == "gain" and len(features) > n:
            best = feature_select_gain(public, LABEL, features, n, folds=folds, params=extra)
            features = [r["feature"] for r in best.collect()]
        elif how == "rfe" and len(features) > n:
            gaps = set(columns_with_nulls(public, features))
            candidates = [f for f in features if f not in gaps]
            if name == "cherry_logr" and "big_gbt" in learners:
                candidates = [f for f in learners["big_gbt"].features if f not in gaps]
            features = feature_select_rfe(
                public, LABEL, candidates, n, params=settings.get("logr"))
        elif how == "as":
            features = learners[n].features
        if features:
            learners[name] = Learner(name, entry["algorithm"], list(features), dict(extra))
    return list(learners.values())


def train(features: DataFrame, product: str, *, stack: str = "diverse", folds: int = 10,
          active_only: bool = True, params: dict[str, dict] | None = None
          ) -> tuple[StackModel, Prepared]:
    """``features`` is stored first, since learning reads it many times."""
    prepared = prepare_training(stable(features), product, folds=folds, active_only=active_only)
    learners = build_learners(prepared, stack, product, folds=folds, params=params)
    return stack_fit(prepared.rows, LABEL, learners, folds, keys=KEYS), prepared


def scoring_rows(features: DataFrame, preparation: Preparation, *,
                 active_only: bool = True) -> DataFrame:
    """Fresh rows, prepared as in training."""
    rows = features.where(F.col("fresh") == 1)
    if active_only:
        rows = rows.where(F.col("active_last_week") == 1)
    return preparation.transform(rows, KEYS)


def score(features: DataFrame, model: StackModel, preparation: Preparation, *,
          active_only: bool = True) -> DataFrame:
    """Predictions for the fresh rows."""
    return stack_predict(model, scoring_rows(features, preparation, active_only=active_only),
                         KEYS)


def explained_score(learner: Learner, models: Sequence, df: DataFrame, name: str) -> DataFrame:
    """Adds what a learner's attributions add up to, less its mean over the background.

    The mean over the folds of the log-odds for logistic regression and boosted trees, where
    the trees and weights are additive, and of the probability for forests and MLP.
    """
    parts = [f"_e{i}" for i in range(len(models))]
    for part, model in zip(parts, models):
        df = predict(model, df, part)
        if learner.algorithm in ("gbt", "logr"):
            df = df.withColumn(part, F.ln(F.col(part) / (1 - F.col(part))))
    return df.withColumn(name, sum(map(F.col, parts[1:]), F.col(parts[0])) / len(parts)).drop(
        *parts)


def explain_learners(model: StackModel, sample: DataFrame, background: DataFrame, *,
                     permutations: int = 1, seed: int = 7
                     ) -> tuple[DataFrame, DataFrame, dict[str, float]]:
    """Attributions and inputs of every learner on sample, and its mean score on background.

    (learner, user_id, feature, value), (learner, user_id, feature, input_value). Values of a row
    add up to its ``explained_score`` minus the base score. They are exact against all rows of
    background for trees and logistic regression; an MLP is explained by walks from a background
    of at most 200 rows.
    """
    spark = sample.sparkSession
    values, inputs, base = [], [], {}
    for learner in model.learners:
        models = model.fold_models[learner.name]
        columns = filled_features(learner.features, learner.with_nulls)
        own, known = sample.select("user_id", *columns), background.select("user_id", *columns)
        if learner.algorithm in ("gbt", "rf"):
            leaves = shapley.ensemble_leaves(models, learner.inputs, spark)
            counts = shapley.background_of(leaves, known, learner.inputs)
            found = shapley.tree_shapley(leaves, counts, own, learner.inputs, key="user_id")
        elif learner.algorithm == "logr":
            found = explain.linear_contributions(
                own, linear_weights(learner, models), key="user_id", background=known)
        else:
            def mean_score(df: DataFrame, learner=learner, models=models) -> DataFrame:
                return fold_mean(learner, models, df, "p")

            found = explain.shapley_sampled(
                mean_score, own, known, learner.inputs, key="user_id", vector=learner.vector,
                permutations=permutations, seed=seed)
        label = F.lit(learner.name).alias("learner")
        values.append(found.select(label, "user_id", "feature", "value"))
        inputs.append(explain.long_inputs(
            own, [f for f in learner.features], key="user_id").select(
            label, "user_id", "feature", "input_value"))
        base[learner.name] = explained_score(
            learner, models, background.select(learner.vector_column()), "p").agg(
            F.avg("p")).first()[0]

    def together(frames: list[DataFrame]) -> DataFrame:
        out = frames[0]
        for frame in frames[1:]:
            out = out.unionByName(frame)
        return stable(out)

    return together(values), together(inputs), base


def scoring_run(features: DataFrame, product: str, model: StackModel, preparation: Preparation,
                folder: str, run_at: datetime, *, sample: int = 1000, background: DataFrame,
                active_only: bool = True) -> dict[str, DataFrame]:
    """One weekly job: scores, history, attributions of all learners and importances, written.

    ``background`` holds prepared training rows. Returns what the folders below ``folder`` hold
    afterwards; a repeated run of a week and product replaces its own part only. The week's
    attributions and importances, without users, are also published together below
    ``folder/current``, where readers find them through ``publish.read_current``.
    """
    spark = features.sparkSession
    with staged_tables(spark):
        rows = stable(scoring_rows(features, preparation, active_only=active_only))
        records = score_export(stack_predict(model, rows, KEYS), model, product, run_at)
        history = sinks.score_append(records, f"{folder}/scores", product)
        chosen = stable(random_sample_n(rows, sample, "user_id", "explain"))
        values, inputs, _ = explain_learners(model, chosen, background)
        table = inputs.join(values, ["learner", "user_id", "feature"]).join(
            chosen.select(*KEYS), "user_id").withColumnRenamed("learner", "learner_name")
        by = ("target_week_start_date", "product", "learner_name")
        attributions = sinks.partitioned_export(
            table.withColumn("product", F.lit(product)), f"{folder}/attributions", by)
        week = rows.agg(F.max("target_week_start_date")).first()[0]
        gains = importance_mean(model.importances(spark)).select(
            F.col("learner").alias("learner_name"), "feature", "gain",
            F.lit(week).cast("date").alias("target_week_start_date"),
            F.lit(product).alias("product"))
        importances = sinks.partitioned_export(gains, f"{folder}/importances", by)
        publish.publish(spark, f"{folder}/current/{product}", {
            "attributions": table.drop("user_id", "target_week_start_date"),
            "importances": gains.drop("target_week_start_date", "product")},
            by={"attributions": ["learner_name"]})
        return {"scores": history, "attributions": attributions, "importances": importances}


def what_if_run(profiled: DataFrame, modifiers: DataFrame, numeric: Sequence[str],
                categorical: Sequence[str], score_users: Callable, root: str) -> DataFrame:
    """Impacts of the changes on representative users, published below root; what readers see."""
    spark = profiled.sparkSession
    with staged_tables(spark):
        impacts = what_if.representative_users(
            profiled, modifiers, numeric, categorical, score_users)
        publish.publish(spark, root, {"what_if": impacts})
    return publish.read_current(spark, root, "what_if")
