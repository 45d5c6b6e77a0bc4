"""Logistic regression of all folds at once, from sums that add up over rows and folds.

One aggregation gives the gradient and the information matrix of every fold's rows. What a fold's
model is fitted on is everything but that fold, so at a common point its sums are the total less
its own. From there only gradients are needed, all folds' in one pass; the number of passes does
not depend on the number of folds.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegressionModel
from pyspark.ml.common import _py2java
from pyspark.ml.feature import MaxAbsScalerModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.ml.stat import Summarizer
from pyspark.ml.util import Identifiable
from pyspark.sql import DataFrame, SparkSession, functions as F

from ebbtide.functions.workers import find_package

STEP = 1e-9      # a step this small, against the size of the weights, ends the search
MOST_PASSES = 50


@dataclass
class Sums:
    """Of some rows at some weights: count, loss, gradient and, if asked for, information."""

    rows: float
    loss: float
    gradient: np.ndarray
    information: np.ndarray | None

    def __add__(self, other: Sums) -> Sums:
        return Sums(self.rows + other.rows, self.loss + other.loss,
                    self.gradient + other.gradient,
                    None if self.information is None else self.information + other.information)

    def __sub__(self, other: Sums) -> Sums:
        return self + Sums(-other.rows, -other.loss, -other.gradient,
                           None if other.information is None else -other.information)

    def penalised(self, weights: np.ndarray, penalty: np.ndarray) -> Sums:
        """Means over the rows, with half the penalty times the squared weights added."""
        n = max(self.rows, 1.0)
        return Sums(self.rows, self.loss / n + 0.5 * float(penalty @ weights ** 2),
                    self.gradient / n + penalty * weights,
                    None if self.information is None
                    else self.information / n + np.diag(penalty))


def batch_sums(x: np.ndarray, y: np.ndarray, weights: np.ndarray, information: bool) -> np.ndarray:
    """The sums of one batch as one flat vector; the last column of x is 1."""
    margin = x @ weights
    chance = 1 / (1 + np.exp(-np.clip(margin, -700, 700)))
    loss = np.logaddexp(0, margin).sum() - y @ margin
    parts = [[len(x), loss], x.T @ (chance - y)]
    if information:
        matrix = (x * (chance * (1 - chance))[:, None]).T @ x
        parts.append(matrix[np.triu_indices(x.shape[1])])
    return np.concatenate(parts)


def unpacked(flat: np.ndarray, size: int, information: bool) -> Sums:
    matrix = None
    if information:
        matrix = np.zeros((size, size))
        matrix[np.triu_indices(size)] = flat[2 + size:]
        matrix = matrix + np.triu(matrix, 1).T
    return Sums(flat[0], flat[1], flat[2:2 + size], matrix)


class FoldData:
    """Rows (_x array, _y, _fold) whose inputs are divided by scale in the tasks."""

    def __init__(self, rows: DataFrame, scale: np.ndarray, folds: int):
        find_package(rows.sparkSession)
        self.rows, self.scale, self.folds, self.passes = rows, scale, folds, 0
        self.columns = np.arange(len(scale))

    def only(self, columns: Sequence[int]) -> FoldData:
        """The same rows with some of the inputs."""
        out = FoldData(self.rows, self.scale, self.folds)
        out.columns = self.columns[list(columns)]
        return out

    @property
    def size(self) -> int:
        return len(self.columns) + 1

    def sums(self, weights: Sequence[np.ndarray], *, of: str, information: bool) -> list[Sums]:
        """One pass: for each fold, at its weights, the sums of its rows or of all the others'.

        A task adds up its rows; to the driver comes one vector a fold.
        """
        scale, folds, size, columns = self.scale, self.folds, self.size, self.columns
        own = {"rows": True, "others": False}[of]

        def run(items):
            total = {}
            for batch in items:
                x = batch.column(0).flatten().to_numpy(zero_copy_only=False)
                x = x.reshape(-1, len(scale))[:, columns] / scale[columns]
                x = np.append(x, np.ones((len(x), 1)), 1)
                y = batch.column(1).to_numpy(zero_copy_only=False)
                fold = batch.column(2).to_numpy(zero_copy_only=False)
                for i in range(folds):
                    at = (fold == i) == own
                    if at.any():
                        total[i] = total.get(i, 0.0) + batch_sums(
                            x[at], y[at], weights[i], information)
            if total:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(total), pa.int32()),
                     pa.array([v.tolist() for v in total.values()], pa.list_(pa.float64()))],
                    names=["fold", "sums"])

        self.passes += 1
        parts = self.rows.mapInArrow(run, "fold int, sums array<double>").groupBy("fold").agg(
            Summarizer.sum(array_to_vector("sums")).alias("sums"))
        length = 2 + size + (size * (size + 1) // 2 if information else 0)
        found = {r["fold"]: r["sums"].toArray() for r in parts.collect()}
        return [unpacked(found.get(i, np.zeros(length)), size, information)
                for i in range(folds)]


def solve(matrix: np.ndarray, gradient: np.ndarray) -> np.ndarray:
    """A Newton step; directions that the rows say nothing about are left alone."""
    return np.linalg.lstsq(matrix, gradient, rcond=1e-13)[0]


def small(step: np.ndarray, weights: np.ndarray) -> bool:
    return bool(np.abs(step).max(initial=0.0) <= STEP * max(1.0, np.abs(weights).max(initial=0.0)))


@dataclass
class Descent:
    """Newton steps of one model; its matrix may be from another point or other rows."""

    penalty: np.ndarray
    weights: np.ndarray
    matrix: np.ndarray | None = None
    step: np.ndarray | None = None
    best: tuple[np.ndarray, float, float] | None = None
    done: bool = False

    def take(self, sums: Sums) -> bool:
        """Moves on from the sums at its weights; a step that makes the loss greater is halved.

        True if the gradient no longer falls fast, so that a new matrix is worth a pass.
        """
        now = sums.penalised(self.weights, self.penalty)
        slope = float(np.abs(now.gradient).max())
        slow = False
        if now.information is not None:
            self.matrix = now.information
        if self.best is not None and now.loss > self.best[1] + 1e-12 * abs(self.best[1]):
            self.step, slow = self.step / 2, True
        else:
            slow = self.best is not None and slope > self.best[2] / 2
            self.best = self.weights, now.loss, slope
            self.step = solve(self.matrix, now.gradient)
        self.done = small(self.step, self.best[0])
        self.weights = self.best[0] if self.done else self.best[0] - self.step
        return slow and not self.done


def penalties(data: FoldData, penalty: float, scale: np.ndarray | float = 1.0) -> np.ndarray:
    """Penalty of each weight; the last, of the intercept, is none."""
    return np.append(penalty * np.ones(data.size - 1) * scale ** 2, 0.0)


def fit_all(data: FoldData, penalty: float,
            start: np.ndarray | None = None) -> tuple[np.ndarray, list[Sums]]:
    """Weights on all rows, and each fold's sums there."""
    descent = Descent(penalties(data, penalty), np.zeros(data.size) if start is None else start)
    for _ in range(MOST_PASSES):
        parts = data.sums([descent.weights] * data.folds, of="rows", information=True)
        at = descent.weights
        descent.take(sum(parts[1:], parts[0]))
        if descent.best[0] is at:
            kept = parts
        if descent.done:
            break
    return descent.best[0], kept


def fit_without_each(data: FoldData, penalty: float, scales: np.ndarray) -> list[np.ndarray]:
    """Weights of every fold's model, fitted on all other folds.

    scales holds, per fold, the unit of its weights against data.scale. Starts from the model of
    all rows, with each fold's own gradient and information there; later passes bring gradients
    only, and new matrices when a fold comes closer too slowly.
    """
    start, parts = fit_all(data, penalty)
    total = sum(parts[1:], parts[0])
    models = [Descent(penalties(data, penalty, scale), start) for scale in scales]
    for model, part in zip(models, parts):
        model.take(total - part)
    slow = False
    for _ in range(MOST_PASSES):
        if all(m.done for m in models):
            break
        sums = data.sums([m.weights for m in models], of="others", information=slow)
        slow = any([m.take(s) for m, s in zip(models, sums) if not m.done])
    return [m.best[0] for m in models]


def eliminate(data: FoldData, penalty: float, n: int, share: float = 0.1) -> list[int]:
    """Places of the n inputs left when that of the smallest weight goes again and again.

    After a fit, the inverse of its information matrix tells how the other weights move when an
    input leaves, and is reduced by it. A new fit, started from there, follows when the share of
    the inputs has left, so the fits grow with the logarithm of the number of inputs. With a share
    of 0 each input is followed by a fit.
    """
    left = list(range(data.size - 1))
    weights = None
    while len(left) > n:
        view = data.only(left)
        weights, parts = fit_all(view, penalty, weights)
        now = sum(parts[1:], parts[0]).penalised(weights, penalties(view, penalty))
        inverse = np.linalg.pinv(now.information, rcond=1e-13, hermitian=True)
        until = max(n, min(len(left) - 1, int(len(left) * (1 - share))))
        while len(left) > until:
            j = int(np.abs(weights[:-1]).argmin())
            if inverse[j, j] > 0:
                weights = weights - inverse[:, j] * (weights[j] / inverse[j, j])
                inverse = inverse - np.outer(inverse[:, j], inverse[j]) / inverse[j, j]
            weights = np.delete(weights, j)
            inverse = np.delete(np.delete(inverse, j, 0), j, 1)
            left.pop(j)
        data.passes += view.passes
    return left


def fold_scales(rows: DataFrame, size: int, folds: int) -> np.ndarray:
    """(folds, inputs): the greatest absolute value of each input in each fold's rows."""
    def run(items):
        top = {}
        for batch in items:
            x = np.abs(batch.column(0).flatten().to_numpy(zero_copy_only=False)).reshape(-1, size)
            fold = batch.column(2).to_numpy(zero_copy_only=False)
            for i in np.unique(fold).tolist():
                top[i] = np.maximum(top.get(i, 0.0), x[fold == i].max(axis=0))
        if top:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(top), pa.int32()),
                 pa.array([v.tolist() for v in top.values()], pa.list_(pa.float64()))],
                names=["fold", "top"])

    parts = rows.mapInArrow(run, "fold int, top array<double>").groupBy("fold").agg(
        Summarizer.max(array_to_vector("top")).alias("top")).collect()
    out = np.zeros((folds, size))
    for row in parts:
        if 0 <= row["fold"] < folds:
            out[row["fold"]] = row["top"].toArray()
    return out


def fold_models(df: DataFrame, vector: str, label: str, fold: str, folds: int, *,
                penalty: float) -> tuple[list[PipelineModel], int]:
    """Scaler and logistic model of each fold, as Spark's own fits of the other folds' rows give
    them, and the number of passes over the rows.

    df has a vector column and fold numbers 0 .. folds - 1 on every row.
    """
    rows = df.select(vector_to_array(vector).alias("_x"),
                     F.col(label).cast("double").alias("_y"),
                     F.col(fold).cast("int").alias("_fold")).persist()
    try:
        first = rows.first()
        size = len(first["_x"]) if first else 0
        own = fold_scales(rows, size, folds)
        top = np.array([np.delete(own, i, axis=0).max(axis=0, initial=0.0) for i in range(folds)])
        scale = np.where(own.max(axis=0) > 0, own.max(axis=0), 1.0)
        data = FoldData(rows, scale, folds)
        found = fit_without_each(data, penalty, np.where(top > 0, top / scale, 1.0))
    finally:
        rows.unpersist()
    spark = df.sparkSession
    out = []
    for weights, most in zip(found, top):
        unit = np.where(most > 0, most / scale, 0.0)
        out.append(as_pipeline(spark, vector, most, weights[:-1] * unit, float(weights[-1])))
    return out, data.passes + 1


def as_pipeline(spark: SparkSession, vector: str, most: np.ndarray, weights: np.ndarray,
                intercept: float) -> PipelineModel:
    """Spark's models with given parameters, so that they score and are stored like fitted ones."""
    context, scaled = spark.sparkContext, f"{vector}_scaled"
    scaler = MaxAbsScalerModel(MaxAbsScalerModel._new_java_obj(
        "org.apache.spark.ml.feature.MaxAbsScalerModel", _uid("MaxAbsScaler"),
        _py2java(context, Vectors.dense(most))))
    scaler = scaler.setInputCol(vector).setOutputCol(scaled)
    model = LogisticRegressionModel(LogisticRegressionModel._new_java_obj(
        "org.apache.spark.ml.classification.LogisticRegressionModel", _uid("LogisticRegression"),
        _py2java(context, Vectors.dense(weights)), intercept))
    model = model.setFeaturesCol(scaled).setPredictionCol("").setProbabilityCol("p_")
    model = model.setRawPredictionCol("")
    return PipelineModel([scaler, model])


def _uid(name: str) -> str:
    return f"{name}_{Identifiable().uid.rsplit('_', 1)[-1]}"
