"""Fits that folds share, and elimination, against separate fits."""

import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from ebbtide.ml import learners, newton
from ebbtide.ml.learners import Learner, fit_folds, fit_learner, predict

FOLDS = 4
FEATURES = [f"f{i}" for i in range(12)]


@pytest.fixture(scope="module")
def rows(spark):
    """Twelve columns of very different sizes, of which three matter; one is always 0."""
    draw = np.random.default_rng(2)
    x = draw.standard_normal((600, 12)) * 10.0 ** np.arange(-3, 9)
    x[:, 5] = 0.0
    margin = x @ (np.array([0, 2, 0, -1.5, 0, 0, 1, 0, 0, 0, 0, 0]) / 10.0 ** np.arange(-3, 9))
    label = (margin + draw.logistic(size=600) > 0).astype(int)
    data = [(f"u{i}", int(i % FOLDS), int(y), *map(float, r))
            for i, (r, y) in enumerate(zip(x, label))]
    return spark.createDataFrame(data, "user_id string, fold int, label int, "
                                 + ", ".join(f"{c} double" for c in FEATURES)).repartition(3)


def test_folds_fitted_together_are_the_separate_fits(rows):
    learner = Learner("x", "logr", FEATURES)
    data = rows.withColumn(learner.vector, learner.vector_column())
    together = fit_folds([learner], data, "label", "fold", FOLDS, rows=450,
                         keys=["user_id"])["x"]
    exact = Learner("x", "logr", FEATURES, {"tol": 1e-13, "maxIter": 1000})
    for i, model in enumerate(together):
        alone = fit_learner(exact, data.where(F.col("fold") != i), None, "label", rows=450)
        np.testing.assert_allclose(model.stages[0].maxAbs.toArray(),
                                   alone.stages[0].maxAbs.toArray())
        np.testing.assert_allclose(model.stages[1].coefficients.toArray(),
                                   alone.stages[1].coefficients.toArray(), atol=1e-6)
        assert abs(model.stages[1].intercept - alone.stages[1].intercept) < 1e-6
        left, right = (predict(m, data, "p").agg(F.sum("p")).first()[0] for m in (model, alone))
        assert abs(left - right) < 1e-4


def test_models_made_together_can_be_stored(rows, tmp_path):
    from pyspark.ml import PipelineModel

    learner = Learner("x", "logr", FEATURES[:3])
    data = rows.withColumn(learner.vector, learner.vector_column())
    model = fit_folds([learner], data, "label", "fold", FOLDS, rows=450,
                      keys=["user_id"])["x"][0]
    model.write().save(str(tmp_path / "model"))
    again = PipelineModel.load(str(tmp_path / "model"))
    assert predict(again, data, "p").agg(F.sum("p")).first() == predict(
        model, data, "p").agg(F.sum("p")).first()
    assert learners.importances(learner, model).keys() == set(FEATURES[:3])


def test_passes_do_not_grow_with_folds(rows):
    learner = Learner("x", "logr", FEATURES)
    counts = []
    for folds in (2, 12):
        data = rows.withColumn(learner.vector, learner.vector_column()).withColumn(
            "part", F.col("fold") * 3 + F.crc32(F.col("user_id").cast("binary")) % 3).withColumn(
            "part", (F.col("part") % folds).cast("int"))
        _, passes = newton.fold_models(data, learner.vector, "label", "part", folds,
                                       penalty=1 / 500)
        counts.append(passes)
    assert max(counts) <= 25 and counts[1] <= counts[0] + 8


def test_separable_rows_still_end(spark):
    df = spark.range(40).select(
        (F.col("id") >= 20).cast("int").alias("label"), (F.col("id") % 2).cast("int").alias("fold"),
        array_to_vector(F.array((F.col("id") - 19.5).cast("double"))).alias("v"))
    models, passes = newton.fold_models(df, "v", "label", "fold", 2, penalty=1e-6)
    assert passes < 2 * newton.MOST_PASSES
    for i, model in enumerate(models):
        p = predict(model, df.where(F.col("fold") != i), "p")
        assert p.where((F.col("p") > 0.5) != (F.col("label") == 1)).count() == 0


def refit_elimination(df, features, n):
    """One Spark fit for each feature that leaves."""
    left = list(features)
    tops = df.agg(*[F.max(F.abs(c)).alias(c) for c in left]).first().asDict()
    rows = df.count()
    while len(left) > n:
        vector = array_to_vector(F.array(*[F.col(c) / (tops[c] or 1.0) for c in left]))
        model = LogisticRegression(
            featuresCol="x", labelCol="y", standardization=False, regParam=1 / rows, tol=1e-12,
            maxIter=500).fit(df.select(vector.alias("x"), F.col("label").cast("double").alias("y")))
        left.pop(int(np.abs(model.coefficients.toArray()).argmin()))
    return left


@pytest.mark.parametrize("n", [1, 3, 6])
def test_elimination_keeps_what_refits_keep(rows, n):
    want = refit_elimination(rows, FEATURES, n)
    assert learners.feature_select_rfe(rows, "label", FEATURES, n, share=0) == want
    assert learners.feature_select_rfe(rows, "label", FEATURES, n) == want
    if n == 3:
        assert want == ["f1", "f3", "f6"]


def test_elimination_needs_few_passes(rows):
    data = rows.select(F.array(*FEATURES).alias("_x"), F.col("label").cast("double").alias("_y"),
                       F.lit(0).alias("_fold"))
    tops = rows.agg(*[F.max(F.abs(c)).alias(c) for c in FEATURES]).first()
    scale = np.array([t or 1.0 for t in tops])
    few, many = newton.FoldData(data, scale, 1), newton.FoldData(data, scale, 1)
    left = newton.eliminate(few, 1 / 600, 3, share=0.5)
    assert left == newton.eliminate(many, 1 / 600, 3, share=0)
    assert few.passes < many.passes / 2
