"""Boosted trees of folds and learners grown together, against trees grown one by one."""

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from ebbtide.ml import boosting, metrics, shapley
from ebbtide.ml.boosting import BoostedTrees

FOLDS = 3
WHOLE = {"subsamplingRate": 1.0, "featureSubsetStrategy": "1.0", "maxIter": 4, "maxDepth": 3}


@pytest.fixture(scope="module")
def table():
    draw = np.random.default_rng(4)
    x = draw.standard_normal((500, 4))
    x[:, 1] = np.round(x[:, 1])
    x[:, 2] = 7.0
    y = (x[:, 0] + 0.7 * x[:, 1] + draw.logistic(size=500) > 0).astype(int)
    return x, y, np.arange(500) % FOLDS


@pytest.fixture(scope="module")
def rows(spark, table):
    data = [(int(i), int(f), int(t), [float(v) for v in r], [float(r[0]), float(r[3])])
            for i, (r, t, f) in enumerate(zip(*table))]
    df = spark.createDataFrame(data, "id long, fold int, y int, a array<double>, b array<double>")
    return df.withColumns({"a": array_to_vector("a"), "b": array_to_vector("b")}).repartition(3)


def fit(rows, learners, folds=FOLDS):
    return boosting.fit_folds(rows, learners, "y", "fold", folds, seed=F.xxhash64("id"))


def alone(x, y, cuts, start, trees, settings):
    """Margins of boosted trees on one table, each node split by trying all cuts."""
    margin = np.full(len(x), start)

    def grow(at, residual, curve, level):
        g, h = residual[at].sum(), curve[at].sum()
        best = (1e-9, None)
        for c in range(x.shape[1]) if level < settings["maxDepth"] else ():
            for cut in cuts[c]:
                left = at & (x[:, c] <= cut)
                lg, lh = residual[left].sum(), curve[left].sum()
                if min(lh, h - lh) >= 1.0:
                    gain = lg ** 2 / lh + (g - lg) ** 2 / (h - lh) - g ** 2 / h
                    if gain > best[0] + 1e-12:
                        best = gain, (left, at & ~left)
        if best[1] is None:
            margin[at] -= 0.1 * g / h
            return
        for part in best[1]:
            grow(part, residual, curve, level + 1)

    for _ in range(trees):
        p = boosting.chance(margin)
        grow(np.ones(len(x), bool), p - y, p * (1 - p), 0)
    return margin


def test_trees_are_those_of_separate_fits(rows, table):
    x, y, fold = table
    settings = {**WHOLE, "rounds": 100}
    models, _ = fit(rows, [("all", "a", settings), ("two", "b", settings)])
    cuts = boosting.bin_cuts(rows.select(vector_to_array("a").alias("_x")), 4)
    assert len(cuts[2]) == 0  # a column that never changes is never split
    for name, columns in (("all", [0, 1, 2, 3]), ("two", [0, 3])):
        for i, model in enumerate(models[name]):
            kept, own = fold != i, x[:, columns]
            want = alone(own[kept], y[kept], [cuts[c] for c in columns], model.start,
                         len(model.trees), settings)
            np.testing.assert_allclose(model.margins(own[kept]), want, atol=1e-9)


def test_passes_do_not_grow_with_folds_and_learners(rows):
    settings = {**WHOLE, "rounds": 100}
    _, few = fit(rows, [("a", "a", settings)])
    _, many = fit(rows, [("a", "a", settings), ("b", "b", settings), ("c", "a", settings)])
    assert few == many == 2 + 4 * 3 + 1


def test_models_stop_early_and_learn(rows, table):
    x, y, fold = table
    models, _ = fit(rows, [("a", "a", {"maxIter": 60})])
    sizes = [len(m.trees) for m in models["a"]]
    assert 3 < min(sizes) and max(sizes) < 60
    for i, model in enumerate(models["a"]):
        held = fold == i
        scored = [(float(p), int(t)) for p, t in zip(model.margins(x[held]), y[held])]
        df = rows.sparkSession.createDataFrame(scored, "score double, y int")
        assert metrics.roc_auc(df, "y", "score").first().auc > 0.7
        assert abs(sum(model.gains) - 1) < 1e-9 and model.gains[2] == 0
        assert max(model.gains[:2]) > model.gains[3]


def test_draws_do_not_depend_on_the_partitions(rows):
    settings = {"maxIter": 7, "maxDepth": 2}
    one, _ = fit(rows.coalesce(1), [("a", "a", settings)])
    many, _ = fit(rows.repartition(5), [("a", "a", settings)])
    assert [[t.feature for t in m.trees] for m in one["a"]] == [
        [t.feature for t in m.trees] for m in many["a"]]


def test_scores_and_explanations_agree(rows, table):
    x = table[0]
    models, _ = fit(rows, [("a", "a", WHOLE)])
    again = [BoostedTrees.of_plain(m.plain()) for m in models["a"]]
    scored = rows.select("id", boosting.probabilities(again).alias("p")).collect()
    leaves = shapley.leaves_of([t for m in again for t in m.as_trees()], list("abcd"))
    total = leaves.total(x)
    for row in scored:
        odds = sum(np.log(p / (1 - p)) for p in row["p"])
        assert len(row["p"]) == FOLDS and abs(odds - total[row["id"]]) < 1e-9


def test_samples_are_uniform():
    seeds = np.arange(-5000, 5000)
    for salt in (0, 1, 12_345):
        u = boosting.uniform(seeds, salt)
        assert 0 <= u.min() and u.max() < 1 and abs((u < 0.67).mean() - 0.67) < 0.02
