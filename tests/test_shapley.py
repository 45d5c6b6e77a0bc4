"""Exact Shapley values against the definition, over all subsets of the features."""

from itertools import combinations
from math import factorial

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from ebbtide.ml import shapley
from ebbtide.ml.learners import Learner, fit_learner, predict


def random_tree(draw, inputs, depth, values):
    nodes, waiting, number = {}, [(0, 0)], 0
    while waiting:
        at, level = waiting.pop()
        if level == depth or draw.random() < 0.15:
            nodes[at] = float(draw.normal())
            continue
        left, right, number = number + 1, number + 2, number + 2
        nodes[at] = (int(draw.integers(inputs)), float(draw.choice(values)), left, right)
        waiting += [(left, level + 1), (right, level + 1)]
    return shapley.Tree(nodes, float(draw.uniform(0.1, 2)))


def walk(trees, row):
    total = 0.0
    for tree in trees:
        node = tree.nodes[0]
        while isinstance(node, tuple):
            column, threshold, left, right = node
            node = tree.nodes[left if row[column] <= threshold else right]
        total += tree.weight * node
    return total


def by_definition(trees, owner, row, background):
    """Values of the features that the inputs belong to, from every subset of them."""
    n = max(owner) + 1
    worth = {}
    for size in range(n + 1):
        for subset in combinations(range(n), size):
            mixed = [[row[c] if f in subset else other[c] for c, f in enumerate(owner)]
                     for other in background]
            worth[subset] = np.mean([walk(trees, m) for m in mixed])
    out = []
    for f in range(n):
        total = 0.0
        for subset in worth:
            if f not in subset:
                weight = factorial(len(subset)) * factorial(n - 1 - len(subset)) / factorial(n)
                total += weight * (worth[tuple(sorted((*subset, f)))] - worth[subset])
        out.append(total)
    return out


@pytest.mark.parametrize("inputs", [["a", "b"], ["a", "a__missing", "b", "c", "d"],
                                    [f"f{i}" for i in range(8)]])
def test_values_follow_the_definition(inputs):
    draw = np.random.default_rng(len(inputs))
    values = [-1.0, 0.0, 0.5, 1.0]
    trees = [random_tree(draw, len(inputs), 5, values) for _ in range(6)]
    leaves = shapley.leaves_of(trees, inputs)
    table = draw.choice([*values, 2.0, float("nan")], (30, len(inputs)))
    background = shapley.Background.of(*shapley.counted(leaves, table[:20]), len(leaves.value))
    found = shapley.values_of(leaves, background, table[20:])
    owner = [leaves.features.index(c.removesuffix("__missing")) for c in inputs]
    for row, got in zip(table[20:], found):
        np.testing.assert_allclose(got, by_definition(trees, owner, row, table[:20]), atol=1e-9)
    np.testing.assert_allclose(leaves.total(table), [walk(trees, r) for r in table], atol=1e-12)
    assert abs(background.mean(leaves) - np.mean([walk(trees, r) for r in table[:20]])) < 1e-12


def test_ten_features_once():
    draw = np.random.default_rng(1)
    trees = [random_tree(draw, 10, 7, [0.0, 0.5, 1.0])]
    inputs = [f"f{i}" for i in range(10)]
    leaves = shapley.leaves_of(trees, inputs)
    table = draw.choice([0.0, 0.5, 0.7, 2.0], (9, 10))
    background = shapley.Background.of(*shapley.counted(leaves, table[:8]), len(leaves.value))
    np.testing.assert_allclose(shapley.values_of(leaves, background, table[8:])[0],
                               by_definition(trees, range(10), table[8], table[:8]), atol=1e-9)


def test_a_lone_leaf_pays_nothing():
    leaves = shapley.leaves_of([shapley.Tree({0: 3.0})], ["a"])
    background = shapley.Background.of(*shapley.counted(leaves, np.zeros((4, 1))), 1)
    assert shapley.values_of(leaves, background, np.ones((2, 1))).tolist() == [[0.0], [0.0]]


def test_background_is_counted_without_sorting_its_rows(monkeypatch):
    draw = np.random.default_rng(5)
    inputs = ["a", "a__missing", *[f"f{i}" for i in range(8)]]
    values = [-1.0, 0.0, 0.25, 1.0]
    trees = [random_tree(draw, len(inputs), 5, values) for _ in range(60)]
    trees.append(random_tree(draw, len(inputs), 9, values))
    leaves = shapley.leaves_of(trees, inputs)
    assert leaves.slots.max() > shapley.FEW_SLOTS
    table = draw.choice([*values, 2.0, float("nan"), float("inf")], (5003, len(inputs)))
    bits = leaves.satisfied(table)
    want = {(leaf, int(b)): int(n) for leaf in range(len(leaves.value))
            for b, n in zip(*np.unique(bits[:, leaf], return_counts=True))}
    unique, sizes = np.unique, []
    monkeypatch.setattr(np, "unique", lambda a, *args, **named: (
        sizes.append(np.size(a)), unique(a, *args, **named))[1])
    leaf, found, count = shapley.counted(leaves, table)
    assert dict(zip(zip(leaf.tolist(), found.tolist()), count.tolist())) == want
    assert max(sizes) < len(table) * len(leaves.value) / 50


@pytest.mark.parametrize("algorithm, params", [
    ("gbt", {"maxIter": 5, "maxDepth": 3}), ("rf", {"numTrees": 4, "maxDepth": 4})])
def test_fitted_models_over_tables(spark, algorithm, params):
    rows = spark.range(400).select(
        F.concat(F.lit("u"), "id").alias("user_id"), (F.col("id") % 7).cast("double").alias("a"),
        F.when(F.col("id") % 5 > 0, (F.col("id") * 13 % 11).cast("double")).alias("b"),
        ((F.col("id") % 7 > 3) | (F.col("id") * 13 % 11 > 6)).cast("int").alias("label"))
    learner = Learner("x", algorithm, ["a", "b"], params).watch_gaps(rows)
    data = rows.withColumn(learner.vector, learner.vector_column())
    model = fit_learner(learner, data, None, "label", rows=400)
    assert learner.inputs == ["a", "b", "b__missing"]
    filled = rows.select("user_id", *[F.expr(t).alias(c) for c, t in (
        ("a", "a"), ("b", "coalesce(b, 0)"), ("b__missing", "CAST(b IS NULL AS DOUBLE)"))])
    leaves = shapley.ensemble_leaves([model, model], learner.inputs, spark)
    known = shapley.background_of(leaves, filled.repartition(3), learner.inputs)
    assert known.rows == 400
    found = shapley.tree_shapley(leaves, known, filled, learner.inputs, key="user_id")
    total = {r["user_id"]: r["total"] for r in found.groupBy("user_id").agg(
        F.sum("value").alias("total")).collect()}
    scored = {r["user_id"]: r["p"] for r in predict(
        model, filled.select("user_id", array_to_vector(F.array(*learner.inputs)).alias(
            learner.vector)), "p").collect()}
    score = {u: np.log(p / (1 - p)) if algorithm == "gbt" else p for u, p in scored.items()}
    assert len(total) == 400 and found.count() == 800
    for user, value in total.items():
        assert abs(value + known.mean(leaves) - score[user]) < 1e-6
