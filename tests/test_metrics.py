import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ebbtide.ml import metrics

SMALL = [(1, 0.9), (1, 0.8), (0, 0.3), (0, 0.2)]


@pytest.fixture(scope="module")
def small(spark):
    return spark.createDataFrame(SMALL, "y int, p double")


@pytest.fixture(scope="module")
def noisy(spark):
    rng = random.Random(3)
    rows = [(i % 4, int(rng.random() < 0.4), round(rng.random(), 2)) for i in range(800)]
    return spark.createDataFrame(rows, "fold int, y int, p double"), rows


def curve_of(rows):
    """False and true positive rates at every distinct score, from (0, 0)."""
    p, n = sum(y for y, _ in rows), sum(1 - y for y, _ in rows)
    fpr, tpr, cuts = [0.0], [0.0], [None]
    for cut in sorted({s for _, s in rows}, reverse=True):
        fpr.append(sum(1 - y for y, s in rows if s >= cut) / n)
        tpr.append(sum(y for y, s in rows if s >= cut) / p)
        cuts.append(cut)
    return np.array(fpr), np.array(tpr), cuts


def test_perfect_scores(small):
    assert metrics.roc_auc(small, "y", "p").first().auc == 1
    assert metrics.youden_threshold(small, "y", "p").first().threshold == 0.8
    row = metrics.confusion_metrics(small, "y", "p", 0.8).first()
    assert (row.tn, row.fp, row.fn, row.tp, row.accuracy, row.f1) == (2, 0, 0, 2, 1, 1)


def test_curve_and_area(noisy):
    df, rows = noisy
    areas = {r.fold: r.auc for r in metrics.roc_auc(df, "y", "p", ["fold"]).collect()}
    best = {r.fold: r.threshold
            for r in metrics.youden_threshold(df, "y", "p", ["fold"]).collect()}
    for fold in range(4):
        mine = [(y, s) for f, y, s in rows if f == fold]
        fpr, tpr, cuts = curve_of(mine)
        assert areas[fold] == pytest.approx(np.trapezoid(tpr, fpr))
        gap = np.round(tpr - fpr, 12)
        assert best[fold] == cuts[int(np.argmax(gap))]
        got = metrics.roc_curve(df.where(F.col("fold") == fold), "y", "p").orderBy(
            F.col("threshold").desc()).collect()
        assert [r.tpr for r in got] == pytest.approx(list(tpr[1:]))
        assert [r.fpr for r in got] == pytest.approx(list(fpr[1:]))


def test_mean_curve(noisy):
    df, rows = noisy
    grid = np.linspace(0, 1, 100)
    per_fold = []
    for fold in range(4):
        fpr, tpr, _ = curve_of([(y, s) for f, y, s in rows if f == fold])
        per_fold.append(np.interp(grid, fpr, tpr))
    mean, std = np.mean(per_fold, axis=0), np.std(per_fold, axis=0)
    mean[-1] = 1
    got = metrics.mean_roc(df, "y", "p", "fold").orderBy("point").collect()
    assert [r.point for r in got] == list(range(100))
    assert [r.mean_tpr for r in got] == pytest.approx(list(mean), abs=1e-9)
    assert [r.std_tpr for r in got] == pytest.approx(list(std), abs=1e-9)
    assert all(0 <= r.lower <= r.upper <= 1 for r in got)


def test_log_loss_is_clipped(spark):
    df = spark.createDataFrame([(1, 1.0), (0, 1.0)], "y int, p double")
    want = (-math.log(1 - 1e-15) - math.log(1e-15)) / 2
    assert metrics.log_loss(df, "y", "p").first().log_loss == pytest.approx(want, rel=1e-2)
