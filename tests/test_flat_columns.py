"""The check of columns that never change, as the preparation needs it."""

from ebbtide.functions.skew import stable
from ebbtide.ml.prepare import Preparation
from ebbtide.operators import quality


def test_flat_columns_are_the_dropped_ones(spark):
    df = spark.createDataFrame(
        [(1, 2.0, None, float("nan"), 3, float("nan")), (1, None, None, float("nan"), 4, 1.0)],
        "a int, b double, c double, d double, e long, f double")
    dropped = {r["column_name"] for r in
               quality.invariate_columns(df, df.columns).where("drop = 1").collect()}
    for at_once in (1, 4, 40):
        assert set(quality.flat_columns(df, df.columns, at_once)) == dropped == set("abcd")


def test_preparation_needs_no_variance(spark, monkeypatch):
    """The check of flat columns asks for extremes only."""
    texts, build = [], quality.exprs
    monkeypatch.setattr(quality, "exprs", lambda given: build(
        [texts.append(t) or t for t in given]))
    features = stable(spark.createDataFrame(
        [(i, float(i), 5.0, "x") for i in range(20)],
        "user_id long, ew_2 double, ew_3 double, profile_nation string"))
    preparation, _ = Preparation.fit(features, "audio")
    assert preparation.numeric == ["ew_2"]
    assert texts and not any("var" in t for t in texts)
