"""Fits and selections see every row, also of tables above the sizes at which they used to sample."""

from types import SimpleNamespace

from pyspark.sql import functions as F

from ebbtide.ml import prepare
from ebbtide.plans import training


def test_imputer_learns_from_all_known_rows(spark):
    key = F.col("id")
    rows = spark.range(0, 120_000, 1, 4).select(
        key.cast("string").alias("user_id"), (key % 10).cast("double").alias("h"),
        F.when(key % 6_000 == 7, F.concat(F.lit("rare_"), key.cast("string")))
        .when(key % 11 > 0, F.when(key % 10 < 5, "low").otherwise("high")).alias("kind"))
    imputer = prepare.Imputer.fit(rows, {"kind": "classification"}, ["h"])
    known = sorted(r["kind"] for r in rows.where("kind IS NOT NULL").select("kind").distinct()
                   .collect())
    assert len(known) == 22
    assert list(imputer.trees["kind"].stages[-1].getLabels()) == known
    guessed = imputer.transform(rows.where("kind IS NULL")).groupBy("h").agg(
        F.collect_set("kind").alias("kinds"))
    assert all(r["kinds"] == ["low" if r["h"] < 5 else "high"] for r in guessed.collect())


def test_elimination_runs_on_all_public_rows(spark, monkeypatch):
    columns = [f"feature_{i}" for i in range(20)]
    rows = spark.range(0, 12_500, 1, 4).select(
        F.col("id").cast("string").alias("user_id"),
        F.when(F.col("id") % 25 == 0, "private").otherwise("public").alias("role"),
        (F.col("id") % 5).cast("int").alias("fold"), (F.col("id") % 2).alias(training.LABEL),
        *[((F.col("id") * (i + 3)) % 17).cast("double").alias(c) for i, c in enumerate(columns)])
    seen = []

    def spy(df, label, features, n, **settings):
        seen.append(df.count())
        return list(features)[:n]

    monkeypatch.setattr(training, "feature_select_rfe", spy)
    prepared = training.Prepared(rows, SimpleNamespace(eligible=columns), rows)
    chosen = {x.name: x for x in training.build_learners(prepared, "simple", "audio", folds=5)}
    assert seen == [12_000]
    assert chosen["cherry_logr"].features == columns[:15]
