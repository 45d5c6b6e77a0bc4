import random
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from ebbtide.ml import explain, learners, metrics, prepare, registry, what_if
from ebbtide.ml.scores import score_export
from ebbtide.ml.stack import META, StackModel, probability, stack_fit, stack_predict
from ebbtide.operators.sampling import split_roles, stratified_folds

FOLDS = 3


def test_encoder_is_fixed_by_training(spark):
    train = spark.createDataFrame([("A",), ("B",)], "c string")
    encoder = prepare.OneHot.fit(train, ["c"])
    assert encoder.outputs == ["c_A", "c_B"]
    score = spark.createDataFrame([("B",), ("C",), (None,)], "c string")
    got = [(r.c_A, r.c_B) for r in encoder.transform(score).collect()]
    assert got == [(0, 1), (0, 0), (0, 0)]


def test_encoder_refuses_endless_categories(spark):
    df = spark.range(50).select(F.col("id").cast("string").alias("c"))
    with pytest.raises(ValueError):
        prepare.OneHot.fit(df, ["c"], max_categories=10)


def test_scaling_uses_training_maxima(spark):
    train = spark.createDataFrame([(-4.0, 0.0, None), (2.0, 0.0, None)],
                                  "a double, b double, c double")
    maxes = prepare.maxabs_fit(train, ["a", "b", "c"])
    assert maxes == {"a": 4.0, "b": 1.0, "c": 1.0}
    row = prepare.maxabs_scale(
        spark.createDataFrame([(8.0, 3.0, 1.0)], train.schema), maxes).first()
    assert tuple(row) == (2.0, 3.0, 1.0)


def test_imputer_fills_gaps_only(spark):
    rows = [(str(i), float(i % 5), None if i % 4 == 0 else 2.0 * (i % 5) + 1,
             None if i % 7 == 0 else ("low" if i % 5 < 2 else "high")) for i in range(200)]
    df = spark.createDataFrame(rows, "user_id string, h double, age double, kind string")
    imputer = prepare.Imputer.fit(df, {"age": "regression", "kind": "classification"}, ["h"])
    got = {r.user_id: r for r in imputer.transform(df).collect()}
    for key, h, age, kind in rows:
        assert got[key].age == pytest.approx(2 * h + 1, abs=1e-3)
        assert got[key].kind == ("low" if h < 2 else "high")
    assert imputer.transform(df).columns == df.columns


def test_roles():
    roles = registry.feature_registry(
        ["user_id", "fresh", "stw_0", "stw_2", "ew_1", "ew_2", "genre_share_drama",
         "device_video_st_app_perc", "device_video_st_preferred", "freq_seg_latest_news",
         "video_fav_f3", "video_fav_content_genre", "mkt_opted_in", "mkt_days_opted_in",
         "video_user", "audio_user", "profile_age", "profile_uk_flag"], "video")
    assert [c for c, r in roles.items() if r == "unclassified"] == [
        "fresh", "stw_0", "video_user", "profile_uk_flag"]
    assert roles["ew_1"] == "id" and roles["ew_2"] == "continuous"
    assert roles["device_video_st_preferred"] == roles["freq_seg_latest_news"] == "factor"
    assert roles["video_fav_content_genre"] == "factor" and roles["video_fav_f3"] == "continuous"


@pytest.mark.parametrize("stack, product, names", [
    ("diverse", "video", ["Content", "Behaviour", "Marketing", "Cross-Sell"]),
    ("diverse", "audio", ["Content", "Behaviour", "Marketing", "Cross-Sell", "Product Type"]),
    ("logistic", "video", ["Content", "Behaviour", "Marketing", "Cross-Sell", "RFE-Optimised",
                           "RFE-Boosted"]),
    ("boosted", "audio", ["event_gbt", "index_gbt", "big_gbt", "little_gbt", "demo_gbt"]),
    ("simple", "video", ["event_logr", "index_logr", "big_gbt", "cherry_logr", "demo_gbt",
                         "explorer_gbt"])])
def test_stack_configs(stack, product, names):
    columns = ["genre_share_news", "ew_3", "freq_seg_latest_video_A", "freq_seg_latest_audio_A",
               "freq_seg_latest_all_A", "freq_seg_latest_news_A", "profile_age"]
    config = registry.stack_config(stack, product, columns)
    assert list(config) == names
    if stack == "diverse":
        other = "audio" if product == "video" else "video"
        assert sorted(config["Cross-Sell"]["features"]) == sorted(
            [f"freq_seg_latest_{other}_A", "freq_seg_latest_news_A"])


@pytest.fixture(scope="module")
def rows(spark):
    """900 users whose label follows a and, weakly, b; c is noise with gaps."""
    rng = random.Random(11)
    data = []
    for i in range(900):
        a, b = rng.gauss(0, 1), rng.gauss(0, 1)
        y = int(a + 0.4 * b + rng.gauss(0, 0.7) > 0)
        data.append((f"u{i}", date(2020, 2, 17), y, i % 6, a, b,
                     None if i % 9 == 0 else rng.random()))
    df = spark.createDataFrame(
        data, "user_id string, target_week_start_date date, y int, cohort int, a double, "
        "b double, c double")
    return stratified_folds(split_roles(df, "user_id"), "y", FOLDS, "user_id",
                            groups=["role"]).persist()


@pytest.fixture(scope="module")
def stack(rows):
    chosen = [learners.Learner("Trees", "gbt", ["a", "c"], {"maxIter": 5, "maxDepth": 3}),
              learners.Learner("Line", "logr", ["a", "b"])]
    return stack_fit(rows, "y", chosen, FOLDS,
                     keys=("user_id", "target_week_start_date"))


def test_stack_learns(stack):
    assert set(stack.thresholds) == {"Trees", "Line", META}
    assert all(0 < t < 1 for t in stack.thresholds.values())
    assert set(stack.scores["auc"]) == {"private", "holdout"}
    assert min(stack.scores["auc"].values()) > 0.85
    assert max(stack.scores["log_loss"].values()) < 0.6
    assert len({id(m) for ms in stack.fold_models.values() for m in ms}) == 2 * FOLDS


def test_predictions_and_score_records(stack, rows):
    keys = ("user_id", "target_week_start_date")
    wide = stack_predict(stack, rows, keys)
    assert wide.count() == 900
    low, high = wide.agg(F.min(probability(META)), F.max(probability(META))).first()
    assert 0 <= low < high <= 1
    records = score_export(wide, stack, "video", datetime(2020, 2, 24))
    assert records.count() == 900 * 3
    assert records.where("learner_type = 'meta-learner'").count() == 900
    wrong = records.where((F.col("predicted_probability") >= F.col("optimal_threshold"))
                          != (F.col("optimal_classification") == 1))
    assert wrong.count() == 0
    own = stack_predict(stack, rows.where("role = 'holdout'"), keys)
    auc = metrics.roc_auc(own.join(rows, list(keys)), "y", probability(META)).first().auc
    assert auc == pytest.approx(stack.scores["auc"]["holdout"], abs=1e-6)


def test_stack_survives_saving(stack, rows, spark, tmp_path):
    stack.save(str(tmp_path / "stack"), spark)
    again = StackModel.load(str(tmp_path / "stack"), spark)
    a = stack_predict(stack, rows, ["user_id"]).orderBy("user_id").collect()
    b = stack_predict(again, rows, ["user_id"]).orderBy("user_id").collect()
    assert a == b
    assert again.importances(spark).count() == stack.importances(spark).count()


@pytest.mark.parametrize("algorithm, params", [
    ("logr", {}), ("gbt", {"maxIter": 4, "maxDepth": 2}), ("rf", {"numTrees": 5}),
    ("mlp", {"maxIter": 40})])
def test_learners_beat_chance(rows, algorithm, params):
    learner = learners.Learner("one", algorithm, ["a", "b", "c"], params).watch_gaps(rows)
    assert learner.inputs == ["a", "b", "c", "c__missing"]
    data = rows.select("y", "fold", learner.vector_column())
    model = learners.fit_learner(learner, data.where("fold > 0"), data.where("fold = 0"), "y",
                                 rows=600)
    out = learners.predict(model, data.where("fold = 0"), "p")
    assert metrics.roc_auc(out, "y", "p").first().auc > 0.75


def test_selection_keeps_the_signal(rows):
    public = rows.where("role = 'public'")
    assert "a" in learners.feature_select_rfe(public, "y", ["a", "b", "c"], 1)
    best = learners.feature_select_gain(public, "y", ["a", "b", "c"], 2, folds=FOLDS,
                                        params={"maxIter": 4, "maxDepth": 2}).collect()
    assert len(best) == 2 and best[0].feature == "a"


@pytest.mark.parametrize("background", ["user_id = 'u500'", "user_id < 'u106'"])
def test_shapley_values_add_up(stack, rows, background):
    learner = stack.learners[0]
    model = stack.fold_models["Trees"][0]
    flat = rows.select("user_id", *prepare.filled_features(learner.features, learner.with_nulls))
    sample, known = flat.where("user_id in ('u1', 'u2', 'u9')"), flat.where(background)

    def predict(df):
        return learners.predict(model, df, "p")

    values = explain.shapley_sampled(
        predict, sample, known, learner.inputs, key="user_id", vector=learner.vector,
        permutations=3, seed=1)
    sums = {r.user_id: r.s for r in values.groupBy("user_id").agg(F.sum("value").alias("s"))
            .collect()}
    everyone = predict(rows.select("user_id", learner.vector_column()))
    scored = {r.user_id: r.p for r in everyone.collect()}
    base = everyone.join(known.select("user_id"), "user_id").agg(F.avg("p")).first()[0]
    for user, total in sums.items():
        assert total == pytest.approx(scored[user] - base, abs=1e-9)
    assert values.count() == 3 * len(learner.features)
    top = explain.attribution_summary(values, []).where("rank = 1").first()
    assert top.feature == "a"
    paths = explain.decision_paths(values, key="user_id", start=base)
    last = paths.where(f"step = {len(learner.features)}").collect()
    assert {r.user_id: r.score for r in last} == pytest.approx({u: scored[u] for u in sums})


def test_shapley_refuses_a_background_that_is_too_large(stack, rows):
    flat = rows.select("user_id", "a", "b", "c")
    with pytest.raises(ValueError):
        explain.shapley_sampled(None, flat, flat, ["a"], key="user_id", vector="x",
                                max_background=5)


def test_linear_contributions_follow_the_log_odds(rows):
    learner = learners.Learner("line", "logr", ["a", "b", "c"], {}).watch_gaps(rows)
    data = rows.withColumn("a", F.col("a") * 50).select(
        "user_id", "y", "fold", learner.vector_column(),
        *prepare.filled_features(learner.features, learner.with_nulls))
    models = [learners.fit_learner(learner, data.where(f"fold <> {i}"), None, "y", rows=600,
                                   seed=i) for i in range(2)]
    weights = learners.linear_weights(learner, models)
    out = explain.linear_contributions(data, weights, key="user_id")
    assert {r.feature for r in out.select("feature").distinct().collect()} == {"a", "b", "c"}
    total = out.groupBy("user_id").agg(F.sum("value").alias("total"))
    odds = data
    for i, model in enumerate(models):
        odds = learners.predict(model, odds, f"p{i}")
    odds = odds.select("user_id", sum(F.log(F.col(f"p{i}") / (1 - F.col(f"p{i}")))
                                      for i in range(2)).alias("odds"))
    mean = odds.agg(F.avg("odds")).first()[0] / 2
    for r in total.join(odds, "user_id").limit(50).collect():
        assert r.total == pytest.approx(r.odds / 2 - mean, abs=1e-6)


def test_one_hot_names_are_unique_and_the_limit_is_per_column(spark):
    df = spark.createDataFrame([("b_x", "p", "A-B"), ("b_x", "x", "A B")],
                               "a string, a_b string, c string")
    encoder = prepare.OneHot.fit(df, ["a", "a_b", "c"])
    assert len(set(encoder.outputs)) == len(encoder.outputs) == 5
    row = encoder.transform(df).orderBy("a_b").first().asDict()
    assert sum(row[o] for o in encoder.outputs) == 3
    wide = spark.createDataFrame([(str(i), "k") for i in range(30)], "m string, n string")
    with pytest.raises(ValueError):
        prepare.OneHot.fit(wide, ["m", "n"], max_categories=20)


def test_preparation_survives_saving(spark, tmp_path):
    rows = spark.createDataFrame(
        [(f"u{i}", float(i % 7), None if i % 5 == 0 else float(2 * (i % 7)),
          None if i % 4 == 0 else "xy"[i % 7 > 3], "kl"[i % 2]) for i in range(200)],
        "user_id string, h double, n double, t string, k string")
    imputer = prepare.Imputer.fit(rows, {"n": "regression", "t": "tree"}, ["h"])
    made = prepare.Preparation("video", imputer, prepare.OneHot.fit(rows, ["k"]), ["h", "n"], [])
    made.save(str(tmp_path / "prep"), spark)
    again = prepare.Preparation.load(str(tmp_path / "prep"), spark)
    assert again.eligible == made.eligible
    a = made.transform(rows, ["user_id"]).orderBy("user_id").collect()
    assert a == again.transform(rows, ["user_id"]).orderBy("user_id").collect()
    assert a[0].n is not None
    assert [r.t for r in imputer.transform(rows).collect()] == [
        r.t for r in again.imputer.transform(rows).collect()]


def test_linear_contributions_sum_to_the_distance(spark):
    df = spark.createDataFrame([("u", 1.0, 2.0), ("v", 3.0, 6.0)], "k string, a double, b double")
    out = explain.linear_contributions(df, {"a": 2.0, "b": -1.0}, key="k")
    got = {(r.k, r.feature): r.value for r in out.collect()}
    assert got == {("u", "a"): -2.0, ("u", "b"): 2.0, ("v", "a"): 2.0, ("v", "b"): -2.0}


def test_what_if_changes_one_feature(spark):
    people = spark.createDataFrame(
        [("a", 4.0, "x", 20, "female", 1, 4), ("b", 6.0, "x", 40, "male", 0, 1),
         ("c", 5.0, "y", 30, "female", 1, 5)],
        "user string, n double, k string, age int, gender string, age_1634 int, "
        "acorn_cat_num int")
    modifiers = spark.createDataFrame(
        [("user_base", "n", "delta", "2"), ("user_base", "k", "replace", "y"),
         ("user_base", "n", "replace", "50"), ("user_female", "n", "delta", "-1")],
        "user_id string, mod_column string, method string, modifier string")

    def score(users, keys):
        return users.select(*keys, (F.col("n") + (F.col("k") == "y").cast("int")).alias("p"))

    out = what_if.representative_users(people, modifiers, ["n"], ["k"], score).collect()
    got = {(r.user_id, r.mod_column, r.method): (r.baseval, r.modified_impact) for r in out}
    assert got == {("user_base", "n", "delta"): ("5.0", 2.0),
                   ("user_base", "n", "replace"): ("5.0", 45.0),
                   ("user_base", "k", "replace"): ("x", 1.0),
                   ("user_female", "n", "delta"): ("4.5", -1.0)}


def test_a_scoring_run_of_both_products_in_one_folder(stack, rows, spark, tmp_path, monkeypatch):
    from ebbtide.plans import training

    class Given:
        """Stands for a preparation whose rows are ready."""

        def transform(self, features, keep):
            return features.drop("fresh")

    ready = rows.withColumn("fresh", F.lit(1)).where("role = 'holdout'")
    known = rows.where("role = 'public'").limit(4)
    folder, counts = str(tmp_path / "out"), {}
    for product in ("video", "audio", "audio"):
        out = training.scoring_run(
            ready, product, stack, Given(), folder, datetime(2020, 2, 24), sample=5,
            background=known, active_only=False)
    users = ready.count()
    for r in out["scores"].groupBy("product").count().collect():
        counts[r["product"]] = r["count"]
    assert counts == {"video": users * 3, "audio": users * 3}
    per_learner = {(r["product"], r.learner_name): r["count"] for r in
                   out["attributions"].groupBy("product", "learner_name").count().collect()}
    assert len(per_learner) == 4
    assert {r.learner_name for r in out["importances"].collect()} <= {
        x.name for x in stack.learners}
