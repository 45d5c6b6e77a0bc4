"""Every named stack of both products is chosen, fitted, explained and read back."""

from types import SimpleNamespace

import numpy as np
import pytest
from pyspark.sql import functions as F

from ebbtide.ml import registry
from ebbtide.ml.stack import META, StackModel, probability, stack_predict
from ebbtide.operators.sampling import split_roles, stratified_folds
from ebbtide.plans import training

FOLDS = 2
FEATURES = [
    "genre_distinct_count", "genre_share_drama", "sched_match_index", "sched_match_index_drama",
    "video_fav_content_genre_Drama", "audio_fav_content_genre_Drama", "lw_series_finales",
    "lw_distinct_series", "video_device_count", "audio_device_count",
    "device_video_st_smart_tv_perc", "device_audio_st_smart_tv_perc", "mkt_opted_in",
    "mkt_email_opens_13w", "freq_seg_latest_news_A", "freq_seg_latest_video_A_1",
    "freq_seg_latest_audio_A_1", "audio_prod_music_st_perc", "ew_2", "ew_3",
    "profile_age", "profile_gender_enriched_female", "video_programme_follows_13w"]
SETTINGS = {"gbt": {"maxIter": 3, "maxDepth": 2}}


@pytest.fixture(scope="module")
def prepared(spark):
    draw = np.random.default_rng(8)
    x = draw.standard_normal((600, len(FEATURES)))
    y = (x[:, :12].sum(axis=1) + x[:, 18] + draw.logistic(size=600) > 0).astype(int)
    rows = spark.createDataFrame(
        [(f"u{i}", int(t), int(i % 6), *map(float, r)) for i, (t, r) in enumerate(zip(y, x))],
        "user_id string, y int, cohort int, " + ", ".join(f"{c} double" for c in FEATURES)
    ).withColumns({training.LABEL: F.col("y"),
                   "target_week_start_date": F.lit("2020-02-17").cast("date"),
                   "profile_age": F.when(F.col("cohort") > 0, F.col("profile_age"))}).drop("y")
    rows = stratified_folds(split_roles(rows, "user_id"), training.LABEL, FOLDS, "user_id",
                            groups=["role"]).persist()
    return training.Prepared(rows, SimpleNamespace(eligible=FEATURES), rows)


@pytest.mark.parametrize("name, product", [
    ("logistic", "audio"), ("boosted", "video"), ("simple", "video"), ("diverse", "video")])
def test_stack(prepared, spark, tmp_path, name, product):
    wanted = registry.stack_config(name, product, FEATURES)
    chosen = training.build_learners(prepared, name, product, folds=FOLDS, params=SETTINGS)
    assert [x.name for x in chosen] == list(wanted)
    for learner in chosen:
        how, n = wanted[learner.name]["select"] or (None, None)
        if how in ("gain", "rfe"):
            assert len(learner.features) == min(n, len(learner.features))
        assert set(learner.features) <= set(wanted[learner.name]["features"])
    model = training.stack_fit(prepared.rows, training.LABEL, chosen, FOLDS, keys=training.KEYS)
    assert set(model.thresholds) == {*wanted, META}
    assert min(model.scores["auc"].values()) > 0.6
    model.save(str(tmp_path / "stack"), spark)
    again = StackModel.load(str(tmp_path / "stack"), spark)
    left, right = (stack_predict(m, prepared.rows, ["user_id"]).agg(
        *[F.round(F.sum(probability(n)), 6) for n in (*wanted, META)]).first()
        for m in (model, again))
    assert left == right
    sample = prepared.rows.where("user_id < 'u11'")
    values, inputs, base = training.explain_learners(model, sample, prepared.rows)
    assert values.count() == inputs.count() == sample.count() * sum(
        len(x.features) for x in chosen)
    for learner in chosen:
        scored = training.explained_score(
            learner, model.fold_models[learner.name],
            sample.select("user_id", learner.vector_column()), "p")
        total = values.where(F.col("learner") == learner.name).groupBy("user_id").agg(
            F.sum("value").alias("total"))
        off = total.join(scored, "user_id").agg(F.max(F.abs(
            F.col("p") - F.lit(base[learner.name]) - F.col("total")))).first()[0]
        assert off < 1e-8
