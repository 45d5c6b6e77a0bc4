from datetime import date

import pytest
from pyspark.sql import functions as F

from ebbtide.config import ChurnConfig
from ebbtide.operators import cohorts, target
from ebbtide.operators.activity import activity_weekly_rollup, activity_scan, windowed_activity
from ebbtide.sources import schemas

CFG = ChurnConfig(max_date=date(2020, 2, 23))


@pytest.mark.parametrize("cohort, expected", [
    (0, (date(2019, 11, 11), date(2020, 2, 23), date(2020, 2, 9), date(2020, 2, 3))),
    (5, (date(2019, 10, 7), date(2020, 1, 19), date(2020, 1, 5), date(2019, 12, 30))),
    (-2, (date(2019, 11, 25), date(2020, 3, 8), date(2020, 2, 23), date(2020, 2, 17))),
])
def test_cohort_dates(spark, cohort, expected):
    row = cohorts.cohort_dates(spark, CFG).where(F.col("cohort") == cohort).first()
    assert (row.min_date, row.max_date, row.max_feature_date, row.last_week_start) == expected
    assert (row.max_feature_date - row.min_date).days + 1 == 91


def test_extract_and_window_bounds(spark):
    assert CFG.extract_min_date == date(2019, 9, 15)
    assert CFG.max_week == date(2020, 2, 17)
    table = cohorts.cohort_dates(spark, CFG).agg(
        F.min("min_date").alias("low"), F.max("max_feature_date").alias("high")).first()
    assert (table.low, table.high) == (CFG.window_min_date, CFG.window_max_date)


def test_each_user_has_one_training_and_one_scoring_row(spark):
    users = spark.range(500).select(F.col("id").cast("string").alias("user_id"))
    rows = cohorts.cohort_assign(users, CFG).collect()
    assert len(rows) == 1000
    assert {r.cohort for r in rows if r.fresh == 1} == {-2}
    assert {r.cohort for r in rows if r.fresh == 0} == set(range(6))
    again = cohorts.cohort_assign(users, CFG).collect()
    assert sorted(rows) == sorted(again)


@pytest.mark.parametrize("cohort, week, k", [
    (1, date(2020, 2, 3), 1), (-2, date(2020, 2, 17), 2), (0, date(2020, 2, 17), 0)])
def test_weekly_offset(spark, cohort, week, k):
    df = spark.createDataFrame([(cohort, week)], "cohort int, week date")
    assert df.select(target.effective_week(CFG).alias("k")).first().k == k


def pivot_row(spark, ew, seconds, fresh):
    names = [f"ew_{w}" for w in range(15)]
    schema = ("user_id string, destination string, cohort int, fresh int, "
              "streaming_time_13w double, " + ", ".join(f"{n} bigint" for n in names))
    return spark.createDataFrame(
        [("u", "video", -2 if fresh else 0, fresh, float(seconds), *ew)], schema)


@pytest.mark.parametrize("seconds, active", [(200, 1), (180, 0)])
def test_target(spark, seconds, active):
    row = target.churn_target(pivot_row(spark, [0, 3, 1] + [0] * 12, seconds, 0), CFG).first()
    assert (row.target_churn_this_week, row.target_churn_next_week) == (0, 1)
    assert row.active_last_week == active


def test_target_of_scoring_rows_is_unknown(spark):
    row = target.churn_target(pivot_row(spark, [0, 3, 1] + [0] * 12, 200, 1), CFG).first()
    assert row.target_churn_this_week is None and row.target_churn_next_week is None


def test_regression_on_a_straight_line(spark):
    row = target.linreg_13w(
        pivot_row(spark, [0, 0, *range(13, 0, -1)], 0, 0)).first()
    assert (row.sy, row.sxy, row.syy) == (91, 455, 819)
    assert row.beta_hat == pytest.approx(-1) and row.alpha_hat == pytest.approx(14)
    assert row.se2 == pytest.approx(0, abs=1e-12) and row.x_intercept == pytest.approx(14)
    assert row.beta_lower == pytest.approx(-1, abs=1e-5)


def test_regression_on_zeros(spark):
    row = target.linreg_13w(pivot_row(spark, [0] * 15, 0, 0)).first()
    assert (row.beta_hat, row.alpha_hat, row.x_intercept) == (0, 0, None)


def test_rollup_counts_days_once_and_keeps_radio_apart(make):
    base = {"user_id": "u", "destination": "VIDEO_APP", "playback_time": 100, "page_views": 1,
            "genre_names": "Drama;Crime"}
    rows = make(
        schemas.ACTIVITY,
        {**base, "date_of_event": date(2020, 2, 17), "app_name": "A"},
        {**base, "date_of_event": date(2020, 2, 17), "app_name": "A", "genre_names": "Quiz"},
        {**base, "date_of_event": date(2020, 2, 23), "app_name": "A", "genre_names": None},
        {**base, "date_of_event": date(2020, 2, 23), "app_name": "R"},
        {**base, "date_of_event": date(2020, 2, 24), "app_name": "A"},
        {**base, "date_of_event": date(2020, 2, 23), "destination": "OTHER"})
    out = {r.destination: r for r in
           activity_weekly_rollup(activity_scan(rows, CFG), CFG).collect()}
    assert set(out) == {"video", "radio"}
    video = out["video"]
    assert (video.events, video.distinct_days, video.streaming_time) == (3, 2, 300)
    assert (video.genre_st_drama, video.genre_st_other) == (100, 200)


def test_window_uses_each_role_once(make):
    rows = make(schemas.ACTIVITY, *[
        {"user_id": "u", "destination": "VIDEO_APP", "app_name": "A",
         "date_of_event": d, "playback_time": 700}
        for d in (date(2020, 2, 23), date(2019, 12, 20), date(2018, 1, 1))])
    out = windowed_activity(rows, CFG).collect()
    assert all(r.date_of_event != date(2018, 1, 1) for r in out)
    assert [r.fresh for r in out if r.date_of_event == date(2020, 2, 23)] == [1]
    assert sorted(r.fresh for r in out if r.date_of_event == date(2019, 12, 20)) == [0, 1]
    assert windowed_activity(rows, CFG, min_playback=701).count() == 0
