from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from ebbtide.config import ID_SENTINELS, NULL_SENTINEL, TITLE_SENTINELS, ChurnConfig
from ebbtide.functions import exprs
from ebbtide.operators.activity import windowed_activity
from ebbtide.operators import (
    cohorts, content, devices, genre, last_week, logs, product_mix, profile, time_of_day)
from ebbtide.sources import schemas

CFG = ChurnConfig(max_date=date(2020, 2, 23), named_brands=("One", "Two"))


def fresh(df):
    return df.where(F.col("fresh") == 1)


@pytest.mark.parametrize("shares, label", [
    ((0.4, 0.4, 0.2, 0.0, 0.0), "desktop-web"), ((0.0,) * 5, "desktop-web"),
    ((0.1, 0.2, 0.3, 0.3, 0.1), "mobile-web"), ((0.0, 0.0, 0.0, 0.0, 1.0), "other-web")])
def test_preferred_device_ties(spark, shares, label):
    names = [f"device_video_st_{n}_perc" for n, _ in devices.DEVICE_TYPES]
    df = spark.createDataFrame([shares], ", ".join(f"{n} double" for n in names))
    assert df.select(F.expr(devices.preferred_device("video", "st")).alias("x")).first().x == label


def test_preferred_listening_when_equal(spark):
    names = [f"audio_prod_{n}_st_perc" for n, _ in product_mix.LISTENING_DETAIL]
    df = spark.createDataFrame([(0.25,) * len(names)], ", ".join(f"{n} double" for n in names))
    text = product_mix.preferred_listening("st", detail=True)
    assert df.select(F.expr(text).alias("x")).first().x == "live-radio"


def test_ladder_and_sentinels(spark):
    df = spark.createDataFrame(
        [("null", "", "e1")], "brand_id string, series_id string, episode_id string")
    names = ["brand_id", "series_id", "episode_id"]
    row = df.select(exprs.tleo_ladder(names, ID_SENTINELS).alias("a"),
                    exprs.tleo_level(names, ID_SENTINELS).alias("b"),
                    exprs.tleo_ladder(names, NULL_SENTINEL).alias("c")).first()
    assert (row.a, row.b, row.c) == ("e1", "episode_id", "")
    assert "n/a" in TITLE_SENTINELS and "n/a" not in ID_SENTINELS


def test_device_types(spark):
    df = spark.createDataFrame(
        [("Desktop", "x"), ("Smart TV", None), ("Smartphone", "Applications"),
         ("Smartphone", "x"), ("Smartphone", None), ("Tablet", "Applications"), ("Tablet", "x"),
         (None, None)], "device_type string, browser_brand string")
    got = [r.x for r in df.select(devices.device_app_type().alias("x")).collect()]
    assert got == ["desktop-web", "smart-tv", "mobile-app", "mobile-web", "other-web",
                   "tablet-app", "tablet-web", "other-web"]


def test_moving_average(spark):
    names = ", ".join(f"releases_{n} double" for n in genre.RELEASES)
    zeros = (0.0,) * (len(genre.RELEASES) - 1)
    df = spark.createDataFrame(
        [("video", date(2020, 1, 6), 2.0, *zeros), ("video", date(2020, 1, 13), 4.0, *zeros),
         ("video", date(2020, 1, 20), 6.0, *zeros)], f"destination string, week date, {names}")
    rows = genre.schedule_moving_average(df, CFG).orderBy("week").collect()
    assert [r.scaled_releases_comedies for r in rows] == pytest.approx([1, 4 / 3, 1.5])
    assert {r.scaled_releases_news for r in rows} == {1.0}


def test_schedule_counts_a_title_once_per_week(make):
    base = {"media_type": "video", "brand_title": "T", "genre_names": "Drama"}
    rows = make(schemas.CATALOGUE, *[{**base, "tx_date": d} for d in
                                     ("2020-01-06", "2020-01-12", "2020-01-13", "null")],
                {**base, "tx_date": "1969-12-31"})
    got = {(r.week, r.releases_dramas) for r in genre.genre_schedule(rows).collect()}
    assert got == {(date(2020, 1, 6), 1.0), (date(2020, 1, 13), 1.0)}


def test_activation_takes_the_latest_before_the_last_week(make, spark):
    cfg = ChurnConfig(max_date=date(2020, 1, 26))
    users = spark.createDataFrame([("u",), ("v",)], "user_id string")
    events = make(schemas.AUDIO_ACTIVATIONS,
                  {"user_id": "u", "week_beginning": date(2020, 1, 6), "episode_id": "e1"},
                  {"user_id": "u", "week_beginning": date(2020, 1, 27), "episode_id": "e2"})
    catalogue = make(schemas.CATALOGUE, {
        "version_id": "v1", "episode_id": "e1", "brand_id": "null", "series_id": "s1",
        "genre_names": "News;Politics", "master_brand_name": "Radio Nine"})
    factors = spark.createDataFrame(
        [("s1", *[float(i) for i in range(20)])], schemas.item_factors(20))
    out = content.activation_asof(
        events, catalogue, content.content_mode_genre(catalogue, cfg), factors, cfg, "audio",
        cohorts.cohort_assign(users, cfg))
    got = {r.user_id: r for r in fresh(out).collect()}
    assert got["u"].activation_week == date(2020, 1, 6)
    assert got["u"].audio_weeks_since_activation == 3
    assert (got["u"].audio_activating_genre, got["u"].audio_activating_masterbrand) == (
        "News", "Other Radio")
    assert got["u"].audio_activ_f3 == 3.0
    assert got["v"].activation_week is None and out.count() == 4


def test_mode_sums_over_episodes(make):
    rows = [("e1", "A", "One"), ("e1", "A", "One"), ("e2", "B", "Two"), ("e3", "B", "Two"),
            ("e4", "B", "x radio")]
    catalogue = make(schemas.CATALOGUE, *[
        {"version_id": str(i), "episode_id": e, "brand_id": "b", "genre_names": g,
         "master_brand_name": m} for i, (e, g, m) in enumerate(rows)])
    row = content.content_mode_genre(catalogue, CFG).first()
    assert (row.content_id, row.genre, row.masterbrand, row.brand_simplified) == (
        "b", "B", "One", "One")


def test_favourite_needs_days_not_seconds(make, spark):
    base = {"user_id": "u", "destination": "VIDEO_APP", "app_name": "A", "series_id": "null",
            "episode_id": "e", "playback_time": 200}
    days = [date(2020, 2, 20), date(2020, 2, 21)]
    rows = make(schemas.ACTIVITY, *[
        {**base, "brand_id": "b1", "date_of_event": d} for d in days],
        *[{**base, "brand_id": "b2", "date_of_event": days[0], "playback_time": 9999}] * 5,
        {**base, "brand_id": "b3", "date_of_event": days[0], "playback_time": 10})
    row = fresh(content.favourite_pick(windowed_activity(rows, CFG), CFG)).first()
    assert (row.video_fav_content_id, row.video_fav_content_level) == ("b1", "brand_id")
    assert row.audio_fav_content_id is None


def test_series_order_with_unknown_dates(make):
    base = {"content_kind": "episode", "series_id": "s", "genre_list": "g;h"}
    rows = make(
        schemas.CATALOGUE,
        {**base, "episode_id": "e1", "version_id": "v1", "tx_date": "null", "tx_start": "null"},
        {**base, "episode_id": "e2", "version_id": "v2", "tx_date": "2020-01-02",
         "tx_start": "10:00:00"},
        {**base, "episode_id": "e2", "version_id": "v3", "tx_date": "2020-01-01",
         "tx_start": "null"},
        {**base, "episode_id": "e3", "version_id": "v4", "tx_date": "2020-01-01",
         "tx_start": "09:00:00"},
        {**base, "episode_id": "e4", "version_id": "v5", "series_id": "null",
         "tx_date": "2020-01-01"},
        {**base, "episode_id": "e5", "version_id": "v6", "content_kind": "clip",
         "tx_date": "2020-01-01"})
    schedule = last_week.series_schedule(rows)
    got = {r.episode_id: (r.episode_number, r.version_id_first_broadcast, r.tx_date)
           for r in schedule.collect()}
    assert got == {"e3": (1, "v4", date(2020, 1, 1)), "e2": (2, "v3", date(2020, 1, 1)),
                   "e1": (3, "v1", None)}
    flags = {r.episode_id: (r.eps_in_series, r.series_premiere, r.series_finale)
             for r in last_week.series_finales(schedule).collect()}
    assert flags == {"e3": (3, 1, 0), "e2": (3, 0, 0), "e1": (3, 0, 1)}


def test_demographics(make, spark):
    cfg = ChurnConfig(max_date=date(2020, 2, 9))  # scoring target week starts 2020-02-17
    created = {"a": date(2020, 2, 4), "b": date(2020, 2, 3), "c": None, "d": date(2019, 1, 1),
               "e": date(2019, 1, 1), "f": date(2019, 1, 1)}
    people = make(schemas.PROFILE, *[
        {"user_id": u, "created_date": d, "status": "active", "location": "gb", "age": "30"}
        for u, d in created.items()], {"user_id": "d", "status": "active"},
        {"user_id": "x", "status": "deleted"}, {"user_id": "y"})
    extension = make(schemas.PROFILE_EXTENSION, {"user_id": "e", "age_range": "35-39"})
    ages = make(schemas.AGE_PREDICTIONS, {"user_id": "e", "predicted_age": "16-34"},
                {"user_id": "f", "predicted_age": "16-34"})
    genders = make(schemas.GENDER_PREDICTIONS, {"user_id": "a", "predicted_gender": "male"})
    got = {r.user_id: r for r in fresh(profile.profile_demographics(
        people, extension, genders, ages, cfg)).collect()}
    assert set(got) == {"a", "b", "c", "e", "f"}
    assert (got["a"].acc_age_days, got["a"].train_eligible) == (13, 0)
    assert (got["b"].acc_age_days, got["b"].train_eligible) == (14, 1)
    assert (got["c"].acc_age_days, got["c"].train_eligible) == (None, 1)
    assert (got["e"].age_1634_enriched, got["f"].age_1634_enriched) == (0, 1)
    assert (got["a"].gender_enriched, got["a"].uk_flag) == ("male", 1)


def test_latest_optin(make):
    base = {"user_id": "u", "action_date": date(2020, 2, 10), "activity_type": "Follows",
            "resource_type": "newsletter", "resource_domain": "profile", "resource_id": "main"}
    rows = make(schemas.NEWSLETTER_ACTIONS,
                {**base, "server_time": datetime(2020, 2, 10, 10), "action": "followed"},
                {**base, "server_time": datetime(2020, 2, 10, 12), "action": "unfollowed"},
                {**base, "server_time": datetime(2020, 2, 11), "action": "followed",
                 "resource_id": "other"})
    row = fresh(logs.marketing_optin(rows, CFG)).first()
    assert (row.last_action, row.mkt_opted_in) == ("unfollowed", 0)
    assert (row.mkt_days_opted_in, row.mkt_days_opted_out) == (None, 13)


def test_mail_in_one_log_only(make):
    at = datetime(2020, 2, 23, 23, 59)  # the last feature day counts in full
    opens = make(schemas.EMAIL_EVENTS,
                 {"user_id": "u", "send_id": "1", "event_ts": at},
                 {"user_id": "u", "send_id": "1", "event_ts": datetime(2020, 1, 1)},
                 {"user_id": "u", "send_id": "2", "event_ts": datetime(2020, 1, 1)})
    clicks = make(schemas.EMAIL_EVENTS, {"user_id": "v", "send_id": "9", "event_ts": at})
    got = {r.user_id: r for r in fresh(logs.marketing_activity(opens, clicks, CFG)).collect()}
    assert (got["u"].mkt_email_opens_13w, got["u"].mkt_email_opens_lw) == (2, 1)
    assert (got["u"].mkt_email_clicks_13w, got["v"].mkt_email_opens_13w) == (0, 0)
    assert (got["v"].mkt_email_clicks_13w, got["v"].mkt_email_clicks_lw) == (1, 1)


def test_follow_rules(make):
    base = {"user_id": "u", "action_date": date(2020, 2, 18)}
    rows = make(
        schemas.USER_ACTIONS,
        {**base, "resource_type": "brand", "activity_type": "FOLLOWS", "resource_domain": "tv"},
        {**base, "resource_type": "brand", "activity_type": "FOLLOWS",
         "resource_domain": "radio", "action_date": date(2020, 1, 1)},
        {**base, "resource_type": "clip", "activity_type": "FAVOURITES",
         "resource_domain": "music"},
        {**base, "resource_type": "clip", "activity_type": "PLAYS", "resource_domain": "music"})
    row = fresh(logs.follow_counts(rows, CFG)).first()
    assert (row.video_programme_follows_13w, row.video_programme_follows_lastweek) == (1, 1)
    assert (row.audio_subscribes_13w, row.audio_subscribes_lastweek) == (1, 0)
    assert (row.audio_bookmarks_13w, row.audio_bookmarks_lastweek) == (1, 1)


def test_segments_of_the_last_week_only(make, spark):
    users = spark.createDataFrame([("u",)], "user_id string")
    rows = make(schemas.SEGMENTS,
                {"user_id": "u", "product": "Video", "segment": "A",
                 "date_of_segmentation": date(2020, 2, 19)},
                {"user_id": "u", "product": "news", "segment": "B",
                 "date_of_segmentation": date(2020, 2, 12)})
    row = fresh(logs.segment_pivot(rows, CFG, cohorts.cohort_assign(users, CFG))).first()
    assert (row.freq_seg_video, row.freq_seg_news) == ("A", "X. Inactive")


def test_sunday_is_sunday(make):
    rows = make(schemas.ACTIVITY, {
        "user_id": "u", "destination": "VIDEO_APP", "app_name": "A", "playback_time": 60,
        "date_of_event": date(2020, 2, 23), "event_ts": datetime(2020, 2, 23, 21, 30)})
    row = fresh(time_of_day.time_of_day_shares(windowed_activity(rows, CFG), CFG)).first()
    assert (row.product, row.dow_sunday, row.dow_monday, row.tod_peak) == ("video", 1, 0, 1)


@pytest.mark.parametrize("linear, expected", [(True, "od_linear_mixes"), (False, "od_radio")])
def test_listening_types(make, spark, linear, expected):
    catalogue = make(
        schemas.CATALOGUE,
        {"version_id": "p", "episode_id": "p", "format_names": "Podcast"},
        {"version_id": "q", "episode_id": "q", "version_type": "Podcast version"},
        {"version_id": "m", "episode_id": "m", "format_names": "Mixes"},
        {"version_id": "a", "episode_id": "a", "master_brand_name": "App Mixes"},
        {"version_id": "a", "episode_id": "a", "master_brand_name": "App Mixes"})
    rows = spark.createDataFrame(
        [("p", "t", "Live"), ("p", "t", "x"), ("q", "t", "x"), ("m", "t", "x"), ("a", "t", "x"),
         ("zz", "listed", "x"), (None, None, None)],
        "version_id string, tleo_id string, broadcast_type string")
    one = make(schemas.SOURCES["podcast_list"], {"tleo_id": "listed"})
    none = make(schemas.SOURCES["mixes_list"])
    out = product_mix.listening_type(rows, catalogue, one, none, none, CFG, linear_mixes=linear)
    got = {(str(r.version_id), str(r.broadcast_type), r.listening_type) for r in out.collect()}
    assert out.count() == 7
    assert got == {
        ("p", "Live", "live_radio"), ("p", "x", "od_app_podcasts"),
        ("q", "x", "od_radio_podcasts"), ("m", "x", expected), ("a", "x", "od_app_mixes"),
        ("zz", "x", "od_app_podcasts"), ("None", "None", "od_radio")}
