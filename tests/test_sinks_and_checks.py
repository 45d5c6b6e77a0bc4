from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from ebbtide.operators import quality
from ebbtide.sources import readers, schemas, sinks


def score(user, week, p=0.5):
    return {"user_id": user, "target_week_start_date": week, "learner_type": "weak-learner",
            "learner_name": "x", "predicted_probability": p, "optimal_threshold": 0.5,
            "optimal_classification": 1, "score_datetime": datetime(2020, 2, 24)}


def test_history_survives_a_repeated_run(make, tmp_path):
    path = str(tmp_path / "scores")
    one, two = date(2020, 2, 17), date(2020, 2, 24)
    sinks.score_append(make(schemas.SCORES, score("a", one), score("b", one)), path, "video")
    batch = make(schemas.SCORES, score("a", two), score("u" * 400, two))
    sinks.score_append(batch, path, "video")
    out = sinks.score_append(batch, path, "video")
    assert out.count() == 4
    assert out.agg(F.max(F.length("user_id"))).first()[0] == 400
    assert sinks.score_append(batch, path, "video", mode="overwrite").count() == 2


def test_history_keeps_other_products_and_learners(make, tmp_path):
    path, week = str(tmp_path / "scores"), date(2020, 2, 17)
    sinks.score_append(make(schemas.SCORES, score("a", week)), path, "video")
    sinks.score_append(make(schemas.SCORES, score("a", week), score("b", week)), path, "audio")
    other = {**score("a", week), "learner_name": "y"}
    out = sinks.score_append(make(schemas.SCORES, other), path, "audio")
    assert sorted((r["product"], r.learner_name, r.user_id) for r in out.collect()) == [
        ("audio", "x", "a"), ("audio", "x", "b"), ("audio", "y", "a"), ("video", "x", "a")]


def test_csv_keeps_line_feeds_and_quotes(make, tmp_path):
    rows = [score(t, date(2020, 2, 17)) for t in ("a\nb", 'say "x", y', "back\\slash", "é")]
    df = make(schemas.SCORES, *rows)
    back = sinks.csv_feature_roundtrip(df, str(tmp_path / "csv"))
    assert sorted(r.user_id for r in back.collect()) == sorted(r["user_id"] for r in rows)
    assert back.where("predicted_probability = 0.5").count() == 4


def test_short_and_empty_csv_fields(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "a.csv").write_text(
        "user_id,target_week_start_date,learner_type\nu,2020-02-17,\nv,2020-02-17,x,y,0.5\n")
    rows = readers.read_csv(spark, str(folder), schemas.SCORES).orderBy("user_id").collect()
    assert rows[0].learner_type is None and rows[0].predicted_probability is None
    assert rows[1].predicted_probability == 0.5
    assert rows[0].target_week_start_date == date(2020, 2, 17)


def test_csv_keeps_types_and_values(make, tmp_path):
    df = make(schemas.SCORES, score("a,\"q\"", date(2020, 2, 17), 1 / 3),
              {"user_id": "b", "score_datetime": datetime(2020, 1, 1, 12, 30)})
    back = sinks.csv_feature_roundtrip(df, str(tmp_path / "csv"))
    assert back.schema == df.schema and sorted(back.collect(), key=str) == sorted(
        df.collect(), key=str)


def test_other_weeks_stay(spark, tmp_path):
    path = str(tmp_path / "history")
    for n, week in ((3, "2020-02-17"), (5, "2020-02-24"), (2, "2020-02-24")):
        out = sinks.historical_partition(spark.range(n), path, week)
    assert {(str(r.week_start), r["count"]) for r in out.groupBy("week_start").count().collect()
            } == {("2020-02-17", 3), ("2020-02-24", 2)}


def test_tables(spark):
    df = spark.createDataFrame([("a", 1)], "k string, v int")
    sinks.append_to_table(df, "score_table")
    sinks.append_to_table(df, "score_table")
    assert readers.read_table(spark, "score_table").count() == 2
    sinks.replace_table(df, "score_table")
    assert spark.table("score_table").count() == 1
    found = readers.read_query(spark, "SELECT * FROM score_table WHERE k = :k", {"k": "a"})
    assert found.count() == 1


def test_checks(spark):
    df = spark.createDataFrame([("a", 1, None), ("a", 2, None), ("b", 2, None)],
                               "k string, v int, w double")
    twice = quality.duplicate_key_check(df, ["k"])
    report = quality.expect_empty(twice, "keys", "warning").first()
    assert tuple(report) == ("keys", "warning", 1, '{"k":"a","n":2}')
    assert quality.expect_empty(twice.where("n > 5"), "keys").first().status == "pass"
    with pytest.raises(quality.CheckFailed):
        quality.require_empty(twice, "keys")
    assert {tuple(r) for r in quality.na_counts(df).collect()} == {("k", 0), ("v", 0), ("w", 3)}
    flat = {r.column_name: (r.variance, r.is_empty, r["drop"]) for r in
            quality.invariate_columns(df.withColumn("c", F.lit(7)), ["v", "w", "c"]).collect()}
    assert flat["v"][0] == pytest.approx(2 / 9)
    assert flat["w"] == (None, 1, 1) and flat["c"] == (0.0, 0, 1)


def test_stored_sources_give_the_same_feature_set(spark, folder, tmp_path):
    """The declared schemas hold the sources: written out and read back, nothing changes."""
    from ebbtide.plans.feature_set import Blocks
    from ebbtide.sources.sample_tables import CONFIG, SampleTables
    sample, root = SampleTables(spark, folder), str(tmp_path / "sources")
    for name in schemas.SOURCES:
        getattr(sample, name).write.parquet(f"{root}/{name}")
    for product, n in CONFIG.factors.items():
        sample.item_factors(product, n).write.parquet(f"{root}/item_factors_{product}")
    stored = readers.Sources(spark, root)
    columns = ["user_id", "fresh", "streaming_time_13w", "device_video_ev_preferred",
               "lw_distinct_episodes", "video_fav_content_genre", "mkt_email_opens_13w"]
    a = Blocks(stored, CONFIG, stage=True).feature_set("video").select(*columns).collect()
    b = Blocks(sample, CONFIG).feature_set("video").select(*columns).collect()
    assert len(a) > 50 and sorted(a, key=str) == sorted(b, key=str)
