"""Versions behind a pointer, and CSV loads that refuse what does not fit."""

import os

import pytest
from pyspark.sql import functions as F

from ebbtide.sources import publish, readers, schemas


def numbers(spark, n):
    return spark.range(n).withColumn("learner", F.concat(F.lit("l"), F.col("id") % 2))


def test_readers_follow_the_pointer(spark, tmp_path):
    root = str(tmp_path / "out")
    with pytest.raises(FileNotFoundError):
        publish.current(spark, root)
    first = publish.publish(spark, root, {"a": numbers(spark, 3), "b": numbers(spark, 4)},
                            by={"a": ["learner"]})
    before = publish.read_current(spark, root, "a")
    second = publish.publish(spark, root, {"a": numbers(spark, 5), "b": numbers(spark, 6)})
    assert before.count() == 3 and publish.current(spark, root).endswith(second)
    assert publish.read_current(spark, root, "a").count() == 5
    assert publish.read_current(spark, root, "b").count() == 6
    assert [v for _, v in publish.versions(spark, root)] == [first, second]


def test_a_run_that_fails_half_way_changes_nothing(spark, tmp_path):
    root = str(tmp_path / "out")
    kept = publish.publish(spark, root, {"a": numbers(spark, 3)})
    bad = numbers(spark, 4).withColumn("x", F.when(
        F.col("id") == 3, F.raise_error(F.lit("lost"))).otherwise(1))
    with pytest.raises(Exception, match="lost"):
        publish.publish(spark, root, {"a": numbers(spark, 9), "b": bad})
    assert publish.current(spark, root).endswith(kept)
    assert publish.read_current(spark, root, "a").count() == 3
    assert os.listdir(f"{root}/versions") == [kept]


def test_old_versions_go(spark, tmp_path):
    root = str(tmp_path / "out")
    for n in range(1, 5):
        last = publish.publish(spark, root, {"a": numbers(spark, n)}, keep=2)
    assert len(os.listdir(f"{root}/versions")) == 2
    assert [n for n, _ in publish.versions(spark, root)] == [3, 4]
    assert publish.current(spark, root).endswith(last)
    assert publish.read_current(spark, root, "a").count() == 4


def score_file(tmp_path, *lines):
    folder = tmp_path / "in"
    folder.mkdir()
    head = ",".join(schemas.SCORES.fieldNames())
    (folder / "scores.csv").write_text("\n".join([head, *lines]) + "\n")
    return str(folder)


GOOD = "u,2020-02-17,weak-learner,x,0.5,0.25,1,2020-02-24T10:00:00.000Z"


def test_wrong_types_are_stored_and_counted(spark, tmp_path):
    path = score_file(
        tmp_path, GOOD, GOOD + ",beyond,the,last", "short,2020-02-17", ",,,,,,,",
        "bad,2020-02-17,weak-learner,x,half,0.25,yes,", "day,yesterday,weak-learner,x,,,,")
    rejects = str(tmp_path / "rejects")
    loaded = readers.load_csv(spark, path, schemas.SCORES, rejects, most=0.4)
    assert (loaded.n_rows, loaded.n_rejects) == (6, 2)
    assert loaded.rows.schema == schemas.SCORES
    users = sorted(str(r["user_id"]) for r in loaded.rows.collect())
    assert users == ["None", "short", "u", "u"]
    found = spark.read.parquet(rejects).select(
        "fields.user_id", "file", F.explode("faults").alias("f")).select(
        "user_id", "f.*", "file").collect()
    assert sorted((r["user_id"], r["column"], r["type"], r["value"]) for r in found) == [
        ("bad", "optimal_classification", "int", "yes"),
        ("bad", "predicted_probability", "double", "half"),
        ("day", "target_week_start_date", "date", "yesterday")]
    assert all(r["file"].endswith("scores.csv") for r in found)


def test_too_many_rejects_load_nothing(spark, tmp_path):
    path = score_file(tmp_path, GOOD, "bad,2020-02-17,weak-learner,x,half,0.25,1,")
    rejects = str(tmp_path / "rejects")
    with pytest.raises(readers.TooManyRejects, match="1 of 2"):
        readers.load_csv(spark, path, schemas.SCORES, rejects, most=0.49)
    assert spark.read.parquet(rejects).count() == 1


def test_texts_alone_never_fail(spark, tmp_path):
    path = score_file(tmp_path, GOOD)
    loaded = readers.load_csv(spark, path, schemas.MODIFIERS, str(tmp_path / "rejects"))
    assert loaded.n_rejects == 0 and loaded.rows.count() == 1
