"""The distributed helpers against brute force, with one key holding most of the rows."""

import os
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from ebbtide.functions import skew
from ebbtide.functions.exprs import hash_number
from ebbtide.ml.metrics import median_by, mode_by
from ebbtide.operators.profile import dedupe_anti_join
from ebbtide.operators.sampling import random_sample_n, stratified_folds

RNG = random.Random(5)


@pytest.fixture(scope="module")
def hot(spark):
    """2,000 rows; half belong to one group and many share a value."""
    rows = [(i, "hot" if i % 2 else f"g{i % 7}", RNG.choice([0.5, RNG.random()]))
            for i in range(2000)]
    return spark.createDataFrame(rows, "id long, grp string, x double"), rows


def test_lookup_join_keeps_every_row(spark, hot):
    df, rows = hot
    dim = spark.createDataFrame([("hot", 1), ("g0", 2), ("g2", 3)], "grp string, v int")
    plan = skew.lookup_join(df, dim, ["grp"])
    known = {"hot": 1, "g0": 2, "g2": 3}
    assert sorted((r.id, r.v or 0) for r in plan.collect()) == sorted(
        (i, known.get(g, 0)) for i, g, _ in rows)
    assert "Generate" not in plan._jdf.queryExecution().optimizedPlan().toString()


def test_groups_and_labels_that_are_null_stay(spark):
    rows = [(i, None if i % 4 == 0 else i % 2, float(i)) for i in range(100)]
    df = spark.createDataFrame(rows, "user_id int, label int, x double")
    folds = stratified_folds(df, "label", 5, "user_id")
    assert folds.count() == 100
    sizes = Counter((r.label, r.fold) for r in folds.collect())
    assert all(sizes[None, f] == 5 for f in range(5))
    by_range = skew.rank_by_range(df, ["label"], [F.col("x")])
    assert sorted(r["rank"] for r in by_range.where("label is null").collect()) == list(
        range(1, 26))
    medians = {r.label: r.median for r in median_by(df, ["label"], "x").collect()}
    assert medians[None] == 48.0 and len(medians) == 3


def test_staged_tables_go_at_the_end_of_a_block(spark):
    with skew.staged_tables(spark):
        stored = skew.stable(spark.range(3))
        folder = stored.inputFiles()[0].rsplit("/", 1)[0].removeprefix("file:")
        assert os.path.isdir(folder) or os.path.isdir(folder.removeprefix("//"))
    assert not os.path.isdir(folder.removeprefix("//"))


@pytest.mark.parametrize("at_most", [None, 40])
def test_rank_by_hash(hot, at_most):
    df, rows = hot
    out = skew.rank_by_hash(df, hash_number("id", "s"), ["grp"], F.col("id"), at_most=at_most)
    got = defaultdict(list)
    for r in out.select("grp", "rank", "id", hash_number("id", "s").alias("h")).collect():
        got[r.grp].append((r.h, r.id, r["rank"]))
    sizes = Counter(g for _, g, _ in rows)
    assert set(got) == set(sizes)
    for group, items in got.items():
        items.sort()
        assert len(items) == min(sizes[group], at_most or sizes[group])
        assert [rank for _, _, rank in items] == list(range(1, len(items) + 1))


def test_rank_by_range(hot):
    df, rows = hot
    out = skew.rank_by_range(df, ["grp"], [F.col("x"), F.col("id")]).collect()
    want = {}
    for group in {g for _, g, _ in rows}:
        ordered = sorted((x, i) for i, g, x in rows if g == group)
        want |= {i: n + 1 for n, (_, i) in enumerate(ordered)}
    assert {r.id: r["rank"] for r in out} == want


@pytest.mark.parametrize("groups, descending", [(["grp"], False), (["grp"], True), ([], True)])
def test_running_totals(hot, groups, descending):
    df, rows = hot
    counts = df.groupBy(*groups, "x").agg(F.count("*").alias("n"))
    out = skew.running_totals(counts, groups, "x", ["n"], descending=descending).collect()
    for r in out:
        mine = [x for _, g, x in rows if not groups or g == r.grp]
        want = sum(x >= r.x if descending else x <= r.x for x in mine)
        assert (r.cum_n, r.total_n) == (want, len(mine))


def test_median_and_mode(hot):
    df, rows = hot
    import statistics
    got = {r.grp: r["median"] for r in median_by(df, ["grp"], "x").collect()}
    for group, value in got.items():
        assert value == pytest.approx(statistics.median(x for _, g, x in rows if g == group))
    assert {r["mode"] for r in mode_by(df, ["grp"], "x").collect()} == {0.5}
    even = df.where("id < 2").select(F.lit("a").alias("grp"), F.col("id").cast("double").alias("x"))
    assert median_by(even, ["grp"], "x").first()["median"] == 0.5


def test_sample_is_exact_and_repeatable(hot):
    df, _ = hot
    a = {r.id for r in random_sample_n(df, 300, "id", "x").collect()}
    b = {r.id for r in random_sample_n(df.repartition(7), 300, "id", "x").collect()}
    assert len(a) == 300 and a == b
    assert random_sample_n(df, 10_000, "id", "x").count() == 2000
    assert a != {r.id for r in random_sample_n(df, 300, "id", "y").collect()}


def test_folds(spark):
    df = spark.range(100).withColumn("y", (F.col("id") < 23).cast("int"))
    out = stratified_folds(df, "y", 10, "id").groupBy("fold").agg(
        F.sum("y").alias("up"), F.count("*").alias("n")).collect()
    assert len(out) == 10 and sum(r.n for r in out) == 100
    assert {r.up for r in out} <= {2, 3} and {r.n - r.up for r in out} <= {7, 8}


def test_only_unique_keys_stay(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2), ("b", 2), ("c", None)], "k string, v int")
    assert sorted(map(tuple, dedupe_anti_join(df, ["k"]).collect())) == [("a", 1), ("c", None)]


def test_unique_by_picks_the_smallest(spark):
    df = spark.createDataFrame([("a", 2), ("a", 1), ("b", 5)], "k string, v int")
    assert sorted(map(tuple, skew.unique_by(df, ["k"]).collect())) == [("a", 1), ("b", 5)]


def test_checkpoints_go_to_the_named_folder(spark):
    folder = spark.conf.get("spark.checkpoint.dir")
    assert skew.checkpoint_folder(spark) == folder
    stored = skew.stable(spark.range(5))
    assert stored.count() == 5 and folder in stored.inputFiles()[0]
