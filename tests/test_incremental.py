"""The weekly state against roll-ups of everything, and what its runs read."""

from dataclasses import replace
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from ebbtide.config import ChurnConfig
from ebbtide.operators import activity
from ebbtide.plans.feature_set import Blocks
from ebbtide.plans.incremental import WeeklyState, days_of, monday, runs_of
from ebbtide.sources import schemas

CFG = ChurnConfig(max_date=date(2020, 2, 23))
KEYS = ["user_id", "destination", "week"]


@pytest.fixture(scope="module")
def rows(make):
    out = []
    for i in range(1500):
        day = CFG.max_date - timedelta(days=i * 7919 % 200)
        out.append({
            "user_id": None if i % 50 == 0 else f"u{i % 17}", "date_of_event": day,
            "destination": ("VIDEO_APP", "AUDIO_APP", "OTHER")[i % 3], "app_name": "X",
            "event_ts": datetime(day.year, day.month, day.day, i % 24), "version_id": f"v{i % 5}",
            "genre_names": ("Drama", "News;Factual", None)[i % 3], "page_views": i % 4,
            "playback_time": None if i % 11 == 0 else i % 900})
    return make(schemas.ACTIVITY, *out)


def same(left, right):
    columns = sorted(left.columns)
    assert columns == sorted(right.columns)
    left, right = (sorted(map(str, df.select(columns).collect())) for df in (left, right))
    assert left == right and left


def full(rows, cfg):
    scan = activity.activity_scan(rows, cfg)
    return activity.activity_weekly_rollup(scan, cfg), activity.daily_activity(rows, cfg)


def test_runs_of_weeks():
    weeks = [date(2020, 1, 6), date(2020, 1, 13), date(2020, 2, 3)]
    assert runs_of(weeks) == [(weeks[0], weeks[1]), (weeks[2], weeks[2])]
    assert runs_of([]) == []


def test_a_further_week_reads_only_that_week(rows, spark, tmp_path):
    stored = str(tmp_path / "activity")
    rows.write.partitionBy("date_of_event").parquet(stored)
    source = spark.read.schema(schemas.ACTIVITY).parquet(stored)
    root = str(tmp_path / "state")
    before = replace(CFG, max_date=CFG.max_date - timedelta(days=7))
    state = WeeklyState(spark, root, before)
    assert len(state.update(source)) == 24
    same(state.weekly(source), full(rows, before)[0])
    assert state.update(source) == []

    state = WeeklyState(spark, root, CFG)
    newest = monday(CFG.max_date)
    # rows that were read before do not count any more: only the new week is looked at
    moved = source.withColumn("page_views", F.when(
        F.col("date_of_event") >= F.lit(newest), F.col("page_views")).otherwise(-1000))
    assert state.update(moved) == [newest]
    assert newest in state.done and len(state.done) == 24
    weekly, daily = full(rows, CFG)
    same(state.weekly(source), weekly)
    same(state.daily(source), daily)
    plan = source.where(days_of([newest]))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date_of_event" in plan


def test_a_correction_replaces_its_week(rows, spark, tmp_path):
    state = WeeklyState(spark, str(tmp_path / "state"), CFG, keep=1)
    late = CFG.max_date - timedelta(days=30)
    state.update(rows.where(F.col("date_of_event") != F.lit(late)))
    assert state.update(rows, [late]) == [monday(late)]
    weekly, daily = full(rows, CFG)
    same(state.weekly(rows), weekly)
    same(state.daily(rows), daily)
    assert len(set(state.done.values())) == 2
    for _ in range(2):
        state.update(rows, state.wanted)
    assert len(list((tmp_path / "state" / "parts").iterdir())) == 1


def test_a_failed_run_changes_nothing(rows, spark, tmp_path):
    state = WeeklyState(spark, str(tmp_path / "state"), CFG)
    state.update(rows)
    known = state.done
    bad = rows.withColumn("page_views", F.raise_error(F.lit("lost")).cast("bigint"))
    with pytest.raises(Exception, match="lost"):
        state.update(bad, [CFG.max_date])
    assert state.done == known
    same(state.weekly(rows), full(rows, CFG)[0])


def test_blocks_read_the_state(rows, spark, tmp_path):
    class Source:
        activity = rows

    state = WeeklyState(spark, str(tmp_path / "state"), CFG)
    state.update(rows)
    kept, plain = Blocks(Source, CFG, state=state), Blocks(Source, CFG)
    same(kept.pivot, plain.pivot)
    same(kept.device_usage, plain.device_usage)
