"""Feature set: tables travel packed through the joins, shared sources are read once."""

from datetime import date, datetime

from ebbtide.operators import content, quality
from ebbtide.plans import feature_set
from ebbtide.plans.feature_set import Blocks
from ebbtide.sources import schemas
from ebbtide.sources.sample_tables import CONFIG


def test_joins_carry_one_column_per_table(spark):
    people = spark.createDataFrame([(1, 0, "a", 5), (2, 0, None, 6), (3, 0, "c", 7)],
                                   "user_id long, fresh int, name string, unused int")
    base = spark.createDataFrame([(1, 0, 1.5), (2, 0, None), (4, 0, 2.5)],
                                 "user_id long, fresh int, time double")
    wide = spark.createDataFrame([(2, 0, *range(40))], "user_id long, fresh int, " + ", ".join(
        f"c{i} int" for i in range(40)))
    out = feature_set.join_packed([base, people], [wide], [
        "user_id", "fresh", "name", "time * 2 AS twice",
        *[f"coalesce(c{i}, -1) AS c{i}" for i in range(40)]])
    rows = {r["user_id"]: r for r in out.collect()}
    assert sorted(rows) == [1, 2]
    assert (rows[1]["name"], rows[1]["twice"], rows[1]["c39"]) == ("a", 3.0, -1)
    assert (rows[2]["name"], rows[2]["twice"], rows[2]["c39"]) == (None, None, 39)
    plan = out._jdf.queryExecution().optimizedPlan()
    joins = [node for node in _nodes(plan) if node.nodeName() == "Join"]
    assert len(joins) == 2
    assert max(node.output().size() for node in joins) <= 7


def _nodes(plan):
    yield plan
    children = plan.children()
    for i in range(children.size()):
        yield from _nodes(children.apply(i))


def test_counting_nulls_leaves_tables_packed(spark):
    """Columns behind a default are not read, which must not unpack the others below the joins."""
    base = spark.createDataFrame([(1, 0, 1.5, None), (2, 0, None, 4), (4, 0, 2.5, 3)],
                                 "user_id long, fresh int, time double, n int")
    people = spark.createDataFrame([(1, 0, "a", None), (2, 0, None, "x"), (3, 0, "c", "y")],
                                   "user_id long, fresh int, name string, place string")
    types = "user_id long, fresh int, " + ", ".join(f"c{i} int" for i in range(40))
    wide = spark.createDataFrame([(2, 0, None, *range(39))], types)
    out = feature_set.join_packed([base, people], [wide], [
        "user_id", "fresh", "name", "coalesce(place, 'none') AS place", "time", "0 * n AS n",
        *[f"c{i}" for i in range(20)], *[f"coalesce(c{i}, -1) AS c{i}" for i in range(20, 40)]])
    counts = quality.na_counts(out)
    found = {r["column_name"]: r["n_null"] for r in counts.collect()}
    assert found == {"user_id": 0, "fresh": 0, "name": 1, "place": 0, "time": 1, "n": 1,
                     "c0": 2, **{f"c{i}": 1 if i < 20 else 0 for i in range(1, 40)}}
    assert {r["user_id"]: (r["place"], r["c39"]) for r in out.collect()} == {
        1: ("none", -1), 2: ("x", 38)}
    joins = [node for node in _nodes(counts._jdf.queryExecution().optimizedPlan())
             if node.nodeName() == "Join"]
    assert len(joins) == 2
    assert max(node.output().size() for node in joins) <= 9


class Counted:
    """Sources that count how often a table is asked for."""

    def __init__(self, **tables):
        self.tables, self.asked = tables, []

    def __getattr__(self, name):
        self.asked.append(name)
        return self.tables[name]


def test_activity_and_catalogue_are_read_once(spark, make):
    day = date(2001, 7, 2)
    activity = make(schemas.SOURCES["activity"], {
        "user_id": "7", "destination": "AUDIO_APP", "app_name": "A", "date_of_event": day,
        "event_ts": datetime(2001, 7, 2, 9), "version_id": "v1", "episode_id": "e1",
        "playback_time": 300, "page_views": 1})
    catalogue = make(schemas.SOURCES["catalogue"], {
        "version_id": "v1", "episode_id": "e1", "brand_id": "b", "series_id": "s",
        "genre_names": "Drama", "content_kind": "episode"})
    sources = Counted(activity=activity, catalogue=catalogue)
    blocks = Blocks(sources, CONFIG, stage=True)
    assert blocks.weekly.count() == 1
    assert blocks.daily.count() == 1
    assert blocks.contents.count() == 1
    assert blocks.series_schedule.count() == 1
    blocks.schedule.count()
    assert sorted(sources.asked) == ["activity", "catalogue"]


def test_latest_activation_of_every_cohort(spark, make):
    """Only the last row of a week is doubled, and the weeks before the oldest cohort are one."""
    weeks = [date(2000, 1, 3), date(2001, 5, 28), date(2001, 6, 11), date(2001, 7, 16)]
    rows = [{"user_id": str(u), "week_beginning": w, "episode_id": e}
            for u in range(40) for w in weeks for e in ("e1", "e2")]
    rows += [{"user_id": "1", "week_beginning": weeks[0], "episode_id": None}]
    activations = make(schemas.AUDIO_ACTIVATIONS, *rows)
    kept = content._latest_of_weeks(activations, "episode_id", CONFIG)
    assert kept.count() < 40 * len(weeks) + 1
    catalogue = make(schemas.SOURCES["catalogue"], {
        "version_id": "v1", "episode_id": "e2", "brand_id": "b", "series_id": "s"})
    contents = spark.createDataFrame(
        [], "content_id string, genre string, masterbrand string, brand_simplified string")
    factors = spark.createDataFrame([], "content_id string, " + ", ".join(
        f"f{i} double" for i in range(20)))
    out = content.activation_asof(activations, catalogue, contents, factors, CONFIG, "audio")
    found = {(r["user_id"], r["fresh"]): r for r in out.collect()}
    assert len(found) == 80
    for (user, fresh), r in found.items():
        assert r["activation_episode_id"] == "e2"
        since = r["audio_weeks_since_activation"] - 1
        cut = r["activation_week"].toordinal() + 7 * since
        assert r["activation_week"] == max(w for w in weeks if w.toordinal() <= cut)
        assert fresh == 0 or r["activation_week"] == weeks[3]
