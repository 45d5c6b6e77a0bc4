"""Genre affinity, release schedule and how well the two match."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ebbtide.config import FEATURE_WEEKS, GENRES, TITLE_SENTINELS, ChurnConfig
from ebbtide.functions.exprs import exprs, plus, share, tleo_ladder, week_of
from ebbtide.operators.activity import genre_conditional_sums
from ebbtide.operators.cohorts import cohort_date, expand_cohorts
from ebbtide.operators.target import KEY, effective_week

NAMES = [*[g[0] for g in GENRES], "other"]
RELEASES = [*[g[2] for g in GENRES], "other"]
TITLES = ("brand_title", "series_title", "programme_title", "episode_title",
          "presentation_title", "clip_title")


def genre_affinity(weekly: DataFrame, cfg: ChurnConfig, *, floor: int | None = None) -> DataFrame:
    """(user, product, cohort, fresh): 13-week totals, genre shares, genres touched.

    ``floor`` is the first effective week counted; a low value lets the target
    weeks of training rows in.
    """
    floor = cfg.genre_week_floor if floor is None else floor
    sums = ["streaming_time", "page_views", *[f"genre_st_{n}" for n in NAMES]]
    rows = expand_cohorts(weekly.where(F.col("destination") != "radio"), cfg)
    totals = rows.where(effective_week(cfg).between(floor, FEATURE_WEEKS[-1])).groupBy(*KEY).agg(
        F.sum("events").alias("events"), F.sum("distinct_days").alias("distinct_days"),
        *exprs(f"sum({c}) AS {c}" for c in sums))
    watched = {n: f"CAST(genre_st_{n} > 0 AS INT)" for n in NAMES}
    return totals.selectExpr(
        "*", *[f"{share(f'genre_st_{n}', 'streaming_time')} AS genre_share_{n}" for n in NAMES],
        *[f"{w} AS genre_watch_{n}" for n, w in watched.items()],
        f"{plus(watched.values())} AS genre_distinct_count")


def genre_schedule(catalogue: DataFrame) -> DataFrame:
    """(product, week): number of titles released per genre."""
    shown = F.try_to_date("tx_date", "yyyy-MM-dd")
    product = (F.when(F.col("media_type") == "video", "video")
               .when(F.col("media_type") == "audio", "audio"))
    programmes = catalogue.where(shown >= "1970-01-01").select(
        product.alias("destination"), "media_type",
        tleo_ladder(TITLES, TITLE_SENTINELS).alias("tleo"),
        week_of(shown).alias("week"), "genre_names").distinct()
    known = plus(f"releases_{n}" for n in RELEASES[:-1])
    return programmes.groupBy("destination", "week").agg(
        *genre_conditional_sums("genre_names", "1", names="releases_{}", suffix=2),
        F.count(F.lit(1)).cast("double").alias("_all"),
    ).withColumn("releases_other", F.expr(f"_all - {known}")).drop("_all")


def schedule_moving_average(schedule: DataFrame, cfg: ChurnConfig, *, rows: int = 13) -> DataFrame:
    """Releases divided by their moving average; the table has one row per product and week."""
    recent = (f"OVER (PARTITION BY destination ORDER BY week "
              f"ROWS BETWEEN {rows - 1} PRECEDING AND CURRENT ROW)")
    averages = schedule.where(F.col("week") >= F.lit(cfg.schedule_since)).selectExpr(
        "*", *[f"avg(releases_{n}) {recent} AS _{n}" for n in RELEASES])
    return averages.selectExpr("destination", "week", *[
        f"CASE WHEN _{n} = 0 THEN 1.0D ELSE try_divide(releases_{n}, _{n}) END "
        f"AS scaled_releases_{n}" for n in RELEASES])


def schedule_match_index(affinity: DataFrame, schedule: DataFrame, scaled: DataFrame,
                         cfg: ChurnConfig) -> DataFrame:
    """Affinity with the schedule of the target week and the match of the two.

    The schedule holds at most one row per product and calendar week, so it is
    broadcast.
    """
    weeks = schedule.join(scaled, ["destination", "week"], "left")
    joined = affinity.withColumn(
        "week", cohort_date("max_week", cfg)).join(
        F.broadcast(weeks), ["destination", "week"], "left").drop("week")
    match = {n: f"(scaled_releases_{r} - 1) * genre_share_{n}"
             for n, r in zip(NAMES[:-1], RELEASES[:-1])}
    return joined.selectExpr(
        "*", *[f"{m} AS sched_match_index_{n}" for n, m in match.items()],
        f"{plus(match.values())} AS sched_match_index")
