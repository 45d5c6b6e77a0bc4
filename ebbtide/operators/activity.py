"""Activity: scan, product of a row, weekly roll-up, windowed rows."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta

from pyspark.sql import Column, DataFrame, functions as F

from ebbtide.config import GENRES, ChurnConfig
from ebbtide.functions.exprs import conditional_sum, distinct_days, plus, week_of
from ebbtide.operators.cohorts import within_window


def activity_scan(activity: DataFrame, cfg: ChurnConfig) -> DataFrame:
    """Rows of the wanted products inside the extract; both filters reach the scan."""
    return activity.where(
        F.col("destination").isin(*cfg.destinations)
        & F.col("date_of_event").between(F.lit(cfg.extract_min_date), F.lit(cfg.max_date))
        & F.col("user_id").isNotNull())


def destination_product(cfg: ChurnConfig, destination: str = "destination",
                        app_name: str = "app_name") -> Column:
    """video, audio or radio; the rules come from the configuration."""
    dest, app = F.col(destination), F.col(app_name)
    out = F
    for raw, apps in cfg.radio_app_names.items():
        out = out.when((dest == raw) & app.isin(*apps), "radio")
    for raw, product in cfg.destinations.items():
        out = out.when(dest == raw, product)
    return out


def genre_conditional_sums(genre: str, measure: str, *, names: str = "genre_st_{}",
                           suffix: int = 0) -> list[Column]:
    """One sum per genre prefix. ``suffix`` 0 or 2 picks the column of GENRES used in names."""
    return [F.expr(f"CAST({conditional_sum(f'startswith({genre}, {prefix!r})', measure)} "
                   "AS DOUBLE)").alias(names.format((short, prefix, plural)[suffix]))
            for short, prefix, plural in GENRES]


def activity_weekly_rollup(scan: DataFrame, cfg: ChurnConfig,
                           further: Sequence[str] = ()) -> DataFrame:
    """(user, product, week): events, time, days, page views, time per genre.

    ``further`` columns of scan tell more rows apart.
    """
    week = week_of(F.col("date_of_event"))
    rows = scan.select(
        "user_id", destination_product(cfg).alias("destination"), week.alias("week"),
        "date_of_event", "genre_names", "playback_time", "page_views", *further)
    known = plus(f"genre_st_{g[0]}" for g in GENRES)
    return rows.groupBy("user_id", "destination", "week", *further).agg(
        F.count(F.lit(1)).alias("events"),
        F.sum("playback_time").cast("double").alias("streaming_time"),
        distinct_days("date_of_event", "week", span=7).alias("distinct_days"),
        F.sum("page_views").cast("double").alias("page_views"),
        *genre_conditional_sums("genre_names", "playback_time"),
    ).withColumn("genre_st_other", F.expr(f"streaming_time - {known}"))


def weekly_parts(scan: DataFrame, cfg: ChurnConfig) -> DataFrame:
    """(user, product, week, is_sunday): the weekly sums of a week's last day and of the others.

    The extract may begin on a Sunday, so the two are kept apart.
    """
    rows = scan.select("*", (F.weekday("date_of_event") == 6).alias("is_sunday"))
    parts = activity_weekly_rollup(rows, cfg, ("is_sunday",))
    return parts.drop("genre_st_other")


def weekly_of_parts(parts: DataFrame) -> DataFrame:
    """The weekly roll-up; all of its columns but one add up over the days of a week."""
    sums = [c for c in parts.columns if c not in ("user_id", "destination", "week", "is_sunday")]
    known = plus(f"genre_st_{g[0]}" for g in GENRES)
    return parts.groupBy("user_id", "destination", "week").agg(
        *[F.sum(c).alias(c) for c in sums]).withColumn(
        "genre_st_other", F.expr(f"streaming_time - {known}"))


#: What tells rows of the daily roll-up apart, besides the thresholds they pass.
DAILY_KEYS = ("user_id", "destination", "app_name", "date_of_event", "version_id", "episode_id",
              "series_id", "brand_id", "clip_id", "broadcast_type", "device_type",
              "browser_brand")


def daily_activity(activity: DataFrame, cfg: ChurnConfig) -> DataFrame:
    """One row per user, day, hour, title and device: the time played, for all windowed blocks.

    Each block asks of a row whether it is long enough, so rows are added up only with rows that
    pass the same thresholds: is_event, is_view (of the last week) and is_played. Written once,
    it takes the place of the raw rows, before users are doubled into training and scoring.
    """
    after = cfg.window_max_date + timedelta(days=1)
    rows = activity.where(
        F.col("destination").isin(*cfg.destinations) & F.col("user_id").isNotNull()
        & (F.col("date_of_event") >= F.lit(cfg.window_min_date))
        & (F.col("date_of_event") < F.lit(after)))
    return daily_rollup(rows, cfg)


def daily_rollup(rows: DataFrame, cfg: ChurnConfig) -> DataFrame:
    time = F.coalesce("playback_time", F.lit(0))
    return rows.groupBy(
        *DAILY_KEYS, F.date_trunc("hour", "event_ts").alias("event_ts"),
        (time >= cfg.event_seconds).alias("is_event"),
        (time >= cfg.last_week_seconds).alias("is_view"),
        (time > 0).alias("is_played")).agg(F.sum("playback_time").alias("playback_time"))


def long_enough(df: DataFrame, flag: str, seconds: int) -> str:
    """Condition on one row of activity, or on one row of the daily roll-up."""
    return flag if flag in df.columns else f"playback_time >= {seconds}"


def windowed_activity(activity: DataFrame, cfg: ChurnConfig, *, start: str = "min_date",
                      min_playback: int | None = None) -> DataFrame:
    """Activity rows inside each cohort's feature window, once per (user, fresh) role."""
    rows = activity.where(F.col("destination").isin(*cfg.destinations))
    if min_playback is not None:
        rows = rows.where(F.col("playback_time") >= min_playback)
    return within_window(rows, cfg, "date_of_event", start=start)
