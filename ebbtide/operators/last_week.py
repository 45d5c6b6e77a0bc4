"""Series watched in the last feature week: titles, episodes, premieres, finales, repeats."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ebbtide.config import ID_SENTINELS, TITLE_SENTINELS, ChurnConfig
from ebbtide.functions.exprs import clean, distinct_days, tleo_ladder
from ebbtide.functions.skew import lookup_join, rank_by_range, unique_by
from ebbtide.operators.activity import (
    destination_product, long_enough, windowed_activity)
from ebbtide.operators.cohorts import cohort_date
from ebbtide.operators.genre import TITLES

# Where undated broadcasts sort.
NO_DATE = "2099-01-01"
NO_TIME = "99:99:99"
ID = ["user_id", "fresh", "destination"]


def series_schedule(catalogue: DataFrame) -> DataFrame:
    """(series, episode): first broadcast and number of the episode in its series.

    Episodes without a series are left out; they would form one huge group.
    """
    day = F.coalesce(F.try_to_date("tx_date", "yyyy-MM-dd"), F.lit(NO_DATE).cast("date"))
    time = F.coalesce(clean(F.col("tx_start"), ["null"]), F.lit(NO_TIME))
    episodes = catalogue.where(
        (F.col("content_kind") == "episode") & ~F.col("series_id").isin(*ID_SENTINELS)
        & F.col("episode_id").isNotNull())
    first = episodes.groupBy("series_id", "episode_id").agg(F.min(F.struct(
        day.alias("day"), time.alias("time"), "version_id", "programme_title",
        "programme_duration", "episode_title",
        F.split_part("genre_list", F.lit(";"), F.lit(1)).alias("genre"),
        F.split_part("genre_list", F.lit(";"), F.lit(2)).alias("subgenre"))).alias("_f")).select(
        "series_id", "episode_id", "_f.*")
    numbered = rank_by_range(
        first, ["series_id"], [F.col("day"), F.col("time"), F.col("episode_id")],
        alias="episode_number")
    return numbered.select(
        "episode_id", F.col("version_id").alias("version_id_first_broadcast"), "series_id",
        "programme_title", "programme_duration", "episode_title", "genre", "subgenre",
        F.when(F.col("day") != F.lit(NO_DATE).cast("date"), F.col("day")).alias("tx_date"),
        F.when(F.col("time") == NO_TIME, "null").otherwise(F.col("time")).alias("tx_start"),
        F.col("episode_number").cast("bigint"))


def series_finales(schedule: DataFrame) -> DataFrame:
    """(series, episode): length of the series, premiere and finale flags."""
    lengths = schedule.groupBy("series_id").agg(F.max("episode_number").alias("eps_in_series"))
    number = F.col("episode_number")
    return lookup_join(schedule.select("episode_id", "series_id", "episode_number"), lengths,
                       ["series_id"]).withColumns({
                           "series_premiere": (number == 1).cast("int"),
                           "series_finale": (number == F.col("eps_in_series")).cast("int")})


def lastweek_views(activity: DataFrame, cfg: ChurnConfig) -> DataFrame:
    """(user, fresh, destination, product, version): days watched in the last feature week."""
    rows = windowed_activity(
        activity.where(long_enough(activity, "is_view", cfg.last_week_seconds)), cfg,
        start="last_week_start")
    start = cohort_date("last_week_start", cfg)
    raw = F.col("destination")
    product = F
    for name, value in cfg.destinations.items():
        product = product.when(raw == name, value)
    return rows.select(
        "user_id", "fresh", product.alias("destination"),
        destination_product(cfg).alias("product"), "version_id", "date_of_event",
        start.alias("_origin")).groupBy(*ID, "product", "version_id").agg(
        distinct_days("date_of_event", "_origin", span=7).alias("events"))


def _version_titles(catalogue: DataFrame) -> DataFrame:
    return unique_by(catalogue.select(
        "version_id", "episode_id", tleo_ladder(TITLES, TITLE_SENTINELS).alias("tleo")),
        ["version_id"])


def lastweek_series(views: DataFrame, catalogue: DataFrame, finales: DataFrame) -> DataFrame:
    """(user, fresh, destination): distinct titles and episodes, premieres, finales."""
    per_episode = finales.groupBy("episode_id").agg(
        F.sum("series_premiere").alias("premieres"), F.sum("series_finale").alias("finales"))
    dim = _version_titles(catalogue).join(per_episode, "episode_id", "left")
    seen = lookup_join(views.where(F.col("product") != "radio"), dim, ["version_id"])
    return seen.groupBy(*ID).agg(
        F.countDistinct("tleo").alias("distinct_series"),
        F.countDistinct("episode_id").alias("distinct_episodes"),
        F.coalesce(F.sum("premieres"), F.lit(0)).alias("series_premieres"),
        F.coalesce(F.sum("finales"), F.lit(0)).alias("series_finales"))


def lastweek_repeats(views: DataFrame, catalogue: DataFrame) -> DataFrame:
    """(user, fresh, destination): mean days per episode; unknown episodes count as one of 0."""
    episodes = unique_by(catalogue.select("version_id", "episode_id"), ["version_id"])
    per_episode = lookup_join(views, episodes, ["version_id"]).groupBy(*ID, "episode_id").agg(
        F.sum(F.when(F.col("episode_id").isNotNull(), F.col("events")).otherwise(F.lit(0)))
        .cast("double").alias("repeats"))
    return per_episode.groupBy(*ID).agg(F.avg("repeats").alias("avg_episode_repeats"))


def lastweek_features(series: DataFrame, repeats: DataFrame) -> DataFrame:
    return series.join(repeats, ID, "left").withColumn(
        "watched_finale_flag", (F.col("series_finales") > 0).cast("int"))
