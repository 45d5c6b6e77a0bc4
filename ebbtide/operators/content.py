"""Content: modal genre and brand, activating content, favourite content."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ebbtide.config import NULL_SENTINEL, ChurnConfig
from ebbtide.functions.exprs import distinct_days, tleo_ladder, tleo_level, weeks_between
from ebbtide.functions.skew import lookup_join, unique_by
from ebbtide.operators.activity import long_enough
from ebbtide.operators.cohorts import (
    cohort_date, expand_cohorts, fill_cohorts, only_cohort_users)

FAVOURITE_LADDER = ("brand_id", "series_id", "episode_id")


def episode_content(catalogue: DataFrame) -> DataFrame:
    """Distinct (episode, content): the brand, or the series where there is no brand."""
    content = F.when(F.col("brand_id") == "null", F.col("series_id")).otherwise(F.col("brand_id"))
    return catalogue.where(F.col("episode_id") != "null").select(
        "episode_id", content.alias("content_id")).distinct()


def simplified_brand(brand: Column, cfg: ChurnConfig) -> Column:
    return (F.when(brand.isin(*cfg.named_brands), brand)
            .when(F.lower(brand).contains("radio"), "Other Radio").otherwise("Other"))


def content_mode_genre(catalogue: DataFrame, cfg: ChurnConfig) -> DataFrame:
    """(content): most frequent first genre and master brand; ties go to the smaller name."""
    genre = F.split_part(F.col("genre_names"), F.lit(";"), F.lit(1))
    counts = catalogue.groupBy(
        "episode_id", genre.alias("genre"), F.col("master_brand_name").alias("masterbrand")
    ).agg(F.count(F.lit(1)).alias("n"))
    contents = episode_content(catalogue).where(F.col("content_id") != "null")
    per_content = counts.join(contents, "episode_id").groupBy(
        "content_id", "genre", "masterbrand").agg(F.sum("n").alias("n"))

    def mode(name: str) -> DataFrame:
        totals = per_content.groupBy("content_id", name).agg(F.sum("n").alias("n"))
        best = F.min(F.struct((-F.col("n")).alias("n"), name))[name]
        return totals.groupBy("content_id").agg(best.alias(name))

    return mode("genre").join(mode("masterbrand"), "content_id").withColumn(
        "brand_simplified", simplified_brand(F.col("masterbrand"), cfg))


def _latest_of_weeks(activations: DataFrame, key: str, cfg: ChurnConfig) -> DataFrame:
    """The rows that can be the latest of some cohort: the last of each week and user.

    Every cohort sees all weeks up to the last feature week of the oldest one, so of these only
    the latest row is left, before users are doubled into training and scoring.
    """
    oldest = cohort_date("last_week_start", cfg)
    return activations.withColumn("cohort", F.lit(cfg.n_cohorts - 1)).groupBy(
        "user_id", F.greatest("week_beginning", oldest).alias("_week")).agg(
        F.max(F.struct("week_beginning", key)).alias("_a")).select("user_id", "_a.*")


def activation_asof(activations: DataFrame, catalogue: DataFrame, contents: DataFrame,
                    factors: DataFrame, cfg: ChurnConfig, product: str,
                    cohorts: DataFrame | None = None) -> DataFrame:
    """(user, fresh): the latest activation up to the last feature week, with its content.

    Video activations name a version, audio activations an episode. ``contents``
    is the result of content_mode_genre.
    """
    key = "version_id" if product == "video" else "episode_id"
    start = cohort_date("last_week_start", cfg)
    seen = expand_cohorts(_latest_of_weeks(activations.where(
        (F.col("week_beginning") <= F.lit(cfg.window_max_date))
        & F.col("user_id").isNotNull()), key, cfg), cfg)
    latest = seen.where(F.col("week_beginning") <= start).groupBy("user_id", "fresh").agg(
        F.max(F.struct("week_beginning", key)).alias("_a"), F.max(start).alias("_start")).select(
        "user_id", "fresh", F.col("_a.week_beginning").alias("activation_week"),
        F.col(f"_a.{key}").alias(key),
        (weeks_between(F.col("_a.week_beginning"), F.col("_start")) + 1)
        .alias(f"{product}_weeks_since_activation"))

    episodes = unique_by(episode_content(catalogue), ["episode_id"])
    if product == "video":
        versions = unique_by(catalogue.select("version_id", "episode_id"), ["version_id"])
        dim = versions.join(episodes, "episode_id", "left")
    else:
        dim = episodes
    names = [f"f{i}" for i in range(cfg.factors[product])]
    described = contents.join(unique_by(factors, ["content_id"]), "content_id", "left")
    dim = dim.join(described, "content_id", "left")
    out = lookup_join(only_cohort_users(latest, cohorts), dim, [key]).select(
        "user_id", "fresh", "activation_week",
        F.col("episode_id").alias("activation_episode_id"),
        F.col("content_id").alias("activation_content_id"),
        *[F.col(n).alias(f"{product}_activ_{n}") for n in names],
        f"{product}_weeks_since_activation",
        F.col("genre").alias(f"{product}_activating_genre"),
        F.col("brand_simplified").alias(f"{product}_activating_masterbrand"))
    return fill_cohorts(out, cohorts)


def favourite_pick(windowed: DataFrame, cfg: ChurnConfig) -> DataFrame:
    """(user, fresh): per product the content used on most days; ties go to the smaller id."""
    content = F.coalesce(tleo_ladder(FAVOURITE_LADDER[:2], NULL_SENTINEL),
                         F.col(FAVOURITE_LADDER[2]))
    level = F.coalesce(tleo_level(FAVOURITE_LADDER[:2], NULL_SENTINEL),
                       F.lit(FAVOURITE_LADDER[2]))
    days = windowed.where(
        F.col("destination").isin(*cfg.destinations)
        & F.expr(long_enough(windowed, "is_event", cfg.event_seconds))).select(
        "user_id", "fresh", "destination", "date_of_event",
        cohort_date("min_date", cfg).alias("_origin"), content.alias("content_id"),
        level.alias("level")).where(F.col("content_id").isNotNull()).groupBy(
        "user_id", "fresh", "destination", "content_id", "level").agg(
        distinct_days("date_of_event", "_origin").alias("events"))
    picks = [F.expr(f"min(CASE WHEN destination = '{raw}' THEN "
                    f"struct(-events AS n, content_id, level) END) AS _{product}")
             for raw, product in cfg.destinations.items()]
    return days.groupBy("user_id", "fresh").agg(*picks).selectExpr("user_id", "fresh", *[
        f"_{p}.{c} AS {p}_fav_{name}" for p in cfg.destinations.values()
        for c, name in (("content_id", "content_id"), ("level", "content_level"))])


def favourite_content(picked: DataFrame, contents: DataFrame, factors: DataFrame,
                      cfg: ChurnConfig, product: str) -> DataFrame:
    """Adds genre, brand and factors of the product's favourite content."""
    key = f"{product}_fav_content_id"
    described = contents.drop("masterbrand").join(
        unique_by(factors, ["content_id"]), "content_id", "full").selectExpr(
        f"content_id AS {key}", f"genre AS {product}_fav_content_genre",
        f"brand_simplified AS {product}_fav_content_masterbrand",
        *[f"f{i} AS {product}_fav_f{i}" for i in range(cfg.factors[product])])
    return lookup_join(picked, described, [key])
