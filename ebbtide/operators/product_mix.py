"""Audio product mix: live radio, podcasts, mixes and plain on-demand listening."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ebbtide.config import ID_SENTINELS, LISTENING_COARSE, LISTENING_DETAIL, ChurnConfig
from ebbtide.functions.exprs import (
    argmax_label, conditional_sum, distinct_days, exprs, plus, share, tleo_ladder)
from ebbtide.functions.skew import lookup_join, unique_by
from ebbtide.operators.activity import long_enough
from ebbtide.operators.cohorts import cohort_date

ID_LADDER = ("brand_id", "series_id", "episode_id", "clip_id")


def _mark(df: DataFrame, members: DataFrame, key: str, flag: str) -> DataFrame:
    """Adds ``flag``: is the key a member?"""
    known = members.select(key).where(F.col(key).isNotNull()).distinct().withColumn(
        flag, F.lit(True))
    return lookup_join(df, known, [key]).withColumn(flag, F.coalesce(flag, F.lit(False)))


def content_flags(catalogue: DataFrame, mixes_list: DataFrame, mix_exceptions: DataFrame,
                  cfg: ChurnConfig) -> DataFrame:
    """(version): the parts of the listening-type rules that depend on the catalogue only."""
    versions = unique_by(catalogue.select(
        "version_id", "episode_id", "format_names", "master_brand_id", "master_brand_name"),
        ["version_id"])
    podcast_episodes = catalogue.where(F.col("version_type") == "Podcast version")
    marked = _mark(versions, podcast_episodes, "episode_id", "_podcast_version")
    marked = _mark(marked, mixes_list, "episode_id", "_listed_mix")
    marked = _mark(marked, mix_exceptions, "episode_id", "_exception")
    podcast = F.coalesce((F.col("master_brand_id") == cfg.podcast_master_brand)
                         | F.col("format_names").contains("Podcast"), F.lit(False))
    mix_format = F.coalesce(F.col("format_names").contains("Mixes"), F.lit(False))
    brand = F.coalesce("master_brand_name", F.lit(""))
    return marked.select(
        "version_id",
        podcast.alias("_app_podcast"),
        (podcast | F.col("_podcast_version")).alias("_any_podcast"),
        (mix_format | F.col("_listed_mix")).alias("_any_mix"),
        ((brand == cfg.mixes_master_brand) | ((brand == cfg.radio_master_brand) & mix_format)
         | F.col("_exception")).alias("_app_mix"))


def listening_type(rows: DataFrame, catalogue: DataFrame, podcast_list: DataFrame,
                   mixes_list: DataFrame, mix_exceptions: DataFrame, cfg: ChurnConfig, *,
                   linear_mixes: bool = True) -> DataFrame:
    """Adds the flags and the first listening type whose rule matches.

    ``linear_mixes=False`` leaves the linear-mixes type empty, as the original rules do.
    """
    flagged = lookup_join(
        rows, content_flags(catalogue, mixes_list, mix_exceptions, cfg), ["version_id"])
    flagged = _mark(flagged, podcast_list, "tleo_id", "_scheduled")

    def flag(name: str) -> Column:
        return F.coalesce(F.col(name), F.lit(False))

    flagged = flagged.withColumns({
        "all_podcasts": flag("_any_podcast") | F.col("_scheduled"),
        "app_podcasts": flag("_app_podcast") | F.col("_scheduled"),
        "all_mixes": flag("_any_mix"),
        "app_mixes": flag("_app_mix"),
    })
    kind = (F.when(F.col("broadcast_type") == "Live", "live_radio")
            .when(F.col("app_podcasts"), "od_app_podcasts")
            .when(F.col("app_mixes"), "od_app_mixes")
            .when(F.col("all_podcasts"), "od_radio_podcasts"))
    if linear_mixes:
        kind = kind.when(F.col("all_mixes"), "od_linear_mixes")
    return flagged.withColumn("listening_type", kind.otherwise("od_radio")).select(
        *rows.columns, "all_podcasts", "app_podcasts", "all_mixes", "app_mixes",
        "listening_type")


def audio_listening(windowed: DataFrame, cfg: ChurnConfig) -> DataFrame:
    """(user, fresh, title, version, broadcast type): time and days with an event."""
    raw = [d for d, product in cfg.destinations.items() if product == "audio"]
    origin = cohort_date("min_date", cfg)
    rows = windowed.where(F.col("destination").isin(*raw) & (F.col("playback_time") > 0))
    return rows.withColumns({
        "tleo_id": tleo_ladder(ID_LADDER, ID_SENTINELS), "_origin": origin,
    }).groupBy("user_id", "fresh", "tleo_id", "version_id", "broadcast_type").agg(
        F.sum("playback_time").cast("double").alias("streaming_time"),
        distinct_days("date_of_event", "_origin",
                      long_enough(windowed, "is_event", cfg.event_seconds))
        .cast("double").alias("events"))


def preferred_listening(measure: str, *, detail: bool) -> str:
    """Label of the greatest share; ties go to the label listed first."""
    names = LISTENING_DETAIL if detail else [(n, label) for n, label, _ in LISTENING_COARSE]
    return argmax_label([(f"audio_prod_{n}_{measure}_perc", label) for n, label in names])


def product_mix(typed: DataFrame) -> DataFrame:
    """(user, fresh): 9 times, 9 event counts, 18 shares, 4 preferred labels."""
    measures = {"st": "streaming_time", "ev": "events"}
    sums = typed.groupBy("user_id", "fresh").agg(*exprs([
        *[f"sum({c}) AS _total_{m}" for m, c in measures.items()],
        *[conditional_sum(f"listening_type = '{n}'", c, "0.0D") + f" AS audio_prod_{m}_{n}"
          for m, c in measures.items() for n, _ in LISTENING_DETAIL]]))
    mixed = sums.selectExpr("*", *[
        plus(f"audio_prod_{m}_{p}" for p in parts) + f" AS audio_prod_{m}_{n}"
        for m in measures for n, _, parts in LISTENING_COARSE])
    names = [*[n for n, _ in LISTENING_DETAIL], *[n for n, _, _ in LISTENING_COARSE]]
    shares = mixed.selectExpr("*", *[
        share(f"audio_prod_{m}_{n}", f"_total_{m}") + f" AS audio_prod_{n}_{m}_perc"
        for m in measures for n in names])
    return shares.selectExpr("*", *[
        preferred_listening(m, detail=detail)
        + f" AS audio_prod_{m}_preferred_listening{'_detail' if detail else ''}"
        for m in measures for detail in (True, False)]).drop("_total_st", "_total_ev")
