"""Registered queries of the feature operators, run over the test tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ebbtide.config import ID_SENTINELS
from ebbtide.functions.exprs import tleo_ladder, tleo_level
from ebbtide.operators import (
    activity, cohorts, content, dashboard, devices, profile, quality, sampling, target)
from ebbtide.operators.product_mix import ID_LADDER
from ebbtide.plans.feature_set import Blocks
from ebbtide.plans.incremental import WeeklyState
from ebbtide.sources import sinks
from ebbtide.sources.sample_tables import CONFIG, SampleTables

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def register(function: Callable[[Blocks], DataFrame]) -> Callable[[Blocks], DataFrame]:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        stage = function.__name__.startswith("feature_set")
        return presented(function(Blocks(SampleTables(spark, folder), CONFIG, stage=stage)))

    QUERIES[function.__name__.removesuffix("_query")] = run
    return function


def presented(df: DataFrame) -> DataFrame:
    """Days as text, fractions rounded to six places, flags as numbers."""
    columns = []
    for f in df.schema:
        c = f"`{f.name}`"
        if isinstance(f.dataType, (T.DateType, T.TimestampType)):
            c = f"CAST({c} AS STRING)"
        elif isinstance(f.dataType, T.DoubleType):
            c = f"CASE WHEN abs({c}) < 0.0000005D THEN 0.0D ELSE round({c}, 6) END"
        elif isinstance(f.dataType, T.BooleanType):
            c = f"CAST({c} AS INT)"
        columns.append(f"{c} AS `{f.name}`")
    return df.selectExpr(*columns)


@register
def activity_scan(b: Blocks) -> DataFrame:
    return b.scan.withColumn("hour_of_event", F.hour("event_ts")).drop("page_name", "event_ts")


@register
def destination_product(b: Blocks) -> DataFrame:
    return b.sources.activity.groupBy(
        "destination", "app_name", activity.destination_product(b.cfg).alias("product")).agg(
        F.count(F.lit(1)).alias("n"))


@register
def activity_weekly_rollup(b: Blocks) -> DataFrame:
    return b.weekly


@register
def weekly_incremental(b: Blocks) -> DataFrame:
    """The weekly roll-up from three runs: all but two weeks, one more, the last with a
    correction."""
    spark, source = b.sources.spark, b.sources.activity
    root, newest = sinks.scratch(spark, "weekly-state"), CONFIG.max_date
    for weeks_ago, late in ((2, ()), (1, ()), (0, (newest - timedelta(days=21),))):
        cfg = replace(CONFIG, max_date=newest - timedelta(days=7 * weeks_ago))
        # the rows that the correction brings are missing before
        known = source if late else source.where(
            (F.col("date_of_event") != F.lit(newest - timedelta(days=21)))
            | (F.col("page_views") > 3))
        state = WeeklyState(spark, root, cfg)
        state.update(known, late)
    return state.weekly(source)


@register
def genre_conditional_sums(b: Blocks) -> DataFrame:
    return b.sources.activity.groupBy("device_type").agg(
        *activity.genre_conditional_sums("genre_names", "playback_time"))


@register
def cohort_dates(b: Blocks) -> DataFrame:
    return cohorts.cohort_dates(b.sources.spark, b.cfg).join(
        b.cohorts.groupBy("cohort").agg(F.count(F.lit(1)).alias("users")), "cohort", "left")


@register
def cohort_assign(b: Blocks) -> DataFrame:
    return b.cohorts


@register
def weekly_pivot(b: Blocks) -> DataFrame:
    return b.pivot


@register
def weekly_flags(b: Blocks) -> DataFrame:
    return target.weekly_flags(b.pivot).select(
        *target.KEY, *[f"aw_{w}" for w in range(15)])


@register
def linreg_13w(b: Blocks) -> DataFrame:
    return b.linreg.select(
        *target.KEY, "sx", "sy", "sxx", "sxy", "syy", "beta_hat", "alpha_hat", "se2", "sb2",
        "sa2", "beta_lower", "beta_upper", "alpha_lower", "alpha_upper", "x_intercept")


@register
def linreg_pivot(b: Blocks) -> DataFrame:
    return target.linreg_pivot(b.linreg, b.cfg)


@register
def churn_target(b: Blocks) -> DataFrame:
    return b.targets


@register
def genre_affinity(b: Blocks) -> DataFrame:
    return b.affinity


@register
def genre_schedule(b: Blocks) -> DataFrame:
    return b.schedule


@register
def schedule_moving_average(b: Blocks) -> DataFrame:
    return b.scaled_schedule


@register
def schedule_match_index(b: Blocks) -> DataFrame:
    return b.schedule_match


@register
def windowed_activity(b: Blocks) -> DataFrame:
    return b.windowed.select(
        "user_id", "fresh", "cohort", "destination", "date_of_event", "version_id",
        "playback_time", "page_views")


@register
def tleo_ladder_query(b: Blocks) -> DataFrame:
    return b.sources.activity.groupBy(
        tleo_ladder(ID_LADDER, ID_SENTINELS).alias("tleo_id"),
        tleo_level(ID_LADDER, ID_SENTINELS).alias("level")).agg(F.count(F.lit(1)).alias("n"))


@register
def listening_type(b: Blocks) -> DataFrame:
    return b.listening


@register
def product_mix(b: Blocks) -> DataFrame:
    return b.product_mix


@register
def preferred_listening(b: Blocks) -> DataFrame:
    return b.product_mix.select("user_id", "fresh", *[
        f"audio_prod_{m}_preferred_listening{d}" for m in ("st", "ev") for d in ("", "_detail")])


@register
def device_app_type(b: Blocks) -> DataFrame:
    return b.sources.activity.groupBy(
        "device_type", "browser_brand", devices.device_app_type().alias("app_type")).agg(
        F.count(F.lit(1)).alias("n"))


@register
def device_counts(b: Blocks) -> DataFrame:
    return devices.device_counts(b.device_usage)


@register
def device_shares(b: Blocks) -> DataFrame:
    return devices.device_shares(b.device_usage)


@register
def preferred_device(b: Blocks) -> DataFrame:
    return b.device_features.select("user_id", "fresh", *[
        f"device_{p}_{m}_preferred" for p in ("video", "audio") for m in ("st", "ev")])


@register
def device_features(b: Blocks) -> DataFrame:
    return b.device_features


@register
def time_of_day_shares(b: Blocks) -> DataFrame:
    return b.time_of_day()


@register
def series_schedule(b: Blocks) -> DataFrame:
    return b.series_schedule.drop("programme_duration")


@register
def series_finales(b: Blocks) -> DataFrame:
    return b.series_finales


@register
def lastweek_series(b: Blocks) -> DataFrame:
    return b.lastweek_series


@register
def lastweek_repeats(b: Blocks) -> DataFrame:
    return b.lastweek_repeats


@register
def lastweek_features(b: Blocks) -> DataFrame:
    return b.lastweek_features


@register
def profile_demographics(b: Blocks) -> DataFrame:
    return b.demographics(b.cohorts)


@register
def dedupe_anti_join(b: Blocks) -> DataFrame:
    return profile.dedupe_anti_join(b.sources.profile, ["user_id"])


@register
def segment_pivot(b: Blocks) -> DataFrame:
    return b.segments(b.cohorts)


@register
def content_mode_genre(b: Blocks) -> DataFrame:
    return content.content_mode_genre(b.sources.catalogue, b.cfg)


@register
def activation_asof(b: Blocks) -> DataFrame:
    return b.activation("audio", b.cohorts)


@register
def activation_asof_video(b: Blocks) -> DataFrame:
    return b.activation("video", b.cohorts)


@register
def favourite_content(b: Blocks) -> DataFrame:
    return b.favourite("audio")


@register
def favourite_content_video(b: Blocks) -> DataFrame:
    return b.favourite("video")


@register
def marketing_optin(b: Blocks) -> DataFrame:
    return b.optin(b.cohorts).drop("server_time")


@register
def marketing_activity(b: Blocks) -> DataFrame:
    return b.mail(b.cohorts)


@register
def follow_counts(b: Blocks) -> DataFrame:
    return b.follows(b.cohorts)


@register
def feature_set_assemble(b: Blocks) -> DataFrame:
    return b.feature_set("video")


@register
def feature_set_assemble_audio(b: Blocks) -> DataFrame:
    return b.feature_set("audio")


@register
def random_sample_n(b: Blocks) -> DataFrame:
    return sampling.random_sample_n(
        b.sources.table("events").select("event_id", "user_id", "event_type"), 500,
        "event_id", "sample")


@register
def sample_with_replacement(b: Blocks) -> DataFrame:
    return sampling.sample_with_replacement(
        b.sources.table("events").select("event_id", "user_id", "event_type"), 700,
        "event_id", "again")


@register
def train_population(b: Blocks) -> DataFrame:
    rows = b.targets.where((F.col("destination") == "video") & (F.col("fresh") == 0)).join(
        b.demographics().select("user_id", "fresh", "train_eligible"), ["user_id", "fresh"])
    return sampling.train_population(rows, "user_id").select(
        "user_id", "cohort", "target_churn_next_week", "role")


@register
def stratified_folds(b: Blocks) -> DataFrame:
    return sampling.stratified_folds(
        b.sources.scored.select("row_id", "label"), "label", 10, "row_id")


@register
def score_sample_profile(b: Blocks) -> DataFrame:
    sample = sampling.random_sample_n(
        b.cohorts.where(F.col("fresh") == 1).select("user_id"), 300, "user_id", "score")
    return profile.score_sample_profile(
        sample, b.sources.profile, b.sources.profile_extension)


@register
def dashboard_rollups(b: Blocks) -> DataFrame:
    return dashboard.historic_churn(b.targets)


@register
def dashboard_rollups_predicted(b: Blocks) -> DataFrame:
    return dashboard.predicted_churn(b.sources.score_history, "video")


@register
def expect_empty(b: Blocks) -> DataFrame:
    repeated = quality.duplicate_key_check(b.sources.profile.select("user_id"), ["user_id"])
    keys = quality.duplicate_key_check(b.targets, ["user_id", "fresh", "destination"])
    return quality.expect_empty(repeated, "profile user ids", "warning").unionByName(
        quality.expect_empty(keys, "target keys"))


@register
def duplicate_key_check(b: Blocks) -> DataFrame:
    return quality.duplicate_key_check(b.sources.profile, ["user_id"])


@register
def na_counts(b: Blocks) -> DataFrame:
    return quality.na_counts(b.demographics(b.cohorts))


@register
def invariate_columns(b: Blocks) -> DataFrame:
    columns = ["genre_share_comedy", "genre_share_sport", "genre_distinct_count",
               "genre_watch_drama", "distinct_days"]
    return quality.invariate_columns(b.affinity, columns)


@register
def class_balance(b: Blocks) -> DataFrame:
    return quality.class_balance(b.targets.where(F.col("active_last_week") == 1),
                                 "target_churn_next_week")

