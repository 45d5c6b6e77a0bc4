"""Profiles: unique users, demographics, profile of a score sample."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from ebbtide.config import ADULT_AGE_RANGES, ChurnConfig
from ebbtide.functions.skew import unique_by
from ebbtide.operators.cohorts import cohort_date, expand_cohorts, only_cohort_users


def dedupe_anti_join(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key occurs once.

    One aggregation: a key with many copies shrinks to one row per map task
    before the shuffle, which a join against the list of duplicates would not do.
    """
    rest = [c for c in df.columns if c not in keys]
    grouped = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_n"), F.first(F.struct(*rest)).alias("_row"))
    return grouped.where(F.col("_n") == 1).select(
        *keys, *[F.col("_row")[c].alias(c) for c in rest])


def profile_demographics(profile: DataFrame, extension: DataFrame, genders: DataFrame,
                         ages: DataFrame, cfg: ChurnConfig,
                         cohorts: DataFrame | None = None) -> DataFrame:
    """(user, fresh): account age, eligibility, age, gender, region."""
    people = dedupe_anti_join(profile.where(F.col("user_id").isNotNull()), ["user_id"]).where(
        F.col("status") != "deleted")
    for dim in (extension, genders, ages):
        people = people.join(unique_by(dim, ["user_id"]), "user_id", "left")
    rows = expand_cohorts(people, cfg)
    days = F.datediff(cohort_date("max_week", cfg), F.col("created_date"))
    ranges = F.when(F.col("age_range").isin(*ADULT_AGE_RANGES), 1).when(
        F.col("age_range").isNotNull(), 0)
    predicted = F.when(F.col("predicted_age") == "16-34", 1).otherwise(0)

    def missing(*names: str):
        empty = F.lit(True)
        for n in names:
            empty = empty & F.col(n).isNull()
        return empty.cast("int")

    out = rows.select(
        "user_id", "fresh", "enable_personalisation", "mail_verified",
        days.alias("acc_age_days"),
        F.when(days < 14, 0).otherwise(1).alias("train_eligible"),
        F.col("age").try_cast("int").alias("age"),
        "age_range",
        F.coalesce(ranges, predicted).alias("age_1634_enriched"),
        missing("age").alias("age_missing_flag"),
        missing("age_range", "predicted_age").alias("age_1634_enriched_missing_flag"),
        "gender",
        F.coalesce("gender", "predicted_gender").alias("gender_enriched"),
        missing("gender").alias("gender_missing_flag"),
        missing("gender", "predicted_gender").alias("gender_enriched_missing_flag"),
        "nation",
        F.coalesce((F.lower("location") == "gb").cast("int"), F.lit(0)).alias("uk_flag"),
        "barb_region", "acorn_type_description", "acorn_group_description",
        "acorn_category_description")
    return only_cohort_users(out, cohorts)


def score_sample_profile(sample: DataFrame, profile: DataFrame,
                         extension: DataFrame) -> DataFrame:
    """(user): age, 16-34 flag, gender, nation and acorn category of a score sample."""
    people = unique_by(profile.select("user_id", "age", "gender"), ["user_id"])
    extra = unique_by(extension.select(
        "user_id", "nation", "acorn_category_description", "acorn_category"), ["user_id"])
    age = F.col("age").try_cast("int")
    return sample.select("user_id").join(people, "user_id").join(extra, "user_id", "left").select(
        "user_id", age.alias("age"),
        F.coalesce(age.between(16, 34).cast("int"), F.lit(0)).alias("age_1634"),
        "gender", "nation", F.col("acorn_category_description").alias("acorn_cat"),
        F.col("acorn_category").try_cast("int").alias("acorn_cat_num"))
