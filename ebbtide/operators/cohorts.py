"""Cohorts: which 13 weeks of history a user contributes, and the dates they imply.

The training cohort is a hash of the user id, so any table that carries a user
id can work out its own windows row by row; no cohort table has to be joined
to an event log.
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ebbtide.config import FRESH_COHORT, ChurnConfig
from ebbtide.functions.exprs import hash_bucket, week_of

DATE_COLUMNS = ("min_date", "max_date", "max_feature_date", "last_week_start")


def cohort_date(name: str, cfg: ChurnConfig) -> Column:
    """One of the cohort's dates as an expression of the ``cohort`` column."""
    newest = f"DATE'{cfg.max_date}'"
    feature_end = f"date_sub({newest}, 7 * cohort + 14)"
    return F.expr({
        "min_date": f"date_sub({newest}, 7 * (cohort + 15) - 1)",
        "max_date": f"date_sub({newest}, 7 * cohort)",
        "max_feature_date": feature_end,
        "max_week": f"CAST(date_trunc('week', date_sub({newest}, 7 * cohort)) AS DATE)",
        "last_week_start": f"CAST(date_trunc('week', {feature_end}) AS DATE)",
    }[name])


def with_dates(df: DataFrame, cfg: ChurnConfig, names=DATE_COLUMNS) -> DataFrame:
    return df.withColumns({n: cohort_date(n, cfg) for n in names})


def expand_cohorts(df: DataFrame, cfg: ChurnConfig) -> DataFrame:
    """Each row twice: as training history (fresh = 0) and as scoring history (fresh = 1)."""
    training = hash_bucket("user_id", cfg.salt, cfg.n_cohorts)
    roles = F.array(
        F.struct(F.lit(0).alias("fresh"), training.alias("cohort")),
        F.struct(F.lit(1).alias("fresh"), F.lit(FRESH_COHORT).alias("cohort")))
    return df.select("*", F.explode(roles).alias("_role")).select(
        *df.columns, "_role.fresh", "_role.cohort")


def within_window(df: DataFrame, cfg: ChurnConfig, day: str, *,
                  start: str = "min_date") -> DataFrame:
    """Rows whose day lies between the cohort's ``start`` and the end of its features.

    The literal bounds come first: they reach the scan and skip whole partitions.
    """
    after = cfg.window_max_date + timedelta(days=1)
    bounded = df.where(f"`{day}` >= DATE'{cfg.window_min_date}' AND `{day}` < DATE'{after}' "
                       "AND user_id IS NOT NULL")
    return expand_cohorts(bounded, cfg).where(F.col(day).cast("date").between(
        cohort_date(start, cfg), cohort_date("max_feature_date", cfg)))


def cohort_dates(spark: SparkSession, cfg: ChurnConfig) -> DataFrame:
    """Date lookup: one row per cohort, the scoring cohort included."""
    rows = [(FRESH_COHORT,), *[(c,) for c in range(cfg.n_cohorts)]]
    table = with_dates(spark.createDataFrame(rows, "cohort int"), cfg)
    return table.withColumn("max_week", week_of(F.col("max_date")))


def cohort_assign(activity: DataFrame, cfg: ChurnConfig) -> DataFrame:
    """(user, fresh) for every user seen in the extract, with cohort and dates."""
    return with_dates(expand_cohorts(activity.select("user_id").distinct(), cfg), cfg)


def only_cohort_users(block: DataFrame, cohorts: DataFrame | None) -> DataFrame:
    """Keeps the block's users that are in the cohorts; runs after aggregation."""
    if cohorts is None:
        return block
    return block.join(cohorts.select("user_id", "fresh"), ["user_id", "fresh"], "left_semi")


def fill_cohorts(block: DataFrame, cohorts: DataFrame | None) -> DataFrame:
    """One row for every (user, fresh), empty where the block has none."""
    if cohorts is None:
        return block
    return cohorts.select("user_id", "fresh").join(block, ["user_id", "fresh"], "left")
