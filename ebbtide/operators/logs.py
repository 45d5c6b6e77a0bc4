"""Features from logs: frequency segments, newsletter, mail, follows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ebbtide.config import FOLLOW_RULES, SEGMENT_DEFAULT, SEGMENT_PRODUCTS, ChurnConfig
from ebbtide.functions.exprs import week_of
from ebbtide.operators.cohorts import (
    cohort_date, expand_cohorts, fill_cohorts, only_cohort_users, within_window)

KEY = ("user_id", "fresh")


def segment_pivot(segments: DataFrame, cfg: ChurnConfig, cohorts: DataFrame | None = None, *,
                  products=SEGMENT_PRODUCTS, default: str = SEGMENT_DEFAULT) -> DataFrame:
    """(user, fresh): segment of the last feature week, one column per product."""
    week = week_of(F.col("date_of_segmentation"))
    inside = segments.where(
        F.col("date_of_segmentation").between(
            F.lit(cfg.window_min_date), F.date_add(F.lit(cfg.window_max_date), 7))
        & F.lower("product").isin(*products) & F.col("user_id").isNotNull())
    rows = expand_cohorts(inside, cfg).where(
        week == cohort_date("last_week_start", cfg))
    pivot = rows.groupBy(*KEY).agg(*[
        F.max(F.when(F.lower("product") == p, F.col("segment"))).alias(f"freq_seg_{p}")
        for p in products])
    return fill_cohorts(pivot, cohorts).fillna(default, [f"freq_seg_{p}" for p in products])


def marketing_optin(newsletter: DataFrame, cfg: ChurnConfig, cohorts: DataFrame | None = None, *,
                    newsletter_id: str = "main") -> DataFrame:
    """(user, fresh): the latest newsletter action before the end of the features."""
    actions = newsletter.where(
        (F.lower("activity_type") == "follows") & (F.col("resource_type") == "newsletter")
        & (F.col("resource_domain") == "profile") & (F.col("resource_id") == newsletter_id)
        & (F.col("action_date") <= F.lit(cfg.window_max_date)) & F.col("user_id").isNotNull())
    end = cohort_date("max_feature_date", cfg)
    latest = expand_cohorts(actions, cfg).where(F.col("action_date") <= end).groupBy(*KEY).agg(
        F.max(F.struct("server_time", "action")).alias("_a"), F.max(end).alias("_end"))
    days = F.datediff(F.col("_end"), F.col("_a.server_time").cast("date"))
    action = F.col("_a.action")
    return only_cohort_users(latest.select(
        *KEY, F.col("_a.server_time").alias("server_time"), action.alias("last_action"),
        F.when(action == "followed", 1).otherwise(0).alias("mkt_opted_in"),
        F.when(action == "followed", days).alias("mkt_days_opted_in"),
        F.when(action == "unfollowed", days).alias("mkt_days_opted_out")), cohorts)


def _distinct_sends(mail: DataFrame, cfg: ChurnConfig, name: str) -> DataFrame:
    """Distinct sends in 13 weeks and in the last week.

    Sends are first made unique with a last-week flag, so both counts come from
    one pass and no row is duplicated for the second distinct.
    """
    start = cohort_date("last_week_start", cfg)
    rows = within_window(mail, cfg, "event_ts")
    sends = rows.select(*KEY, "send_id", (F.col("event_ts") >= start).cast("int").alias("_lw")
                        ).groupBy(*KEY, "send_id").agg(F.max("_lw").alias("_lw"))
    return sends.groupBy(*KEY).agg(
        F.count("send_id").alias(f"mkt_email_{name}_13w"),
        F.sum(F.when(F.col("send_id").isNotNull(), F.col("_lw")).otherwise(0))
        .alias(f"mkt_email_{name}_lw"))


def marketing_activity(opens: DataFrame, clicks: DataFrame, cfg: ChurnConfig,
                       cohorts: DataFrame | None = None) -> DataFrame:
    """(user, fresh): mails opened and clicked; users in either log appear."""
    both = _distinct_sends(opens, cfg, "opens").join(
        _distinct_sends(clicks, cfg, "clicks"), list(KEY), "full")
    return only_cohort_users(both.fillna(0), cohorts)


def follow_rule(kinds, activity: str, domains) -> Column:
    return (F.col("resource_type").isin(*kinds) & (F.col("activity_type") == activity)
            & F.col("resource_domain").isin(*domains))


def follow_counts(actions: DataFrame, cfg: ChurnConfig, cohorts: DataFrame | None = None, *,
                  rules=FOLLOW_RULES) -> DataFrame:
    """(user, fresh): follows, subscribes and bookmarks in one pass, 13 weeks and last week."""
    matched = {name: follow_rule(*rule) for name, *rule in rules}
    wanted = F.lit(False)
    for rule in matched.values():
        wanted = wanted | rule
    rows = within_window(actions.where(wanted), cfg, "action_date")
    recent = F.col("action_date") >= cohort_date("last_week_start", cfg)
    columns = []
    for name, rule in matched.items():
        columns += [F.count_if(rule).alias(f"{name}_13w"),
                    F.count_if(rule & recent).alias(f"{name}_lastweek")]
    return only_cohort_users(rows.groupBy(*KEY).agg(*columns), cohorts)
