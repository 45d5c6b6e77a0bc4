"""Weekly pivot, activity flags, trend regression and the churn target.

After the pivot everything is a row expression: no further shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ebbtide.config import FEATURE_WEEKS, PIVOT_WEEKS, PRODUCTS, ChurnConfig
from ebbtide.functions.exprs import conditional_sum, exprs, hash_bucket, plus, weeks_between
from ebbtide.operators.cohorts import cohort_date, expand_cohorts

KEY = ("user_id", "destination", "cohort", "fresh")
# Fixed value: two-sided 95 % t quantile for 11 degrees of freedom.
T_11 = 2.201


def effective_week(cfg: ChurnConfig) -> Column:
    """Weeks before the cohort's target week: 0 next week, 1 this week, 2.. features."""
    return weeks_between(F.col("week"), F.lit(cfg.max_week)) - F.col("cohort")


def weekly_pivot(weekly: DataFrame, cfg: ChurnConfig) -> DataFrame:
    """(user, product, cohort, fresh): streaming time and events of 15 weeks."""
    rows = expand_cohorts(weekly.where(F.col("destination") != "radio").select(
        "user_id", "destination", "week", "events", "streaming_time"), cfg)
    times = {f"stw_{w}": f"_k = {w}" for w in PIVOT_WEEKS}
    times["streaming_time_13w"] = f"_k BETWEEN {FEATURE_WEEKS[0]} AND {FEATURE_WEEKS[-1]}"
    return rows.withColumn("_k", effective_week(cfg)).groupBy(*KEY).agg(*exprs([
        *[f"{conditional_sum(rule, 'streaming_time', '0.0D')} AS {n}"
          for n, rule in times.items()],
        *[f"{conditional_sum(f'_k = {w}', 'events')} AS ew_{w}" for w in PIVOT_WEEKS]]))


def weekly_flags(pivot: DataFrame) -> DataFrame:
    return pivot.selectExpr("*", *[f"CAST(ew_{w} > 0 AS INT) AS aw_{w}" for w in PIVOT_WEEKS])


def linreg_13w(pivot: DataFrame) -> DataFrame:
    """Least squares through the 13 feature weeks; x = 1 is the newest week.

    A negative slope therefore means rising use.
    """
    xs = {w: i + 1 for i, w in enumerate(FEATURE_WEEKS)}
    n, sx, sxx = len(xs), sum(xs.values()), sum(x * x for x in xs.values())
    spread = n * sxx - sx * sx
    sums = pivot.selectExpr(
        "*", f"{sx}.0D AS sx", f"CAST({plus(f'ew_{w}' for w in xs)} AS DOUBLE) AS sy",
        f"{sxx}.0D AS sxx",
        f"CAST({plus(f'ew_{w} * {x}' for w, x in xs.items())} AS DOUBLE) AS sxy",
        f"CAST({plus(f'ew_{w} * ew_{w}' for w in xs)} AS DOUBLE) AS syy")
    fit = sums.selectExpr("*", f"({n} * sxy - {sx} * sy) / {spread} AS beta_hat")
    fit = fit.selectExpr(
        "*", f"sy / {n} - beta_hat * {sx} / {n} AS alpha_hat",
        f"greatest(0.0D, ({n} * syy - sy * sy - beta_hat * beta_hat * {spread}) "
        f"/ {n * (n - 2)}) AS se2")
    fit = fit.selectExpr("*", f"{n} * se2 / {spread} AS sb2",
                         f"{n} * se2 / {spread} * {sxx} / {n} AS sa2")
    t = f"{T_11}D"
    return fit.selectExpr(
        "*", f"beta_hat - {t} * sqrt(sb2) AS beta_lower",
        f"beta_hat + {t} * sqrt(sb2) AS beta_upper",
        f"alpha_hat - {t} * sqrt(sa2) AS alpha_lower",
        f"alpha_hat + {t} * sqrt(sa2) AS alpha_upper",
        "CASE WHEN beta_hat < 0 THEN -alpha_hat / beta_hat END AS x_intercept")


def is_active(cfg: ChurnConfig) -> str:
    return f"(ew_2 > 0 AND streaming_time_13w > {cfg.active_seconds})"


def linreg_pivot(linreg: DataFrame, cfg: ChurnConfig, own: str | None = None,
                 own_columns: Sequence[str] = ()) -> DataFrame:
    """(user, fresh): trend of each product side by side.

    ``own`` names the product whose activity flag also needs enough viewing time;
    its ``own_columns`` are carried along.
    """
    columns = [f"max(CASE WHEN destination = '{own}' THEN {c} END) AS {c}" for c in own_columns]
    for p in PRODUCTS:
        here = f"destination = '{p}'"
        active = is_active(cfg) if p == own else "ew_2 > 0"
        values = {"lin_reg_coeff": "beta_hat", "13w_yintercept": "alpha_hat",
                  "13w_xintercept": "x_intercept"}
        columns += [
            f"max(CAST({here} AS INT)) AS {p}_user",
            f"max(CAST({here} AND {active} AS INT)) AS {p}_active_last_week",
            *[f"max(CASE WHEN {here} THEN {c} END) AS {p}_{n}" for n, c in values.items()],
            f"max(CAST({here} AND x_intercept IS NOT NULL AS INT)) AS {p}_lin_reg_churn_flag"]
    return linreg.groupBy("user_id", "fresh").agg(*exprs(columns))


def churn_target(pivot: DataFrame, cfg: ChurnConfig, keep: Sequence[str] = ()) -> DataFrame:
    """Targets of the two weeks after the features, active flag, train flag; ``keep`` is kept."""
    def churned(week: int) -> Column:
        return F.when(F.col("fresh") == 0, (F.col(f"ew_{week}") == 0).cast("int"))

    cohort = F.col("cohort")
    held = hash_bucket("user_id", cfg.salt + "-train", 5) == 4
    return pivot.select(
        "user_id", "destination", "cohort",
        cohort_date("max_week", cfg).alias("target_week_start_date"),
        cohort_date("max_date", cfg).alias("target_week_end_date"),
        "fresh",
        churned(1).alias("target_churn_this_week"),
        churned(0).alias("target_churn_next_week"),
        F.expr(is_active(cfg)).cast("int").alias("active_last_week"),
        F.when(held, 0).otherwise(1).alias("train"), *keep)
