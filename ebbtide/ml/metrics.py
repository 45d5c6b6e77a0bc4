"""Evaluation of binary scores: ROC, AUC, log-loss, thresholds, confusion.

Rows are first added up per distinct score, so ties and hot scores shrink on
the map side; the cumulative counts then run slice by slice over the scores.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ebbtide.functions.skew import running_totals

GRID = 100


def _curve(df: DataFrame, label: str, score: str, groups: Sequence[str]) -> DataFrame:
    """One row per distinct score: counts at, up to and over all scores of the group."""
    counts = df.where(F.col(score).isNotNull() & F.col(label).isNotNull()).groupBy(
        *groups, F.col(score).alias("threshold")).agg(
        F.sum(F.col(label).cast("bigint")).alias("tp"),
        F.sum((1 - F.col(label)).cast("bigint")).alias("fp"))
    return running_totals(counts, list(groups), "threshold", ["tp", "fp"], descending=True)


def _rate(part: str, total: str) -> Column:
    return F.try_divide(F.col(part).cast("double"), F.col(total).cast("double"))


def roc_curve(df: DataFrame, label: str, score: str, groups: Sequence[str] = ()) -> DataFrame:
    """(threshold): rows scored at or above it, as counts and rates."""
    return _curve(df, label, score, groups).select(
        *groups, "threshold", F.col("cum_tp").alias("tp"), F.col("cum_fp").alias("fp"),
        _rate("cum_tp", "total_tp").alias("tpr"), _rate("cum_fp", "total_fp").alias("fpr"))


def roc_auc(df: DataFrame, label: str, score: str, groups: Sequence[str] = ()) -> DataFrame:
    """Trapezoid area; each distinct score adds its own strip, no neighbour needed."""
    strip = F.col("fp") * (F.col("cum_tp") - F.col("tp") / 2)
    whole = F.max(F.col("total_tp").cast("double") * F.col("total_fp"))
    return _curve(df, label, score, groups).groupBy(*groups).agg(
        F.try_divide(F.sum(strip), whole).alias("auc"))


def log_loss(df: DataFrame, label: str, score: str, groups: Sequence[str] = (),
             clip: float = 1e-15) -> DataFrame:
    p = F.least(F.greatest(F.col(score), F.lit(clip)), F.lit(1 - clip))
    return df.groupBy(*groups).agg(
        F.avg(-F.when(F.col(label) == 1, F.ln(p)).otherwise(F.ln(1 - p))).alias("log_loss"))


def youden_threshold(df: DataFrame, label: str, score: str,
                     groups: Sequence[str] = ()) -> DataFrame:
    """Threshold with the greatest tpr - fpr; the higher threshold wins a tie."""
    curve = roc_curve(df, label, score, groups)
    gap = F.coalesce(F.col("tpr"), F.lit(0.0)) - F.coalesce(F.col("fpr"), F.lit(0.0))
    best = F.max(F.struct(F.round(gap, 12).alias("gap"), "threshold"))
    return curve.groupBy(*groups).agg(best.alias("_b")).select(
        *groups, F.col("_b.threshold").alias("threshold"), F.col("_b.gap").alias("youden"))


def mean_roc(df: DataFrame, label: str, score: str, fold: str) -> DataFrame:
    """(grid point): mean tpr over folds with one standard deviation either side.

    A piece of a fold's curve emits the grid points it spans, so at most
    100 rows per fold leave the curve.
    """
    steps = GRID - 1
    curve = _curve(df, label, score, [fold]).withColumns({
        "_from": F.col("cum_fp") - F.col("fp"), "_low": F.col("cum_tp") - F.col("tp")})

    def first_at_or_after(count: str) -> Column:
        """Smallest grid index whose position is not left of count / total."""
        return F.expr(f"({steps} * {count} + total_fp - 1) div total_fp")

    pieces = curve.where(F.col("fp") > 0).withColumns({
        "_first": first_at_or_after("_from"), "_last": first_at_or_after("cum_fp") - 1})
    last_point = F.expr(f"cum_fp = total_fp and _last = {steps - 1}")
    pieces = pieces.withColumn("_last", F.when(last_point, F.lit(steps)).otherwise(
        F.col("_last"))).where(F.col("_first") <= F.col("_last"))
    point = pieces.select("*", F.explode(F.sequence("_first", "_last")).alias("point"))
    along = (F.col("point") * F.col("total_fp") - steps * F.col("_from")).cast("double") / (
        F.lit(steps) * F.col("fp"))
    tpr = F.try_divide(F.col("_low") + along * F.col("tp"), F.col("total_tp").cast("double"))
    per_fold = point.select(
        fold, F.col("point").cast("int"),
        F.when(F.col("point") == steps, F.lit(1.0)).otherwise(tpr).alias("tpr"))
    spread = per_fold.groupBy("point").agg(
        F.avg("tpr").alias("mean_tpr"), F.stddev_pop("tpr").alias("std_tpr"))
    return spread.select(
        "point", (F.col("point") / F.lit(float(steps))).alias("fpr"), "mean_tpr", "std_tpr",
        F.greatest(F.col("mean_tpr") - F.col("std_tpr"), F.lit(0.0)).alias("lower"),
        F.least(F.col("mean_tpr") + F.col("std_tpr"), F.lit(1.0)).alias("upper"))


def confusion_metrics(df: DataFrame, label: str, score: str, threshold: float | Column,
                      groups: Sequence[str] = ()) -> DataFrame:
    """Confusion counts at score >= threshold, accuracy and F1."""
    cut = threshold if isinstance(threshold, Column) else F.lit(threshold)
    up, yes = F.col(score) >= cut, F.col(label) == 1
    counts = df.groupBy(*groups).agg(
        F.count_if(~up & ~yes).alias("tn"), F.count_if(up & ~yes).alias("fp"),
        F.count_if(~up & yes).alias("fn"), F.count_if(up & yes).alias("tp"))
    right = (F.col("tp") + F.col("tn")).cast("double")
    return counts.withColumns({
        "accuracy": F.try_divide(right, F.col("tn") + F.col("fp") + F.col("fn") + F.col("tp")),
        "f1": F.try_divide(2.0 * F.col("tp"), 2 * F.col("tp") + F.col("fp") + F.col("fn"))})


def _value_counts(df: DataFrame, groups: Sequence[str], value: str, n: str | None) -> DataFrame:
    size = F.count(F.lit(1)) if n is None else F.sum(n)
    return df.where(F.col(value).isNotNull()).groupBy(*groups, value).agg(size.alias("n"))


def median_by(df: DataFrame, groups: Sequence[str], value: str, n: str | None = None
              ) -> DataFrame:
    """Exact median per group without bringing a group to one task; ``n``: rows a row is for."""
    counts = _value_counts(df, groups, value, n)
    ranked = running_totals(counts, list(groups), value, ["n"])

    def at(rank: Column) -> Column:
        here = (F.col("cum_n") >= rank) & (F.col("cum_n") - F.col("n") < rank)
        return F.max(F.when(here, F.col(value)))

    low, high = F.expr("(total_n + 1) div 2"), F.expr("(total_n + 2) div 2")
    return ranked.groupBy(*groups).agg(((at(low) + at(high)) / 2).alias("median"))


def mode_by(df: DataFrame, groups: Sequence[str], value: str, n: str | None = None
            ) -> DataFrame:
    """Most frequent value per group; the smaller value wins a tie. ``n`` as in ``median_by``."""
    counts = _value_counts(df, groups, value, n)
    best = F.min(F.struct((-F.col("n")).alias("n"), value))[value]
    return counts.groupBy(*groups).agg(best.alias("mode"))
