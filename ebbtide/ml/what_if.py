"""Average users of population segments, and the effect of changing one of their features."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ebbtide.functions.exprs import quoted
from ebbtide.functions.skew import stable
from ebbtide.ml.metrics import median_by, mode_by


def default_segments() -> dict[str, Column]:
    """The population segments, over the profile columns."""
    return {
        "user_base": F.lit(True),
        "user_1634": F.col("age_1634") == 1,
        "user_1624": F.col("age") <= 24,
        "user_female": F.col("gender") == "female",
        "user_acorn_456": F.col("acorn_cat_num").isin(4, 5, 6),
    }


def average_users(profiled: DataFrame, numeric: Sequence[str], categorical: Sequence[str],
                  segments: Mapping[str, Column]) -> DataFrame:
    """(user_id, feature): median or most frequent value per segment, as text.

    Rows are counted per feature, value and set of segments before a segment sees them, so the
    number of segments multiplies counts and not rows. A segment without a known value of a
    feature has no row for it.
    """
    names = list(segments)
    member = sum((F.when(F.coalesce(rule, F.lit(False)), F.lit(1 << i)).otherwise(0)
                  for i, rule in enumerate(segments.values())), F.lit(0))
    tagged = profiled.select(*numeric, *categorical, member.cast("long").alias("_member"))
    which = F.array_compact(F.array(*[
        F.when(F.col("_member").bitwiseAND(1 << i) != 0, F.lit(name))
        for i, name in enumerate(names)]))

    def counts(columns: Sequence[str], kind: str) -> DataFrame:
        parts = ", ".join(f"struct({quoted(c)} AS feature, CAST(`{c}` AS {kind}) AS value)"
                          for c in columns)
        known = (tagged.selectExpr("_member", f"inline(array({parts}))")
                 .where(F.col("value").isNotNull())
                 .groupBy("feature", "value", "_member").agg(F.count(F.lit(1)).alias("_n")))
        return known.select("feature", "value", "_n", F.explode(which).alias("user_id"))

    frames = []
    if numeric:
        medians = median_by(counts(numeric, "double"), ["user_id", "feature"], "value", "_n")
        frames.append(medians.select(
            "user_id", "feature", F.col("median").cast("string").alias("baseval")))
    if categorical:
        modes = mode_by(counts(categorical, "string"), ["user_id", "feature"], "value", "_n")
        frames.append(modes.select("user_id", "feature", F.col("mode").alias("baseval")))
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out


def numbered(modifiers: DataFrame) -> DataFrame:
    """Adds ``change``, which tells two changes of one column apart; a repeated row is one."""
    return modifiers.distinct().withColumn("change", F.concat_ws(
        "|", "mod_column", "method", F.coalesce("modifier", F.lit(""))))


def modified_users(base: DataFrame, modifiers: DataFrame) -> DataFrame:
    """(user_id, change, feature): base and new value; each change moves one feature."""
    joined = base.join(modifiers, "user_id")
    chosen = F.col("feature") == F.col("mod_column")
    moved = (F.col("baseval").try_cast("double")
             + F.col("modifier").try_cast("double")).cast("string")
    new = (F.when(chosen & (F.col("method") == "delta"), moved)
           .when(chosen & (F.col("method") == "replace"), F.col("modifier"))
           .otherwise(F.col("baseval")))
    return joined.select("user_id", "change", "mod_column", "method", "modifier", "feature",
                         "baseval", new.alias("newval"))


def wide_users(long: DataFrame, keys: Sequence[str], value: str, numeric: Sequence[str],
               categorical: Sequence[str]) -> DataFrame:
    """One row per average user, numbers as numbers."""
    names = [*numeric, *categorical]
    wide = long.groupBy(*keys).pivot("feature", names).agg(F.first(value))
    return wide.selectExpr(*keys, *[f"CAST(`{c}` AS DOUBLE) AS `{c}`" for c in numeric],
                           *categorical)


def representative_users(profiled: DataFrame, modifiers: DataFrame, numeric: Sequence[str],
                         categorical: Sequence[str],
                         score: Callable[[DataFrame, Sequence[str]], DataFrame], *,
                         segments: Mapping[str, Column] | None = None) -> DataFrame:
    """(user_id, change): base value, change, score before and after, impact.

    ``score`` takes wide users and their key columns and returns key columns and ``p``.
    """
    base = stable(average_users(profiled, numeric, categorical, segments or default_segments()))
    changed = modified_users(base, numbered(modifiers))
    before = score(wide_users(base, ["user_id"], "baseval", numeric, categorical), ["user_id"])
    after = score(wide_users(changed, ["user_id", "change"], "newval", numeric, categorical),
                  ["user_id", "change"])
    touched = changed.where(F.col("feature") == F.col("mod_column")).select(
        "user_id", "change", "mod_column", "baseval", "modifier", "method")
    return (after.withColumnRenamed("p", "modified_prediction")
            .join(before.withColumnRenamed("p", "base_prediction"), "user_id")
            .join(touched, ["user_id", "change"], "left")
            .select("user_id", "mod_column", "baseval", "modifier", "method", "base_prediction",
                    "modified_prediction",
                    (F.col("modified_prediction") - F.col("base_prediction"))
                    .alias("modified_impact")))


def representative_scores(profiled: DataFrame, numeric: Sequence[str],
                          categorical: Sequence[str],
                          predict: Callable[[DataFrame], DataFrame], *,
                          segments: Mapping[str, Column] | None = None) -> DataFrame:
    """Predictions of every learner for the average user of each segment."""
    base = stable(average_users(profiled, numeric, categorical, segments or default_segments()))
    return predict(wide_users(base, ["user_id"], "baseval", numeric, categorical))
