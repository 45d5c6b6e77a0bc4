"""Exact, repeatable random samples and stratified folds."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from ebbtide.functions.exprs import hash_bucket, hash_number
from ebbtide.functions.skew import rank_by_hash


def random_sample_n(df: DataFrame, n: int, key: str, salt: str) -> DataFrame:
    """Exactly min(n, rows) rows, the n smallest salted hashes of a unique key.

    No task and no driver ever holds the sample: rows past the n-th hash are
    dropped by comparing with the counts of hash slices.
    """
    return rank_by_hash(df, hash_number(key, salt), [], F.col(key),
                        alias="_rank", at_most=n).drop("_rank")


def sample_with_replacement(df: DataFrame, n: int, key: str, salt: str) -> DataFrame:
    """Exactly n draws with replacement, repeatable: (draw, columns of df).

    Draw i takes the row whose number, in the order of the salted hash of a unique key, is the
    hash of i scaled to the number of rows. Only draws and row numbers are joined.
    """
    rows = df.count()
    if not rows:
        return df.withColumn("draw", F.lit(0).cast("long")).limit(0).select("draw", *df.columns)
    ranked = rank_by_hash(df, hash_number(key, salt), [], F.col(key), alias="_rank")
    place = hash_number("draw", f"{salt}-draw").cast("decimal(20,0)") * rows
    draws = df.sparkSession.range(n).withColumnRenamed("id", "draw").withColumn(
        "_rank", F.floor(place / F.lit(1 << 32)).cast("long") + 1)
    return draws.join(ranked, "_rank").select("draw", *df.columns)


def stratified_folds(df: DataFrame, label: str, k: int, key: str, *, salt: str = "fold",
                     groups: Sequence[str] = ()) -> DataFrame:
    """Adds fold in 0..k-1; each label is dealt out evenly over the folds."""
    ranked = rank_by_hash(df, hash_number(key, salt), [*groups, label], F.col(key),
                          alias="_rank")
    return ranked.withColumn("fold", ((F.col("_rank") - 1) % k).cast("int")).drop("_rank")


def split_roles(df: DataFrame, key: str, *, salt: str = "split",
                private_of_4: int = 1) -> DataFrame:
    """Adds role: holdout (cohort 0), private (a quarter of the others) or public."""
    private = hash_bucket(key, salt, 4) < private_of_4
    return df.withColumn("role", F.when(F.col("cohort") == 0, "holdout")
                         .when(private, "private").otherwise("public"))


def train_population(df: DataFrame, key: str, *, salt: str = "split",
                     private_of_4: int = 1) -> DataFrame:
    """Active, eligible rows with their role."""
    rows = df.where((F.col("active_last_week") == 1) & (F.col("train_eligible") == 1))
    return split_roles(rows, key, salt=salt, private_of_4=private_of_4)
