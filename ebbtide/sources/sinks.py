"""Writers: feature files, score history, partitioned exports."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ebbtide.functions.skew import checkpoint_folder
from ebbtide.sources.readers import read_csv

def scratch(spark: SparkSession, name: str) -> str:
    """A new folder beside the checkpoints, which every executor can reach."""
    return f"{checkpoint_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def write_features(df: DataFrame, path: str, kind: str = "parquet") -> None:
    """Parquet by default; ``csv`` writes bzip2 files with a header. Always in parallel."""
    writer = df.write.mode("overwrite")
    if kind == "csv":
        writer.option("header", True).option("compression", "bzip2").option(
            "emptyValue", "").option("escape", '"').option(
            "ignoreLeadingWhiteSpace", False).option(
            "ignoreTrailingWhiteSpace", False).csv(path)
    else:
        writer.parquet(path)


def csv_feature_roundtrip(df: DataFrame, path: str, schema: T.StructType | None = None
                          ) -> DataFrame:
    """Writes the rows as CSV and reads them back with their types."""
    write_features(df, path, "csv")
    return read_csv(df.sparkSession, path, schema or df.schema)


def score_append(scores: DataFrame, path: str, product: str, mode: str = "append") -> DataFrame:
    """Adds a run's scores of one product to the history and returns the history.

    The history is stored by week, product and learner, and ``append`` replaces the parts that
    ``scores`` has: a repeated run leaves the same history, and another product, learner or week
    stays. Texts are stored whole. ``overwrite`` first empties the table.
    """
    how = "dynamic" if mode == "append" else "static"
    scores.select(
        "*", F.lit(product).alias("product"), F.col("target_week_start_date").alias("_week"),
        F.col("learner_name").alias("_learner")).write.mode("overwrite").option(
        "partitionOverwriteMode", how).partitionBy("_week", "product", "_learner").parquet(path)
    return scores.sparkSession.read.parquet(path).select(*scores.columns, "product")


def append_to_table(scores: DataFrame, table: str) -> None:
    """Appends to a catalog table, which is created if missing."""
    scores.write.mode("append").saveAsTable(table)


def replace_table(df: DataFrame, table: str) -> None:
    """Replaces the contents of a result table."""
    df.write.mode("overwrite").saveAsTable(table)


def historical_partition(df: DataFrame, path: str, week_start: str) -> DataFrame:
    """Stores the rows under ``week_start=...``; other weeks stay as they are."""
    df.withColumn("week_start", F.lit(week_start).cast("date")).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic").partitionBy("week_start").parquet(path)
    return df.sparkSession.read.parquet(path)


def partitioned_export(df: DataFrame, path: str,
                       by: Sequence[str] = ("target_week_start_date", "learner_name")
                       ) -> DataFrame:
    """One folder per target week and learner; only the folders in df are replaced."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
        *by).parquet(path)
    return df.sparkSession.read.parquet(path)
