"""Joins and rankings that stay spread out when one key holds much of the data."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

HASH_BUCKETS = 1 << 14
VALUE_BUCKETS = 64


def lookup_join(fact: DataFrame, dim: DataFrame, on: Sequence[str]) -> DataFrame:
    """Left join to a dimension with one row per key; a NULL key finds nothing.

    Spark broadcasts the dimension if its size is known to be small, and otherwise adaptive
    execution splits the partitions of a key that holds much of the fact table.
    """
    return fact.join(dim, list(on), "left")


def null_safe_join(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Inner join in which a NULL key equals a NULL key."""
    renamed = right.withColumnsRenamed({c: f"_right_{c}" for c in on})
    match = [left[c].eqNullSafe(renamed[f"_right_{c}"]) for c in on]
    return left.join(renamed, match).drop(*[f"_right_{c}" for c in on])


def unique_by(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key: the smallest, so the result does not depend on row order."""
    rest = [c for c in df.columns if c not in keys]
    return (df.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("_row"))
            .select(*keys, *[F.col("_row")[c].alias(c) for c in rest]))


def rank_by_hash(df: DataFrame, number: Column, groups: Sequence[str], tie: Column, *,
                 alias: str = "rank", at_most: int | None = None,
                 buckets: int = HASH_BUCKETS) -> DataFrame:
    """Exact row_number over (groups order by number, tie), number uniform in [0, 2^32).

    A plain window would sort a whole group in one task. Here rows are numbered
    inside equal slices of the hash range and each slice is shifted by the count
    of the slices before it; the slice table has at most buckets rows per group.
    With ``at_most`` the slices past that rank are dropped before the sort.
    """
    keyed = df.withColumn("_n", number).withColumn(
        "_slice", F.shiftright(F.col("_n"), 32 - (buckets.bit_length() - 1)).cast("int"))
    before = Window.partitionBy(*groups).orderBy("_slice").rowsBetween(
        Window.unboundedPreceding, -1)
    slices = (keyed.groupBy(*groups, "_slice").agg(F.count(F.lit(1)).alias("_size"))
              .withColumn("_before", F.coalesce(F.sum("_size").over(before), F.lit(0)))
              .drop("_size"))
    if at_most is not None:
        slices = slices.where(F.col("_before") < at_most)
    inside = Window.partitionBy(*groups, "_slice").orderBy("_n", tie)
    ranked = (null_safe_join(keyed, slices, [*groups, "_slice"])
              .withColumn(alias, F.col("_before") + F.row_number().over(inside))
              .drop("_n", "_slice", "_before"))
    return ranked if at_most is None else ranked.where(F.col(alias) <= at_most)


def value_slices(df: DataFrame, groups: Sequence[str], value: str,
                 buckets: int = VALUE_BUCKETS) -> DataFrame:
    """Cut points per group: at most buckets numbers each.

    They only balance the work and never change a result. They are stored once so that every
    use, and every retry after a lost executor, cuts alike; they never come to the driver.
    """
    at = [i / buckets for i in range(1, buckets)]
    return stable(df.groupBy(*groups).agg(
        F.percentile_approx(value, at, 20 * buckets).alias("_cuts")))


def running_totals(df: DataFrame, groups: Sequence[str], value: str, sums: Sequence[str], *,
                   descending: bool = False, buckets: int = VALUE_BUCKETS) -> DataFrame:
    """Adds total_<c> (whole group) and cum_<c> (up to and with this value) per sum column.

    Rows must hold one row per (groups, value). Each group is cut into slices of
    about equal size, the sums run inside a slice and are shifted by the slices
    before it.
    """
    columns = df.columns
    if not groups:
        df, groups = df.withColumn("_all", F.lit(0)), ["_all"]
    cuts = value_slices(df, groups, value, buckets)
    sliced = null_safe_join(df, cuts, groups).withColumn(
        "_slice", F.size(F.filter("_cuts", lambda cut: cut < F.col(value)))).drop("_cuts")
    if descending:
        sliced = sliced.withColumn("_slice", -F.col("_slice"))
    per_slice = sliced.groupBy(*groups, "_slice").agg(*[F.sum(c).alias(f"_s_{c}") for c in sums])
    whole = Window.partitionBy(*groups)
    before = whole.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_slice.select(
        *groups, "_slice",
        *[F.coalesce(F.sum(f"_s_{c}").over(before), F.lit(0)).alias(f"_b_{c}") for c in sums],
        *[F.sum(f"_s_{c}").over(whole).alias(f"total_{c}") for c in sums])
    order = F.col(value).desc() if descending else F.col(value).asc()
    inside = Window.partitionBy(*groups, "_slice").orderBy(order).rowsBetween(
        Window.unboundedPreceding, 0)
    out = null_safe_join(sliced, offsets, [*groups, "_slice"])
    return out.select(
        *columns,
        *[(F.col(f"_b_{c}") + F.sum(c).over(inside)).alias(f"cum_{c}") for c in sums],
        *[F.col(f"total_{c}") for c in sums])


def checkpoint_folder(spark: SparkSession) -> str:
    """The shared folder the cluster names; a new local one only in local runs."""
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder is None:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="ebbtide-checkpoint-"))
        folder = context.getCheckpointDir()
    return folder.rstrip("/")


_staged: list[str] = []


def stable(df: DataFrame) -> DataFrame:
    """Writes df as a table in the checkpoint folder and reads it back.

    Later steps see the same rows in the same place even if executors are lost,
    read only the columns they need, and know the table's size. The folder stays
    until ``drop_staged``.
    """
    path = f"{checkpoint_folder(df.sparkSession)}/ebbtide-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _staged.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_staged(spark: SparkSession, keep: int = 0) -> None:
    """Removes the tables staged since there were ``keep`` of them.

    Call it at the end of a run, when its results have been written.
    """
    while len(_staged) > keep:
        delete_folder(spark, _staged.pop())


def delete_folder(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


@contextmanager
def staged_folder(spark: SparkSession, name: str) -> Iterator[str]:
    """A new folder below the checkpoint folder, removed at the end of the block."""
    path = f"{checkpoint_folder(spark)}/{name}-{uuid.uuid4().hex}"
    try:
        yield path
    finally:
        delete_folder(spark, path)


@contextmanager
def staged_tables(spark: SparkSession) -> Iterator[None]:
    """Removes at the end what the block has staged, also if it fails."""
    before = len(_staged)
    try:
        yield
    finally:
        drop_staged(spark, before)


def rank_by_range(df: DataFrame, groups: Sequence[str], order: Sequence[Column], *,
                  alias: str = "rank") -> DataFrame:
    """Exact row_number over (groups order by order) for any distribution of both.

    Rows are range-partitioned by (groups, order), so a huge group spans many
    partitions; each partition numbers its own part of a group and adds the
    sizes of the parts before it.
    """
    keys = [F.col(c) for c in groups]
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = stable(df.repartitionByRange(n, *keys, *order)
                   .withColumn("_part", F.spark_partition_id()))
    before = Window.partitionBy(*groups).orderBy("_part").rowsBetween(
        Window.unboundedPreceding, -1)
    offsets = (parts.groupBy(*groups, "_part").agg(F.count(F.lit(1)).alias("_size"))
               .withColumn("_before", F.coalesce(F.sum("_size").over(before), F.lit(0)))
               .drop("_size"))
    inside = Window.partitionBy(*groups, "_part").orderBy(*order)
    return (null_safe_join(parts, offsets, [*groups, "_part"])
            .withColumn(alias, F.col("_before") + F.row_number().over(inside))
            .drop("_part", "_before"))
