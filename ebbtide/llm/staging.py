"""Intermediate tables in the cluster's shared folder, and column names that cannot clash."""

from __future__ import annotations

import os
import re
import uuid

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ebbtide.functions.skew import checkpoint_folder

HOME = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
MOST_BYTES = 4 << 20
BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
_kept: list[str] = []


def keep(df: DataFrame, batch_rows: int | None = None) -> DataFrame:
    """Writes df below spark.checkpoint.dir and reads it back: lost executors cost no rework.

    batch_rows bounds the rows that Python sees at once, for plans whose rows are large.
    """
    path = f"{checkpoint_folder(df.sparkSession)}/corpus-{uuid.uuid4().hex}"
    conf = df.sparkSession.conf
    usual = conf.get(BATCH_ROWS)
    if batch_rows is not None:
        conf.set(BATCH_ROWS, str(batch_rows))
    try:
        df.write.parquet(path)
    finally:
        conf.set(BATCH_ROWS, usual)
    _kept.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop(df: DataFrame) -> None:
    """Removes a kept table that no plan reads any more."""
    for file in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        if file.rsplit("/", 1)[-1].startswith("corpus-"):
            _delete(df.sparkSession, file)


def release(spark: SparkSession) -> None:
    """Removes every table kept so far; call it when the results have been written."""
    while _kept:
        _delete(spark, _kept.pop())


def _delete(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def prepare_workers(spark: SparkSession) -> None:
    """Lets Python workers find this package, and see few bytes of text at once.

    The batch size is a setting of the session; a smaller one stays as it is.
    """
    paths = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    if HOME not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(
            [HOME, *filter(None, paths)])
    now = re.match(r"\d+", spark.conf.get(BATCH_BYTES))
    if int(now[0]) > MOST_BYTES:
        spark.conf.set(BATCH_BYTES, str(MOST_BYTES))


def only(df: DataFrame, **columns: str) -> DataFrame:
    """The named columns under our own names, whatever else df carries.

    A name that differs only in case or stands twice in df is an error of the caller.
    """
    prepare_workers(df.sparkSession)
    return df.select(*[F.col(f"`{name}`").alias(alias) for alias, name in columns.items()])


def unused(df: DataFrame, *names: str) -> list[str]:
    """Names like the given ones that df does not have in any case."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def id_or_least(name: str = "doc_id") -> Column:
    """A NULL id counts as the smallest long, so it can be ordered and joined."""
    return F.coalesce(F.col(name).cast("long"), F.lit(-(1 << 63)).cast("long"))


def id_back(column: Column) -> Column:
    return F.nullif(column, F.lit(-(1 << 63)).cast("long"))


def batches(items, limit: int):
    """Splits an Arrow batch into slices whose strings hold about limit bytes each."""
    for batch in items:
        sizes = [column.nbytes for column in batch.columns]
        rows = batch.num_rows
        if not rows:
            continue
        step = max(1, int(rows * limit / max(1, sum(sizes))))
        for start in range(0, rows, step):
            yield batch.slice(start, step)
    pa.default_memory_pool().release_unused()
