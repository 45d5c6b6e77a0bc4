"""Published results: whole versions beside each other, and one pointer that readers follow.

``<root>/versions/<id>/<table>`` holds a run's tables. A version counts once its number has been
written to ``<root>/pointers``, which is one rename of a small file, after all of its tables.
Readers take the greatest number, so they see the tables of one finished run, old or new,
and a run that fails half way leaves everything as it was.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from ebbtide.functions.skew import delete_folder

DIGITS = 12
TRIES = 100


def _path(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark._jsc.hadoopConfiguration())


def listed(spark: SparkSession, folder: str) -> list[str]:
    """Names inside a folder, in order; none if there is no such folder."""
    target, files = _path(spark, folder)
    if not files.exists(target):
        return []
    return sorted(status.getPath().getName() for status in files.listStatus(target))


def versions(spark: SparkSession, root: str) -> list[tuple[int, str]]:
    """(number, id) of the finished versions, oldest first."""
    names = [n for n in listed(spark, f"{root}/pointers") if n[:DIGITS].isdigit()]
    return [(int(n[:DIGITS]), n[DIGITS + 1:]) for n in names]


def _point(spark: SparkSession, root: str, version: str) -> None:
    """Adds the next number; another run that takes it first makes this one go on to the next."""
    draft, files = _path(spark, f"{root}/drafts/{version}")
    files.create(draft, True).close()
    for _ in range(TRIES):
        known = versions(spark, root)
        number = known[-1][0] + 1 if known else 1
        target, _ = _path(spark, f"{root}/pointers/{number:0{DIGITS}}-{version}")
        files.mkdirs(target.getParent())
        if files.rename(draft, target):
            same = [v for n, v in versions(spark, root) if n == number]
            if len(same) == 1 or min(same) == version:
                return
            # two runs took one number: the one with the smaller id keeps it
            files.rename(target, draft)
    raise RuntimeError(f"no free number below {root}/pointers")


def publish(spark: SparkSession, root: str, tables: Mapping[str, DataFrame], *,
            by: Mapping[str, Sequence[str]] | None = None, keep: int = 3) -> str:
    """Writes the tables as one version, makes it the current one and returns its id.

    ``by`` names the columns whose values become folders of a table. The last ``keep`` finished
    versions stay, at least the current one, so readers that began with an older one can end.
    """
    version = uuid.uuid4().hex
    folder = f"{root}/versions/{version}"
    try:
        for name, df in tables.items():
            writer = df.write
            columns = (by or {}).get(name)
            if columns:
                writer = writer.partitionBy(*columns)
            writer.parquet(f"{folder}/{name}")
        _point(spark, root, version)
    except BaseException:
        delete_folder(spark, folder)
        raise
    for number, old in versions(spark, root)[:-max(keep, 1)]:
        delete_folder(spark, f"{root}/pointers/{number:0{DIGITS}}-{old}")
        delete_folder(spark, f"{root}/versions/{old}")
    return version


def current(spark: SparkSession, root: str) -> str:
    """Folder of the newest finished version; resolve it once for tables that belong together."""
    known = versions(spark, root)
    if not known:
        raise FileNotFoundError(f"nothing is published below {root}")
    return f"{root}/versions/{known[-1][1]}"


def read_current(spark: SparkSession, root: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{current(spark, root)}/{table}")
