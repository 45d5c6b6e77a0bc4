"""Readers: Parquet and warehouse tables, JDBC queries, CSV hand-off files."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ebbtide.sources import schemas


class Sources:
    """The source tables of one deployment, as Parquet folders ``<root>/<name>``.

    Write ``activity`` partitioned by ``date_of_event``: every job filters on it
    with literals, so whole days are skipped.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        if name not in schemas.SOURCES:
            raise AttributeError(name)
        return self.spark.read.schema(schemas.SOURCES[name]).parquet(f"{self.root}/{name}")

    def item_factors(self, product: str, n: int) -> DataFrame:
        return self.spark.read.schema(schemas.item_factors(n)).parquet(
            f"{self.root}/item_factors_{product}")


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.read.table(name)


def read_query(spark: SparkSession, sql: str, args: dict | None = None) -> DataFrame:
    """Parameterised query; ``args`` are bound, never pasted into the text."""
    return spark.sql(sql, args=args or {})


def read_jdbc(spark: SparkSession, url: str, query: str, properties: dict, *,
              partition_column: str | None = None, lower: str | None = None,
              upper: str | None = None, partitions: int = 1) -> DataFrame:
    """Warehouse query over JDBC, split by a column so that executors read in parallel."""
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", f"({query}) q")
    for key, value in properties.items():
        reader = reader.option(key, value)
    if partition_column:
        reader = (reader.option("partitionColumn", partition_column)
                  .option("lowerBound", lower).option("upperBound", upper)
                  .option("numPartitions", partitions))
    return reader.load()


def read_csv(spark: SparkSession, path: str, schema: T.StructType, *, header: bool = True,
             delimiter: str = ",") -> DataFrame:
    """Typed CSV: empty fields are NULL, short rows are padded with NULL.

    A quoted field may hold line feeds, and quotes written twice.
    """
    return (spark.read.schema(schema).option("header", header).option("sep", delimiter)
            .option("nullValue", "").option("mode", "PERMISSIVE").option("enforceSchema", True)
            .option("multiLine", True).option("escape", '"').csv(path))


FAULTS = "array<struct<column:string,type:string,value:string>>"


@dataclass(frozen=True)
class Loaded:
    """Typed rows of a CSV load, and the rows it refused."""

    rows: DataFrame
    rejects: DataFrame
    n_rows: int
    n_rejects: int


class TooManyRejects(ValueError):
    """More rows than allowed have a value of the wrong type."""


def load_csv(spark: SparkSession, path: str, schema: T.StructType, rejects: str, *,
             most: float = 0.0, header: bool = True, delimiter: str = ",") -> Loaded:
    """CSV rows whose values all fit their types; the others are stored below ``rejects``.

    A reject holds the file, its fields as text, and for each value that does not fit the
    column, the type and the value. Empty fields are NULL, short rows are padded with NULL, fields
    beyond the last column are left out; none of this makes a reject. Rejects are written first; a
    share of them above ``most`` of all rows is an error, and nothing is loaded.
    """
    names = schema.fieldNames()
    texts = T.StructType([T.StructField(n, T.StringType()) for n in names])
    raw = read_csv(spark, path, texts, header=header, delimiter=delimiter)
    faults = [F.when(F.col(f"`{f.name}`").isNotNull()
                     & F.col(f"`{f.name}`").try_cast(f.dataType).isNull(),
                     F.struct(F.lit(f.name).alias("column"),
                              F.lit(f.dataType.simpleString()).alias("type"),
                              F.col(f"`{f.name}`").alias("value")))
              for f in schema if not isinstance(f.dataType, T.StringType)]
    wrong = (F.array_compact(F.array(*faults)) if faults else F.array()).cast(FAULTS)
    checked = raw.withColumn("_wrong", wrong)
    refused = F.size("_wrong") > 0
    checked.where(refused).select(
        F.input_file_name().alias("file"), F.struct(*[f"`{n}`" for n in names]).alias("fields"),
        F.col("_wrong").alias("faults")).write.mode("overwrite").parquet(rejects)
    stored = spark.read.parquet(rejects)
    n_rejects = stored.count()
    n_rows = raw.count()
    if n_rejects > most * n_rows:
        raise TooManyRejects(f"{n_rejects} of {n_rows} rows below {path} do not fit their types; "
                             f"see {rejects}")
    rows = checked.where(~refused).select(*[
        F.col(f"`{f.name}`").try_cast(f.dataType).alias(f.name) for f in schema])
    return Loaded(rows, stored, n_rows, n_rejects)


__all__ = ["Sources", "read_table", "read_query", "read_jdbc", "read_csv", "load_csv",
           "Loaded", "TooManyRejects"]
