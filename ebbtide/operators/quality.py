"""Data-quality checks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from ebbtide.functions.exprs import exprs, quoted


class CheckFailed(Exception):
    pass


def expect_empty(df: DataFrame, name: str, level: str = "error") -> DataFrame:
    """Report row of a check whose query must return no rows: name, status, n, one example."""
    row = F.to_json(F.struct(*df.columns))
    return df.select(row.alias("row")).agg(
        F.count(F.lit(1)).alias("n"), F.min("row").alias("example")).select(
        F.lit(name).alias("check_name"),
        F.when(F.col("n") == 0, "pass").otherwise(F.lit(level)).alias("status"),
        "n", "example")


def require_empty(df: DataFrame, name: str) -> None:
    """Raises if the check's query returns rows."""
    report = expect_empty(df, name).first()
    if report["n"]:
        raise CheckFailed(f"{name}: {report['n']} rows, for example\n{report['example']}")


def duplicate_key_check(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def _one_row_per_column(df: DataFrame, columns: Sequence[str], measures: dict) -> DataFrame:
    """One pass over df; measures is name -> function(column) -> aggregate as SQL text."""
    row = df.agg(*exprs(
        f"struct({quoted(c)} AS column_name, "
        + ", ".join(f"{m(f'`{c}`')} AS {n}" for n, m in measures.items()) + f") AS _{i}"
        for i, c in enumerate(columns)))
    packed = ", ".join(f"_{i}" for i in range(len(columns)))
    return row.selectExpr(f"inline(array({packed}))")


def na_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column): number of NULLs, all columns in one aggregation."""
    return _one_row_per_column(df, columns or df.columns, {
        "n_null": lambda c: f"count_if({c} IS NULL)"})


def invariate_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column): population variance, whether it is empty, whether models should drop it."""
    table = _one_row_per_column(df, columns, {
        "n_values": lambda c: f"count({c})",
        "variance": lambda c: f"var_pop(CAST({c} AS DOUBLE))",
        "low": lambda c: f"min(CAST({c} AS DOUBLE))",
        "high": lambda c: f"max(CAST({c} AS DOUBLE))"})
    empty = F.col("n_values") == 0
    flat = empty | (F.col("low") == F.col("high"))
    return table.select(
        "column_name", F.when(flat & ~empty, F.lit(0.0)).otherwise(F.col("variance"))
        .alias("variance"), empty.cast("int").alias("is_empty"), flat.cast("int").alias("drop"))


def flat_columns(df: DataFrame, columns: Sequence[str], at_once: int = 40) -> list[str]:
    """The columns that ``invariate_columns`` would drop, without their variance.

    Columns are read a few at a time, so that Spark generates code for whole stages, which it does
    not for more than 100 fields.
    """
    out = []
    for start in range(0, len(columns), at_once):
        some = list(columns[start:start + at_once])
        row = df.select(*some).agg(*exprs(
            f"coalesce(min(CAST(`{c}` AS DOUBLE)) = max(CAST(`{c}` AS DOUBLE)), TRUE) AS `{c}`"
            for c in some)).first()
        out += [c for c in some if row[c]]
    return out


def class_balance(df: DataFrame, label: str) -> DataFrame:
    return df.agg(
        F.count(label).alias("size"),
        F.sum(F.col(label).cast("bigint")).alias("positives"),
        F.avg(F.col(label).cast("double")).alias("density"))
