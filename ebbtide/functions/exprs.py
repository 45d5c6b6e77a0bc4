"""Column expressions used by several jobs. All stay inside code generation."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, functions as F


def hash_number(key: str, salt: str) -> Column:
    """Uniform number in [0, 2^32) that depends on key and salt only."""
    return F.expr(f"CAST(conv(substr(md5(concat(CAST(`{key}` AS STRING), '{salt}')), 1, 8), "
                  "16, 10) AS BIGINT)")


def hash_bucket(key: str, salt: str, n: int) -> Column:
    return (hash_number(key, salt) % n).cast("int")


def week_of(day: Column) -> Column:
    """Monday of the week."""
    return F.date_trunc("week", day).cast("date")


def weeks_between(earlier: Column, later: Column) -> Column:
    """Number of Mondays passed; both sides are week starts."""
    return (F.datediff(later, earlier) / 7).cast("int")


def clean(value: Column, sentinels: Iterable[str]) -> Column:
    return F.when(~value.isin(*sentinels), value)


def tleo_ladder(columns: Sequence[str], sentinels: Iterable[str]) -> Column:
    """First column that holds a real value."""
    return F.coalesce(*[clean(F.col(c), sentinels) for c in columns])


def tleo_level(columns: Sequence[str], sentinels: Iterable[str]) -> Column:
    """Name of the column that ``tleo_ladder`` picks."""
    return F.coalesce(
        *[F.when(clean(F.col(c), sentinels).isNotNull(), F.lit(c)) for c in columns])


# The builders below return SQL text: long generated lists are parsed in one go
# by selectExpr or expr, where column objects would each cost several JVM calls.

def share(part: str, total: str) -> str:
    return (f"CASE WHEN {total} > 0 THEN CAST({part} AS DOUBLE) / CAST({total} AS DOUBLE) "
            "ELSE 0.0D END")


def argmax_label(shares: Sequence[tuple[str, str]]) -> str:
    """Label of the greatest share; the earlier label wins a tie."""
    top = "greatest(" + ", ".join(value for value, _ in shares) + ")"
    arms = " ".join(f"WHEN {value} = {top} THEN '{label}'" for value, label in shares)
    return f"CASE {arms} ELSE '{shares[-1][1]}' END"


def conditional_sum(condition: str, measure: str, zero: str = "0") -> str:
    return f"sum(CASE WHEN {condition} THEN {measure} ELSE {zero} END)"


def plus(columns: Iterable[str]) -> str:
    return "(" + " + ".join(columns) + ")"


def quoted(value: str) -> str:
    """SQL literal of a text."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def exprs(texts: Iterable[str]) -> list[Column]:
    return [F.expr(t) for t in texts]


def distinct_days(day: str, origin: str, condition: str = "TRUE", *, span: int = 91) -> Column:
    """count(distinct day) for days within ``span`` days of origin.

    Each day is one bit of a long, so the count is an ordinary hash aggregate:
    it combines on the map side and needs one shuffle, not two.
    """
    offset = f"datediff({day}, {origin})"

    def bits(low: int, high: int) -> str:
        return (f"bit_count(bit_or(CASE WHEN {condition} AND {offset} BETWEEN {low} AND {high} "
                f"THEN shiftleft(1L, {offset} - {low}) ELSE 0L END))")

    masks = plus(bits(low, low + 59) for low in range(0, span, 60))
    return F.expr(f"CAST({masks} AS BIGINT)")
