"""Share of playback per hour band and weekday."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ebbtide.config import HOUR_BANDS, WEEKDAYS, ChurnConfig
from ebbtide.functions.exprs import conditional_sum, exprs, plus, share
from ebbtide.operators.activity import destination_product


def time_of_day_shares(windowed: DataFrame, cfg: ChurnConfig,
                       product: str | None = None) -> DataFrame:
    """(user, fresh, product); with ``product`` given only that one, keyed (user, fresh)."""
    rows = windowed.select(
        "user_id", "fresh", destination_product(cfg).alias("product"), "playback_time",
        F.hour("event_ts").alias("_hour"), F.weekday("date_of_event").alias("_day"))
    keys = ["user_id", "fresh"]
    if product is None:
        keys.append("product")
    else:
        rows = rows.where(F.col("product") == product)
    bands = {f"tod_{n}": f"_hour BETWEEN {a} AND {b}" for n, a, b in HOUR_BANDS}
    days = {f"dow_{n}": f"_day = {i}" for i, n in enumerate(WEEKDAYS)}
    sums = rows.groupBy(*keys).agg(*exprs(
        f"{conditional_sum(rule, 'playback_time')} AS _{n}"
        for n, rule in {**bands, **days}.items()))
    total = plus(f"_{n}" for n in days)
    return sums.selectExpr(*keys, *[f"{share(f'_{n}', total)} AS {n}" for n in [*bands, *days]])
