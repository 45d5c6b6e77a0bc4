"""Devices: how many, which share of use, which preferred."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ebbtide.config import DEVICE_TYPES, PRODUCTS, ChurnConfig
from ebbtide.functions.exprs import (
    argmax_label, conditional_sum, distinct_days, exprs, plus, share)
from ebbtide.operators.activity import destination_product, long_enough
from ebbtide.operators.cohorts import cohort_date

MEASURES = {"st": "streaming_time", "ev": "events"}


def device_app_type(device: str = "device_type", browser: str = "browser_brand") -> Column:
    kind, app = F.col(device), F.col(browser) == "Applications"
    return (F.when(kind == "Desktop", "desktop-web")
            .when(kind == "Smart TV", "smart-tv")
            .when((kind == "Smartphone") & app, "mobile-app")
            .when((kind == "Smartphone") & ~app, "mobile-web")
            .when((kind == "Tablet") & app, "tablet-app")
            .when((kind == "Tablet") & ~app, "tablet-web")
            .otherwise("other-web"))


def device_usage(windowed: DataFrame, cfg: ChurnConfig) -> DataFrame:
    """(user, fresh, product, device, app type): time and distinct days; radio left out."""
    rows = windowed.where(long_enough(windowed, "is_event", cfg.event_seconds)).select(
        "user_id", "fresh", destination_product(cfg).alias("product"), "device_type",
        device_app_type().alias("app_type"), "playback_time", "date_of_event",
        cohort_date("min_date", cfg).alias("_origin"))
    return rows.where(F.col("product") != "radio").groupBy(
        "user_id", "fresh", "product", "device_type", "app_type").agg(
        F.sum("playback_time").cast("double").alias("streaming_time"),
        distinct_days("date_of_event", "_origin").cast("double").alias("events"))


KEY = ("user_id", "fresh")


def _per_device(usage: DataFrame) -> DataFrame:
    """(user, fresh, product, device): sums per app type; a device counts once per product."""
    return usage.groupBy(*KEY, "product", "device_type").agg(*exprs(
        f"{conditional_sum(f'app_type = {label!r}', c, '0.0D')} AS {m}_{n}"
        for m, c in MEASURES.items() for n, label in DEVICE_TYPES))


def _device_count(product: str) -> str:
    return (f"count(CASE WHEN product = '{product}' THEN device_type END) "
            f"AS {product}_device_count")


def _device_sums() -> list[str]:
    """Tablet types are classified but not summed, so they are in no total."""
    return [f"{conditional_sum(f'product = {p!r}', f'{m}_{n}', '0.0D')} AS _{p}_{m}_{n}"
            for p in PRODUCTS for m in MEASURES for n, _ in DEVICE_TYPES]


def _with_shares(sums: DataFrame) -> DataFrame:
    shares = []
    for p in PRODUCTS:
        for m in MEASURES:
            total = plus(f"_{p}_{m}_{n}" for n, _ in DEVICE_TYPES)
            shares += [share(f"_{p}_{m}_{n}", total) + f" AS device_{p}_{m}_{n}_perc"
                       for n, _ in DEVICE_TYPES]
    return sums.selectExpr(*[c for c in sums.columns if not c.startswith("_")], *shares)


def device_counts(usage: DataFrame) -> DataFrame:
    return _per_device(usage).groupBy(*KEY).agg(*exprs(_device_count(p) for p in PRODUCTS))


def device_shares(usage: DataFrame) -> DataFrame:
    return _with_shares(_per_device(usage).groupBy(*KEY).agg(*exprs(_device_sums())))


def preferred_device(product: str, measure: str) -> str:
    return argmax_label([(f"device_{product}_{measure}_{n}_perc", label)
                         for n, label in DEVICE_TYPES])


def device_features(usage: DataFrame) -> DataFrame:
    """Counts, 20 shares and 4 preferred labels in one aggregation."""
    both = _per_device(usage).groupBy(*KEY).agg(
        *exprs(_device_count(p) for p in PRODUCTS), *exprs(_device_sums()))
    return _with_shares(both).selectExpr("*", *[
        f"{preferred_device(p, m)} AS device_{p}_{m}_preferred"
        for p in PRODUCTS for m in MEASURES])
