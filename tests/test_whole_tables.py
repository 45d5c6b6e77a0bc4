"""Invariants of the blocks, and every SQL twin, on the smallest test tables."""

import os
import sys

import pytest
from pyspark.sql import functions as F

from ebbtide.config import DEVICE_TYPES, PRODUCTS, WEEKDAYS
from ebbtide.plans.feature_set import Blocks, feature_columns
from ebbtide.sources.sample_tables import CONFIG, SampleTables

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))),
                                "tools"))
import check_oracles  # noqa: E402
import __spark_entry__ as entry  # noqa: E402

SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def blocks(spark, folder):
    return Blocks(SampleTables(spark, folder), CONFIG)


@pytest.fixture(scope="module")
def database(folder):
    return check_oracles.database(folder)


def test_keys_are_unique(blocks):
    for block in (blocks.cohorts, blocks.product_mix, blocks.device_features, blocks.favourites(),
                  blocks.demographics(), blocks.optin(), blocks.mail(), blocks.follows()):
        assert block.groupBy("user_id", "fresh").count().where("count > 1").isEmpty()


def test_shares_add_up(blocks):
    days = sum(F.col(f"dow_{d}") for d in WEEKDAYS)
    bad = blocks.time_of_day().where((F.abs(days - 1) > 1e-9) & (days != 0))
    assert bad.isEmpty()
    for p in PRODUCTS:
        total = sum(F.col(f"device_{p}_ev_{n}_perc") for n, _ in DEVICE_TYPES)
        assert blocks.device_features.where(
            (F.abs(total - 1) > 1e-9) & (total != 0)).isEmpty()
    assert blocks.weekly.where("genre_st_other < 0").isEmpty()


def test_contract(blocks):
    for product, size in (("video", 190), ("audio", 251)):
        names = feature_columns(product)
        assert len(names) == size
        out = blocks.feature_set(product)
        assert len(set(out.columns)) == size


def test_every_oracle_has_a_query():
    assert set(SQL) <= set(entry.queries())


HEAVY = {"feature_registry", "stack_config"}


@pytest.mark.parametrize("name", sorted(set(SQL) - HEAVY))
def test_same_as_sql(spark, folder, database, name):
    line = check_oracles.compare(
        spark, database, name, entry.queries()[name], SQL[name], folder)
    assert line.startswith("ok"), line
    assert "types differ" not in line
