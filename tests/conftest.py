import os
import sys

import pytest
from pyspark.sql import SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (SparkSession.builder.master("local[4]").appName("tests")
               .config("spark.sql.shuffle.partitions", "4")
               .config("spark.ui.enabled", "false")
               .config("spark.driver.memory", "4g")
               .config("spark.sql.session.timeZone", "UTC")
               .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("checkpoints")))
               .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
               .getOrCreate())
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def folder():
    if not os.path.isdir(FOLDER):
        pytest.skip("test tables not present")
    return FOLDER


@pytest.fixture(scope="session")
def make(spark):
    """Rows of a source schema; columns left out are NULL."""
    def build(schema, *rows):
        names = schema.fieldNames()
        for row in rows:
            assert set(row) <= set(names), set(row) - set(names)
        return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], schema)

    return build
