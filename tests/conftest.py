import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from silverthread import session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    built = (
        SparkSession.builder.master("local[8]")
        .appName("silverthread-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("checkpoint")))
        .getOrCreate()
    )
    built.sparkContext.setLogLevel("ERROR")
    yield session.tune(built)
    built.stop()


@pytest.fixture
def conf(spark):
    """Set runtime settings for one test."""
    saved = {}

    def set_(key, value):
        saved.setdefault(key, spark.conf.get(key, None))
        spark.conf.set(key, value)

    yield set_
    for key, value in saved.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


@pytest.fixture
def rows():
    """Rows of a frame as sorted tuples."""

    def collect(df, *columns):
        picked = df.select(*columns) if columns else df
        return sorted((tuple(r) for r in picked.collect()), key=repr)

    return collect
