from __future__ import annotations

import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tests.golden import golden_raw  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]").appName("ledgerloom-tests")
        .config("spark.sql.shuffle.partitions", "2")
        # Tiny inputs: interpreting is faster than compiling a class per stage.
        .config("spark.sql.codegen.wholeStage", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "4g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def golden(spark):
    """The seven-order scenario with every table written once."""
    from ledgerloom.plans.model import Model
    from ledgerloom.sources.store import table_writer

    raw = golden_raw(spark)
    return Model(lambda name: raw[name], table_writer(spark))
