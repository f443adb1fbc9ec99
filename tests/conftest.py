from __future__ import annotations

import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path[:0] = [str(Path(__file__).resolve().parents[1]), str(Path(__file__).resolve().parent)]

from helpers import EIGHT, FIVE, frame  # noqa: E402
from hybridframe.plans.session import ship  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("OFF")
    ship(session)
    return session


@pytest.fixture(scope="session")
def five(spark):
    return frame(spark, FIVE).cache()


@pytest.fixture(scope="session")
def eight(spark):
    return frame(spark, EIGHT).cache()
