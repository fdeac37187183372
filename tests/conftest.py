import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession
    s = (SparkSession.builder.master("local[*]").appName("shelfwise-tests")
         .config("spark.sql.shuffle.partitions", "8").config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false").config("spark.sql.session.timeZone", "UTC")
         .config("spark.checkpoint.dir", f"file://{tmp_path_factory.mktemp('tables')}")
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    yield s


@pytest.fixture(scope="session")
def small_pipe(spark):
    from shelfwise.plans.pipeline import Pipeline
    return Pipeline(spark, SF_SMALL)


@pytest.fixture(scope="session")
def mid_pipe(spark):
    from shelfwise.plans.registry import pipe
    return pipe(spark, SF_MID)
