import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession
    built = (SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "3")
             .config("spark.ui.enabled", "false").config("spark.sql.session.timeZone", "UTC")
             .config("spark.driver.memory", "4g")
             .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true").getOrCreate())
    built.sparkContext.setLogLevel("ERROR")
    yield built
    built.stop()


def rows(df, *columns):
    return sorted((tuple(r) for r in (df.select(*columns) if columns else df).collect()), key=repr)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()
