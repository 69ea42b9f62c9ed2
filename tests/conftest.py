import os
import sys

import pytest
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (SparkSession.builder.master("local[4]").appName("tests")
               .config("spark.ui.enabled", "false").config("spark.driver.memory", "6g")
               .config("spark.sql.shuffle.partitions", "4")
               .config("spark.sql.session.timeZone", "UTC").getOrCreate())
    session.sparkContext.setLogLevel("ERROR")
    session.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("checkpoint")))
    yield session
    session.stop()


@pytest.fixture
def column_of(spark):
    """Values of one expression over a one-column table, in order."""
    def apply(values, expression, kind="string"):
        rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
        return [r["y"] for r in rows.select("i", expression(F.col("x")).alias("y")).orderBy("i").collect()]
    return apply
