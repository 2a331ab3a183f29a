import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "6g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def rows(spark):
    """Frame from dicts of strings, with scan positions in list order."""

    def build(columns, data, file="f", partitions=2):
        ddl = ", ".join(f"{c} string" for c in columns)
        ddl += ", _file string, _block bigint, _line bigint"
        values = [
            [d.get(c) for c in columns] + [d.get("_file", file), 0, i] for i, d in enumerate(data)
        ]
        return spark.createDataFrame(values, ddl).repartition(partitions)

    return build
