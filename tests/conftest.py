import os
import sys
from datetime import datetime

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.driver.memory", "4g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def column(spark):
    """Values of an expression over a list of texts."""

    def values(texts, expression, name="c"):
        df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], f"i int, {name} string")
        return [row.v for row in df.select("i", expression.alias("v")).orderBy("i").collect()]

    return values


def at(text):
    return datetime.fromisoformat(text)


def tuples(df, *columns):
    rows = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in rows.collect()), key=repr)
