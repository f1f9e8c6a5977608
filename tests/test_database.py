"""The JDBC source needs a database, which tests do not start; what is around it is tested."""

import logging

import pytest
from conftest import tuples

from snapsync.sources import database


def test_either_query_or_table(spark):
    with pytest.raises(ValueError):
        database.jdbc_scan(spark, {})
    with pytest.raises(ValueError):
        database.jdbc_scan(spark, {}, query="select 1", table="t")
    with pytest.raises(ValueError, match="split"):
        database.jdbc_scan(spark, {}, table="t")


def test_failing_statement_is_logged_without_options(spark, caplog):
    options = {"url": "jdbc:none:x", "driver": "no.such.Driver", "password": "hidden"}
    with caplog.at_level(logging.ERROR), pytest.raises(Exception):
        database.jdbc_scan(spark, options, query="select one thing", single_task=True)
    message = caplog.records[0].getMessage()
    assert "select one thing" in message and "hidden" not in message


def test_empty_strings_as_null(spark):
    df = spark.createDataFrame([("", 1), ("x", 2)], "a string, n int")
    assert tuples(database.empty_to_null(df)) == [("x", 2), (None, 1)]


def test_bind_values(spark):
    spark.createDataFrame([("a'b", None), ("c", "x")], "k string, v string").createOrReplaceTempView("kv")
    sql = "select * from kv where k = :key"
    assert tuples(database.bound_query(spark, sql, key="a'b")) == [("a'b", "")]
    assert tuples(database.bound_query(spark, sql, fill_nulls=False, key="a'b")) == [("a'b", None)]
