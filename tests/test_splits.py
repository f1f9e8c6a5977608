import pytest
from conftest import at
from pyspark.sql import functions as F

from snapsync.sources import database
from snapsync.sources.splits import plan_splits, scan_in_splits


def sizes(rows, splits):
    """Rows by split; each row must fulfil exactly one predicate."""
    each = [F.coalesce(F.expr(s), F.lit(False)).cast("int") for s in splits]
    assert rows.where(sum(each[1:], each[0]) != 1).count() == 0
    return list(rows.agg(*[F.sum(e).alias(f"s{i}") for i, e in enumerate(each)]).first())


def test_even_keys(spark):
    rows = spark.range(10_000).select((F.col("id") * 7 % 100_003).alias("k"))
    splits = plan_splits(rows, "k", 8)
    assert len(splits) == 9 and splits[0] == "k is null"
    assert all(1150 < n < 1350 for n in sizes(rows, splits)[1:])
    assert scan_in_splits(rows, splits).count() == 10_000


def test_one_key_and_nulls_hold_a_third_each(spark):
    key = F.when(F.col("id") % 3 == 0, 500).when(F.col("id") % 3 == 1, F.col("id"))
    rows = spark.range(9_000).select(key.cast("long").alias("k"), F.col("id").alias("other"))
    alone = sizes(rows, plan_splits(rows, "k", 9))
    assert max(alone) >= 3_000
    both = sizes(rows, plan_splits(rows, "k", 9, "other"))
    assert max(both) <= 1_600 and sum(both) == 9_000


def test_keys_that_the_sketch_has_not_seen(spark):
    splits = plan_splits(spark.range(100).toDF("k"), "k", 4)
    later = spark.createDataFrame([(-5,), (None,), (10**12,), (50,)], "k long")
    assert sum(sizes(later, splits)) == 4


@pytest.mark.parametrize("kind", ["date", "timestamp_ntz", "decimal(12,2)", "int"])
def test_kinds_of_keys(spark, kind):
    value = F.col("id") if kind in ("int", "decimal(12,2)") else F.lit(at("2024-01-01")) + F.make_dt_interval(F.col("id").cast("int"))
    rows = spark.range(400).select(value.cast(kind).alias("k"))
    assert all(n > 60 for n in sizes(rows, plan_splits(rows, "k", 5))[1:])


def test_small_and_empty_tables(spark):
    one = spark.range(1).toDF("k")
    for rows, n in ((one, 1), (one, 8), (one.limit(0), 4), (one.select(F.lit(None).cast("long").alias("k")), 4)):
        assert sum(filter(None, sizes(rows, plan_splits(rows, "k", n)))) == rows.count()
    assert plan_splits(one, "k", 1) == ["k is null", "k is not null"]
    with pytest.raises(ValueError):
        plan_splits(one, "k", 0)
    with pytest.raises(TypeError):
        plan_splits(spark.createDataFrame([("a",)], "k string"), "k", 2)


def test_predicates_reach_the_reader(spark, monkeypatch):
    asked = {}

    def jdbc(self, url, table, predicates=None, properties=None):
        asked.update(url=url, table=table, predicates=predicates, properties=properties)
        return spark.range(1)

    monkeypatch.setattr(type(spark.read), "jdbc", jdbc)
    database.jdbc_scan(spark, {"url": "jdbc:x", "user": "u"}, query="select 1", split=["k < 1", "k >= 1"])
    assert asked == {
        "url": "jdbc:x", "table": "(select 1) q", "predicates": ["k < 1", "k >= 1"],
        "properties": {"fetchsize": "10000", "user": "u"},
    }
