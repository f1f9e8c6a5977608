"""The way over ranges must equal the window and a plain loop, also with one hot group."""

import random
from itertools import groupby

import pytest
from conftest import tuples
from pyspark.sql import functions as F

from snapsync.operators.ordering import latest_row, number_rows, number_runs, with_previous


def made_rows(seed, n=600):
    """A third of the rows in one group; null groups and null values occur."""
    rng = random.Random(seed)
    groups = ["hot"] * 4 + ["a", "b", "c", "d", None]
    return [(rng.choice(groups), i, rng.choice(["u", "v", None])) for i in range(n)]


def in_groups(rows):
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or "", r[1]))
    return [list(g) for _, g in groupby(rows, key=lambda r: r[0])]


@pytest.fixture(params=[1, 2])
def rows(request):
    return made_rows(request.param)


@pytest.fixture
def df(spark, rows):
    return spark.createDataFrame(rows, "g string, t int, v string").repartition(3)


@pytest.mark.parametrize("how", ["window", "ranges"])
def test_number_rows(df, rows, how):
    want = [(*r, i) for group in in_groups(rows) for i, r in enumerate(group, 1)]
    assert tuples(number_rows(df, ["g"], ["t"], how=how)) == sorted(want, key=repr)


@pytest.mark.parametrize("how", ["window", "ranges"])
def test_with_previous(df, rows, how):
    want = []
    for group in in_groups(rows):
        for i, r in enumerate(group):
            want.append((*r, i > 0, group[i - 1][2] if i else None))
    got = with_previous(df, ["g"], ["t"], F.col("v"), how=how).select(
        "g", "t", "v", F.col("previous").isNotNull(), "previous.value"
    )
    assert tuples(got) == sorted(want, key=repr)


@pytest.mark.parametrize("how", ["window", "ranges"])
def test_number_runs(df, rows, how):
    want = []
    for group in in_groups(rows):
        run = 0
        for i, r in enumerate(group):
            run += i == 0 or group[i - 1][2] != r[2]
            want.append((*r, run))
    assert tuples(number_runs(df, ["g"], ["t"], F.col("v"), how=how)) == sorted(want, key=repr)


def test_one_long_run_over_all_ranges(spark):
    df = spark.range(1000).select(F.lit("g").alias("g"), "id", F.lit("u").alias("u"))
    got = number_runs(df, ["g"], ["id"], F.col("u"), how="ranges")
    assert got.select("run").distinct().collect() == [(1,)]


def test_ranges_spread_one_group_over_tasks(spark):
    from snapsync.operators.ordering import SLICE, _ranges

    df = spark.range(20000).select(F.lit("g").alias("g"), "id")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        slices = _ranges(df, ["g"], ["id"]).groupBy(SLICE).count().collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(slices) == 4
    assert max(r["count"] for r in slices) < 12000


def test_unknown_way_is_refused(df):
    with pytest.raises(ValueError):
        number_rows(df, ["g"], ["t"], how="fast")


def test_latest_row_cuts_before_the_shuffle(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", None)], "k string, t int")
    newest = latest_row(df, ["k"], [F.desc_nulls_last("t")])
    plan = newest._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    assert tuples(newest) == [("a", 2), ("b", None)]
