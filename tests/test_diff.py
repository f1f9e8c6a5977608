import random

import pytest
from conftest import tuples
from pyspark.sql import functions as F

from snapsync.functions.text import text_sha
from snapsync.operators import diff


def frame(spark, rows):
    return spark.createDataFrame(rows, "k string, text string")


def test_indicator_treats_null_keys_as_equal(spark):
    left = frame(spark, [("a", "1"), ("a", "1"), (None, "x"), ("l", "2")])
    right = frame(spark, [("a", "1"), (None, "x"), ("r", "3")])
    assert tuples(diff.diff_indicator(left, right, ["k", "text"])) == [
        ("a", "1", "both"), ("l", "2", "left_only"), ("r", "3", "right_only"), (None, "x", "both"),
    ]


def test_stale_objects(spark):
    stored = frame(spark, [("a", ""), ("a", ""), ("b", ""), (None, ""), ("c", "")])
    source = frame(spark, [("a", ""), (None, "")])
    assert tuples(diff.stale_objects(stored, source, ["k"])) == [("b",), ("c",)]
    recent = frame(spark, [("c", "")])
    assert tuples(diff.stale_not_recent(stored, source, recent, ["k"])) == [("b",)]


def with_sha(df):
    return df.withColumn("text_sha", text_sha(F.col("text")))


def test_changed_vs_baseline(spark):
    baseline = with_sha(frame(spark, [("same", "x"), ("other", "x"), ("absent", "x"), ("n", None)]))
    rows = frame(spark, [("same", "x"), ("other", "y"), ("new", "z"), ("n", None)])
    got = diff.changed_vs_baseline(rows, baseline, ["k"])
    assert tuples(got) == [("new", "z"), ("other", "y")]


def test_upsert_deletes_on_empty_text(spark):
    stored = frame(spark, [("keep", "1"), ("new", "1"), ("empty", "1"), ("null", "1")])
    rows = frame(spark, [("new", "2"), ("empty", ""), ("null", None), ("blank", " "), ("x", "")])
    assert tuples(diff.upsert_with_delete(stored, rows, ["k"])) == [
        ("blank", " "), ("keep", "1"), ("new", "2"),
    ]


def simulated(rows, baseline):
    """Write the rows in order and keep those that change the number of dirty paths."""
    tree, dirty, kept = dict(baseline), set(), []
    for path, text, i in rows:
        tree[path] = text
        before = len(dirty)
        if baseline.get(path) == text:
            dirty.discard(path)
        else:
            dirty.add(path)
        if len(dirty) != before:
            kept.append((path, text, i))
    return kept


@pytest.mark.parametrize("how", ["window", "ranges"])
@pytest.mark.parametrize("seed", [3, 4])
def test_effective_changes_equal_the_simulation(spark, seed, how):
    rng = random.Random(seed)
    paths = ["hot"] * 5 + [f"p{i}" for i in range(10)]
    baseline = {p: rng.choice("xyz") for p in set(paths) if rng.random() < 0.7}
    rows = [(rng.choice(paths), rng.choice("xyz"), i) for i in range(300)]
    stored = with_sha(frame(spark, sorted(baseline.items())))
    df = spark.createDataFrame(rows, "k string, text string, i int").repartition(3)
    got = diff.effective_changes(df, stored, ["k"], ["i"], how=how).drop("dirty")
    assert tuples(got, "k", "text", "i") == sorted(simulated(rows, baseline), key=repr)


def test_effective_changes_small_cases(spark):
    rows = [("p", "n", 1), ("p", "o", 2), ("q", "n", 1), ("q", "m", 2), ("r", "o", 1), ("r", "o", 2)]
    stored = with_sha(frame(spark, [("p", "o"), ("q", "o"), ("r", "o")]))
    df = spark.createDataFrame(rows, "k string, text string, i int")
    got = diff.effective_changes(df, stored, ["k"], ["i"])
    # changed and reverted: both; two versions: the first; equal to the baseline: none
    assert tuples(got, "k", "i") == [("p", 1), ("p", 2), ("q", 1)]


def test_remove_and_drop(spark):
    stored = spark.createDataFrame([("VIEW", "a"), ("UNKNOWN", "b")], "type string, k string")
    assert tuples(diff.drop_unknown(stored)) == [("VIEW", "a")]
    assert tuples(diff.remove_objects(stored, stored.where("k = 'a'"), ["k"])) == [("UNKNOWN", "b")]




def test_the_ordered_pass_moves_no_texts(spark, monkeypatch):
    from snapsync.operators import ordering

    seen, write = [], ordering.written

    def recorded(df, name):
        seen.append(df.columns)
        return write(df, name)

    monkeypatch.setattr(ordering, "written", recorded)
    df = spark.createDataFrame([("p", "n", 1), ("p", "o", 2)], "k string, text string, i int")
    got = diff.effective_changes(df, with_sha(frame(spark, [("p", "o")])), ["k"], ["i"])
    assert tuples(got, "k", "text", "i") == [("p", "n", 1), ("p", "o", 2)]
    assert len(seen) == 1 and "text" not in seen[0]
