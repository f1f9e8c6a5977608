"""Validity intervals and snapshots as of polls, change sets and times."""

import pytest
from conftest import at, tuples
from pyspark.sql import functions as F
from test_poll import feed, states

from snapsync.plans import history, poll
from snapsync.plans.store import Store, epoch_snapshot

VERSIONS = "source_db string, epoch string, path string, modified timestamp_ntz, text_sha string, poll_no long, changeset_id long, removed boolean"


def versions(spark, *rows):
    full = [(db, e, p, at(f"2024-06-{n:02}"), sha, n, c, sha is None) for db, e, p, sha, n, c in rows]
    return spark.createDataFrame(full, VERSIONS)


SOME = [
    ("a", "e", "p", "1", 1, 1), ("a", "e", "p", "2", 3, 2), ("a", "e", "p", None, 5, None),
    ("a", "e", "p", "3", 6, 1), ("a", "e", "q", "1", 3, 1), ("a", "master", "q", "0", 2, None),
    ("a", "master", "r", "9", 4, None), ("b", "e", "p", "b", 2, 1), (None, "e", "p", "n", 1, 1),
]


@pytest.mark.parametrize("how", ["window", "ranges"])
def test_intervals(spark, how):
    found = history.validity(versions(spark, *SOME), how=how).where("source_db = 'a' and path = 'p'")
    assert tuples(found, "valid_from", "from_set", "valid_to", "to_set", "text_sha") == [
        (1, 1, 3, 2, "1"), (3, 2, 5, history.END_OF_POLL, "2"),
        (5, history.END_OF_POLL, 6, 1, None), (6, 1, None, None, "3"),
    ]


def test_every_point_equals_a_replay(spark):
    rows = versions(spark, *SOME)
    intervals = history.validity(rows).cache()
    epochs = spark.createDataFrame([("a", "e"), ("b", "e")], "source_db string, epoch string")
    for number in range(0, 8):
        points = epochs.withColumn("poll_no", F.lit(number).cast("long"))
        replayed = epoch_snapshot(rows.where(F.col("poll_no") <= number), epochs)
        columns = ("source_db", "path", "text_sha")
        assert tuples(history.snapshot_as_of(intervals, points), *columns) == tuples(replayed, *columns)


def test_within_a_poll(spark):
    intervals = history.validity(versions(spark, *SOME))

    def at_point(*point):
        points = spark.createDataFrame([("a", "e", *point)], "source_db string, epoch string, poll_no long, changeset_id long")
        return tuples(history.snapshot_as_of(intervals, points), "path", "text_sha")

    assert at_point(3, 0) == [("p", "1"), ("q", "0")]
    assert at_point(3, 1) == [("p", "1"), ("q", "1")]
    assert at_point(3, 2) == at_point(3, None) == [("p", "2"), ("q", "1")]
    # a removal comes at the end of its poll
    assert at_point(5, 7) == [("p", "2"), ("q", "1"), ("r", "9")]
    assert at_point(5, None) == [("q", "1"), ("r", "9")]


def test_versions_of_one_place(spark):
    """Of several versions of a path in one poll the newest counts."""
    rows = versions(spark, ("a", "e", "p", "1", 1, 1), ("a", "e", "p", "2", 2, 1))
    rows = rows.withColumn("poll_no", F.lit(4).cast("long"))
    assert tuples(history.validity(rows), "text_sha", "valid_to") == [("2", None)]
    assert history.validity(rows.limit(0)).count() == 0


def test_a_store_shows_its_past(spark, tmp_path):
    store = Store(str(tmp_path / "store")).create(spark)
    drops = [
        [("N1", "2024-06-01", "u", "1"), ("N2", "2024-06-02", "v", "1")],
        [("N1", "2024-06-03", "u", "2"), ("N3", "2024-06-04", "w", "3")],
        [("N1", "2024-06-05", "u", "1")],
    ]
    listed = spark.createDataFrame(
        [("a", "VIEW", "C", "N1"), ("a", "VIEW", "C", "N3")],
        "source_db string, type string, class_id string, short_name string",
    )
    for number, drop in enumerate(drops):
        rows = feed(spark, *[("a", *r) for r in drop])
        now = states(spark, ("a", "e", f"2024-06-1{number}"))
        poll.capture(rows, now, store, listing=listed if number == 2 else None)
        if number == 1:
            store.fold(spark)
    control = store.control(spark)
    seen = []
    for day in ("2024-06-09", "2024-06-10", "2024-06-11", "2024-07-01"):
        times = spark.createDataFrame([("a", at(day))], "source_db string, as_of timestamp_ntz")
        seen.append(tuples(store.as_of(spark, history.points_at(control, times)), "path", "text"))
    assert seen == [
        [],
        [("C/N1.sql", "1"), ("C/N2.sql", "1")],
        [("C/N1.sql", "2"), ("C/N2.sql", "1"), ("C/N3.sql", "3")],
        [("C/N1.sql", "1"), ("C/N3.sql", "3")],
    ]
    # after the first change set of the second poll
    point = spark.createDataFrame([("a", "e", 2, 1)], "source_db string, epoch string, poll_no long, changeset_id long")
    assert tuples(store.as_of(spark, point), "path", "text") == [("C/N1.sql", "2"), ("C/N2.sql", "1")]
    store.fold(spark)
    assert tuples(store.as_of(spark, point), "path", "text") == [("C/N1.sql", "2"), ("C/N2.sql", "1")]
    two, three = (point.select("source_db", "epoch", F.lit(n).cast("long").alias("poll_no")) for n in (2, 3))
    assert tuples(history.changed_between(store.as_of(spark, two), store.as_of(spark, three)), "path", "change") == [
        ("C/N1.sql", "changed"), ("C/N2.sql", "removed"),
    ]


def test_points_at(spark):
    control = spark.createDataFrame(
        [("a", "e", 1, at("2024-06-01")), ("a", "f", 3, at("2024-06-03")), ("a", "master", 4, at("2024-06-03")), ("b", "e", 2, at("2024-06-02"))],
        "source_db string, epoch string, poll_no long, high_water timestamp_ntz",
    )
    times = spark.createDataFrame([("a", at("2024-06-03")), ("b", at("2024-06-01"))], "source_db string, as_of timestamp_ntz")
    assert tuples(history.points_at(control, times)) == [("a", "f", 3)]
