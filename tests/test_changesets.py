from dataclasses import replace

import pytest
from conftest import at, tuples
from pyspark.sql import functions as F

from snapsync.operators.changesets import author_islands, changeset_messages, changesets
from snapsync.settings import Settings

GROUPS = ("source_db", "changeset_id")
SCHEMA = (
    "source_db string, type string, class_id string, short_name string, modified timestamp_ntz, "
    "user_modified string"
)


def change(user, minute, name="N", cls="C", db="a"):
    stamp = None if minute is None else at("2024-05-01 10:00:00").replace(minute=minute)
    return (db, "METHOD", cls, name, stamp, user)


@pytest.mark.parametrize("how", ["window", "ranges"])
def test_islands_with_unknown_users(spark, how):
    rows = [
        change(None, 1, "A"), change(None, 2, "B"), change("u", 3, "C"), change(None, 4, "D"),
        change("u", 5, "E"), change("u", 5, "F"), change("v", None, "G"), change("u", 9, "H", db="b"),
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    got = author_islands(df, how=how)
    assert tuples(got, "short_name", "changeset_id") == [
        ("A", 1), ("B", 1), ("C", 2), ("D", 3), ("E", 4), ("F", 4), ("G", 5), ("H", 1),
    ]


def test_change_set_facts_and_message(spark):
    rows = [
        change("u", 1, "N2", "C1"), change("u", 2, "N1", "C1"), change("u", 3, "N1", "C1"),
        change("u", 4, "N3", "C0"), change("", 5, "X"), change(None, 6, "Y"),
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    islands = author_islands(df)
    messages = changeset_messages(islands, GROUPS)
    got = changesets(islands, shift_days=F.lit(1)).join(messages, list(GROUPS))
    unknown = Settings.unknown_author
    assert tuples(
        got, "changeset_id", "author", "author_email", "committer", "author_time", "n_rows", "message"
    ) == [
        (1, "u", "u@mail", "sources_sync_job", "02.05.2024T07:01:00", 4,
         "autosave C0 [N3], C1 [N1, N2]"),
        (2, unknown, f"{unknown}@mail", "sources_sync_job", "02.05.2024T07:05:00", 1,
         "autosave C [X]"),
        (3, unknown, f"{unknown}@mail", "sources_sync_job", "02.05.2024T07:06:00", 1,
         "autosave C [Y]"),
    ]


def test_null_classes_and_names_are_not_listed(spark):
    df = spark.createDataFrame([change("u", 1, None, "C"), change("u", 2, "N", None)], SCHEMA)
    islands = author_islands(df)
    assert tuples(changesets(islands), "n_rows", "n_messages") == [(2, 1)]
    assert tuples(changeset_messages(islands, GROUPS), "message") == [("autosave C []",)]
    islands = author_islands(spark.createDataFrame([change("u", 2, "N", None)], SCHEMA))
    assert tuples(changesets(islands), "n_rows", "n_messages") == [(1, 0)]
    assert changeset_messages(islands, GROUPS).isEmpty()


@pytest.mark.parametrize("how", ["window", "ranges"])
def test_a_large_change_set_goes_on_in_further_messages(spark, how):
    rows = [change("u", 1, f"N{i}", f"C{i // 3}") for i in range(5)]
    settings = replace(Settings(), names_per_message=2)
    islands = author_islands(spark.createDataFrame(rows, SCHEMA))
    # one row per change set, so that the sets' rows add up to all rows
    assert tuples(changesets(islands, settings=settings), "n_rows", "n_messages") == [(5, 3)]
    got = changeset_messages(islands, GROUPS, settings, how)
    assert tuples(got, "message_no", "n_objects", "message") == [
        (0, 2, "autosave C0 [N0, N1]"),
        (1, 2, "autosave C0 [N2], C1 [N3]"),
        (2, 1, "autosave C1 [N4]"),
    ]
