"""States of diaries, kept between polls."""

import random

import pytest
from catalog_data import allowed, tables
from conftest import at, tuples
from pyspark.sql import functions as F

from snapsync.plans import diary
from snapsync.sources import catalog, folders

ENTRIES = "source_db string, id long, time timestamp_ntz, seq long, action string, user_id string"


def entries(n, seed=1):
    chosen = random.Random(seed)
    rows = []
    for seq in range(n):
        day = chosen.choice(["2024-06-01", "2024-06-02", "2024-06-03", "2024-06-04"])
        action = chosen.choice(["INSERTED", "UPDATED", "OPENED", None])
        user = chosen.choice(["D.ann", "D.E.bob", "eve", None])
        rows.append((chosen.choice("ab"), chosen.randrange(8), at(day) if seq % 17 else None, seq, action, user))
    return rows


@pytest.fixture
def store(spark, tmp_path):
    return diary.DiaryStore(str(tmp_path / "diary")).create(spark)


def test_batches_equal_the_whole(spark, store):
    rows = entries(300)
    whole = spark.createDataFrame(rows, ENTRIES)
    assert store.state(spark).isEmpty() and store.fold(spark) is None
    batches = [rows[:100], rows[80:200], rows[:10], rows[200:]]
    for number, batch in enumerate(random.Random(4).sample(batches, 4)):
        store.add(spark.createDataFrame(batch, ENTRIES))
        if number == 1:
            assert store.fold(spark) is not None
    users = catalog.latest_user(whole, ("INSERTED", "UPDATED"))
    for _ in range(2):
        state = store.state(spark)
        assert tuples(diary.latest_users(state)) == tuples(users)
        assert tuples(state, "source_db", "id", "action_time") == tuples(catalog.last_action(whole))
        store.fold(spark)
    assert len(store.sweep(spark, keep_hours=-1.0)) == 5
    assert tuples(diary.latest_users(store.state(spark))) == tuples(users)
    assert len(folders.children(spark, f"{store.root}/segments")) <= 2


def test_only_new_entries_are_read(spark, store):
    rows = entries(60)
    first = spark.createDataFrame([r for r in rows if r[0] == "a" and r[3] < 40], ENTRIES)
    store.add(first)
    whole = spark.createDataFrame(rows, ENTRIES)
    last = max(r[3] for r in rows if r[0] == "a" and r[3] < 40)

    def new(overlap):
        # entries without a time still have a number
        return sorted(r[3] for r in rows if r[0] == "b" or r[3] > last - overlap)

    assert sorted(r.seq for r in store.since(whole).collect()) == new(0)
    assert sorted(r.seq for r in store.since(whole, overlap=15).collect()) == new(15)
    times = whole.select("source_db", "id", "time")
    newest = max(r[2] for r in rows if r[0] == "a" and r[3] < 40 and r[2])
    again = [r for r in rows if r[0] == "b" or r[2] is None or r[2] >= newest]
    assert store.since(times).count() == len(again)


def test_of_two_folds_one_counts(spark, store, monkeypatch):
    for part in (entries(50, 2), entries(50, 3)):
        store.add(spark.createDataFrame(part, ENTRIES))
    before = tuples(store.state(spark))
    move = folders.move_if_absent

    def late(session, source, target):
        if not moved:
            moved.append(target)
            store.fold(session)
        return move(session, source, target)

    moved = []
    monkeypatch.setattr(folders, "move_if_absent", late)
    assert store.fold(spark) is None
    assert tuples(store.state(spark)) == before


def test_rows_by_state(spark, tmp_path):
    """Windows over the states give the rows that the diaries give."""
    t, users = tables(spark), allowed(spark)
    bounds = spark.createDataFrame(
        [("a", at("2024-06-25 12:00:00"), at("2024-06-30 12:00:00"))],
        "source_db string, last timestamp_ntz, as_of timestamp_ntz",
    )
    methods, views = (diary.DiaryStore(str(tmp_path / n)).create(spark) for n in ("m", "v"))
    for _ in range(2):  # the second time there is nothing new
        by_state = diary.with_diary_states(t, methods, views)
    assert tuples(catalog.method_rows(by_state, bounds, users)) == tuples(catalog.method_rows(t, bounds, users))
    assert tuples(catalog.view_rows(by_state, bounds, users)) == tuples(catalog.view_rows(t, bounds, users))
    assert "TOUCHED" in {r.short_name for r in catalog.method_rows(by_state, bounds, users).collect()}
    later = t.criteria_diary.withColumns({"seq": F.col("seq") + 10, "user_id": F.lit("D.eve")})
    assert views.since(later).count() == 3
