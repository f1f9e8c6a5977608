"""Commits, texts stored once, folds and sweeps of the stored tables."""

from dataclasses import replace

import pytest
from conftest import at, tuples
from pyspark.sql import functions as F
from test_poll import ROWS, feed, states

from snapsync.plans import poll
from snapsync.plans.store import Conflict, Store, chain_name
from snapsync.settings import Settings
from snapsync.sources import folders


@pytest.fixture
def store(spark, tmp_path):
    return Store(str(tmp_path / "store")).create(spark)


def now(spark, as_of="2024-06-30", *sources):
    return states(spark, *[(db, "e", as_of) for db in sources or ("a", "b")])


def test_of_two_racing_polls_one_looks_again(spark, store, monkeypatch):
    commit, calls = Store.commit, []

    def late(self, rows, name, state, settings):
        calls.append(name)
        if len(calls) == 1:  # another poll of source a is committed while this one is at work
            poll.capture(feed(spark, *ROWS[:3]), now(spark, "2024-07-02", "a"), store)
        return commit(self, rows, name, state, settings)

    monkeypatch.setattr(Store, "commit", late)
    poll.capture(feed(spark, *ROWS), now(spark), store)
    # b is committed at once, a is compared again and brings nothing new
    assert len(calls) == 3
    assert tuples(store.versions(spark), "source_db", "path", "text", "poll_no") == [
        ("a", "C/N1.sql", "2", 1), ("a", "C/N2.sql", "1", 1), ("b", "C/N1.sql", "1", 1),
    ]
    assert store.changesets(spark).count() == 3
    assert tuples(store.control(spark), "source_db", "poll_no") == [("a", 1), ("a", 2), ("b", 1)]
    marks = tuples(store.last_control(spark), "source_db", "high_water")
    assert marks == [("a", at("2024-07-02")), ("b", at("2024-06-30"))]


def test_racing_threads(spark, store):
    polls = {f"p{i}": lambda: poll.capture(feed(spark, *ROWS), now(spark), store) for i in range(3)}
    assert {r.status for r in poll.poll_all(spark, polls, parallel=3).collect()} == {"ok"}
    assert store.versions(spark).count() == 3 and store.changesets(spark).count() == 3
    numbers = tuples(store.control(spark), "source_db", "poll_no")
    assert len(numbers) == len(set(numbers)) == 6


def test_a_poll_that_always_loses(spark, store, monkeypatch):
    monkeypatch.setattr(Store, "commit", lambda *_: [])
    settings = replace(Settings(), commit_tries=2)
    with pytest.raises(Conflict):
        poll.capture(feed(spark, *ROWS), now(spark), store, settings=settings)
    assert store.versions(spark).isEmpty()


def test_one_commit_per_state(spark, store):
    state = store.state(spark)
    rows = now(spark).select(
        "source_db", "epoch", F.lit(1).cast("long").alias("poll_no"), F.col("as_of").alias("high_water"), F.col("local_time").alias("updated_at")
    )
    assert sorted(store.commit(rows, "p.1", state)) == ["a", "b"]
    assert store.commit(rows, "p.2", state) == []
    assert [n for n, _ in folders.children(spark, f"{store.root}/staged")] == []
    # the base epoch has a chain of its own
    assert store.commit(rows.withColumn("epoch", F.lit("master")), "p.3", state) != []


def test_names_of_chains():
    names = [None, "", "a", "a_", "a/b", "a b", "a.b", "é", "_null_", "A"]
    found = {chain_name(n, False) for n in names} | {chain_name(n, True) for n in names}
    assert len(found) == 2 * len(names)
    assert all("/" not in n and "." not in n for n in found)


def test_a_text_that_comes_back_is_stored_once(spark, store):
    for day, text in (("01", "one"), ("02", "two"), ("03", "one")):
        rows = [("a", "N1", f"2024-06-{day}", "u", text), ("a", "N2", f"2024-06-{day}", "u", text)]
        poll.capture(feed(spark, *rows), now(spark, f"2024-06-{day}", "a"), store)
    assert sorted(r.text for r in store.texts(spark).collect()) == ["one", "two"]
    assert tuples(store.versions(spark), "path", "poll_no", "text") == [
        ("C/N1.sql", 1, "one"), ("C/N1.sql", 2, "two"), ("C/N1.sql", 3, "one"),
        ("C/N2.sql", 1, "one"), ("C/N2.sql", 2, "two"), ("C/N2.sql", 3, "one"),
    ]
    poll.merge_into_base(spark, store)
    store.fold(spark)
    assert store.texts(spark).count() == 2
    new = states(spark, ("a", "new", "2024-07-30"))
    assert tuples(store.snapshot(spark, new), "path", "text") == [("C/N1.sql", "one"), ("C/N2.sql", "one")]


def test_texts_of_a_failed_attempt_are_not_known(spark, store, monkeypatch):
    with monkeypatch.context() as patch:
        patch.setattr(Store, "commit", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            poll.capture(feed(spark, *ROWS), now(spark), store)
    assert store.texts(spark).isEmpty()
    poll.capture(feed(spark, *ROWS), now(spark), store)
    assert store.versions(spark).where("text is null").isEmpty()


def listing(store, spark):
    tables = ("versions", "texts", "changesets", "messages", "staged", "folds")
    found = {t: len(folders.children(spark, f"{store.root}/{t}")) for t in tables}
    chains = [n for n, _ in folders.children(spark, f"{store.root}/control") if n != "none"]
    found["control"] = sum(len(folders.children(spark, f"{store.root}/control/{c}")) for c in chains)
    return found


def everything(store, spark):
    return (
        tuples(store.versions(spark), "source_db", "path", "poll_no", "text", "changeset_id"),
        tuples(store.changesets(spark), "source_db", "poll_no", "changeset_id", "author"),
        tuples(store.messages(spark), "source_db", "poll_no", "message"),
        tuples(store.control(spark), "source_db", "poll_no", "high_water"),
        tuples(store.texts(spark), "text_sha"),
    )


def test_sweep_removes_only_what_no_reader_needs(spark, store, monkeypatch):
    poll.capture(feed(spark, *ROWS[:2]), now(spark, "2024-06-02", "a"), store)
    with monkeypatch.context() as patch:
        patch.setattr(Store, "commit", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            poll.capture(feed(spark, *ROWS), now(spark), store)
    before = everything(store, spark)
    assert store.sweep(spark, keep_hours=1.0) == []  # it might still be at work
    swept = store.sweep(spark, keep_hours=-1.0)
    assert sorted(n.split("/")[0] for n in swept) == ["changesets", "messages", "texts", "versions"]
    assert everything(store, spark) == before
    assert listing(store, spark)["versions"] == 1

    poll.capture(feed(spark, *ROWS[2:]), now(spark), store)
    before = everything(store, spark)
    assert store.fold(spark) is not None and store.fold(spark) is None
    assert everything(store, spark) == before
    store.sweep(spark, keep_hours=-1.0)
    assert everything(store, spark) == before
    assert listing(store, spark) == {
        "versions": 0, "texts": 0, "changesets": 0, "messages": 0, "staged": 0, "folds": 1, "control": 0,
    }
    # polls go on where the fold ends
    poll.capture(feed(spark, ("b", "N9", "2024-07-09", "u", "2")), now(spark, "2024-07-30"), store)
    assert tuples(store.versions(spark).where("poll_no = 3"), "path", "text") == [("C/N9.sql", "2")]
    assert store.texts(spark).count() == 2


def test_polls_fold_by_themselves(spark, store):
    settings = replace(Settings(), polls_per_fold=2, keep_hours=-1.0)
    for day in range(1, 7):
        rows = [("a", f"N{day % 2}", f"2024-06-0{day}", "u", str(day))]
        poll.capture(feed(spark, *rows), now(spark, f"2024-06-0{day}", "a"), store, settings=settings)
        found = listing(store, spark)
        assert found["versions"] < 2 and found["control"] < 2
    assert found["folds"] == 3
    assert [v[2:4] for v in everything(store, spark)[0]] == [(2, "2"), (4, "4"), (6, "6"), (1, "1"), (3, "3"), (5, "5")]
    assert tuples(store.current(spark), "path", "text") == [("C/N0.sql", "6"), ("C/N1.sql", "5")]


def test_of_two_folds_one_counts(spark, store, monkeypatch):
    poll.capture(feed(spark, *ROWS), now(spark), store)
    move = folders.move_if_absent

    def late(session, source, target):
        if "folded" in target and "fold-" in source and not moved:
            moved.append(target)
            store.fold(session)
        return move(session, source, target)

    moved = []
    monkeypatch.setattr(folders, "move_if_absent", late)
    before = everything(store, spark)
    assert store.fold(spark) is None
    assert len(store.state(spark).folds) == 1 and everything(store, spark) == before
