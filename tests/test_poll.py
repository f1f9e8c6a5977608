import pytest
from catalog_data import LAST, NOW, allowed, elements, tables
from conftest import at, tuples
from pyspark.sql import functions as F

from snapsync import schemas
from snapsync.operators.joins import with_bounds
from snapsync.plans import poll
from snapsync.plans.store import Store, epoch_snapshot


@pytest.fixture
def store(spark, tmp_path):
    return Store(str(tmp_path / "store")).create(spark)


def feed(spark, *rows):
    full = [(db, "VIEW", "C", name, at(time), user, None, text) for db, name, time, user, text in rows]
    return spark.createDataFrame(full, schemas.CHANGE_ROWS)


def states(spark, *rows):
    return spark.createDataFrame(
        [(db, epoch, at(as_of), at(as_of)) for db, epoch, as_of in rows],
        "source_db string, epoch string, as_of timestamp_ntz, local_time timestamp_ntz",
    )


ROWS = [
    ("a", "N1", "2024-06-01", "u", "1"),
    ("a", "N2", "2024-06-02", "u", "1"),
    ("a", "N1", "2024-06-03", "v", "2"),
    ("b", "N1", "2024-06-02", None, "1"),
]


def test_bounds_mode_and_first_visit(spark):
    now = states(spark, ("a", "", "2024-06-30"), ("b", "", "2024-06-30"), ("c", "", "2024-06-30"))
    control = spark.createDataFrame(
        [("a", "a_1", at("2024-06-29")), ("b", None, at("2024-06-28"))],
        "source_db string, epoch string, high_water timestamp_ntz",
    )
    assert tuples(poll.poll_bounds(now, control), "source_db", "last") == [
        ("a", at("2024-06-29")), ("b", at("2024-06-28")), ("c", at("2024-06-23")),
    ]
    restored = spark.createDataFrame([("a",)], "source_db string")
    assert tuples(poll.poll_mode(now, control)) == [
        ("a", False, "a_1"), ("b", True, "b_2024.06.30_00.00"), ("c", True, "c_2024.06.30_00.00"),
    ]
    assert ("a", True, "a_2024.06.30_00.00") in tuples(poll.poll_mode(now, control, restored))


def test_capture_twice_counts_once(spark, store):
    now = states(spark, ("a", "e", "2024-06-30"), ("b", "e", "2024-06-30"))
    for _ in range(2):
        poll.capture(feed(spark, *ROWS), now, store)
    assert tuples(store.versions(spark), "source_db", "path", "text") == [
        ("a", "C/N1.sql", "2"), ("a", "C/N2.sql", "1"), ("b", "C/N1.sql", "1"),
    ]
    sets = store.changesets(spark).join(store.messages(spark), ["source_db", "poll", "changeset_id"])
    assert tuples(sets, "source_db", "changeset_id", "author", "message") == [
        ("a", 1, "u", "autosave C [N2]"), ("a", 2, "v", "autosave C [N1]"),
        ("b", 1, "Неизвестный автор", "autosave C [N1]"),
    ]
    # the mark moves also when nothing has changed
    assert store.control(spark).count() == 4


def test_consecutive_polls_equal_one_long_poll(spark, tmp_path):
    one, two = (Store(str(tmp_path / n)).create(spark) for n in ("one", "two"))
    now = states(spark, ("a", "e", "2024-06-30"), ("b", "e", "2024-06-30"))
    rows = feed(spark, *ROWS)
    poll.capture(rows, now, one)
    border = F.lit(at("2024-06-02"))
    poll.capture(rows.where(F.col("modified") <= border), now, two)
    poll.capture(rows.where(F.col("modified") >= border), now, two)

    def snapshot(store):
        return tuples(epoch_snapshot(store.versions(spark), now), "source_db", "path", "text")

    assert snapshot(one) == snapshot(two)


def test_a_failed_poll_leaves_nothing_to_see(spark, store, monkeypatch):
    now = states(spark, ("a", "e", "2024-06-30"))
    rows = feed(spark, *ROWS[:3])

    def fail(*_):
        raise OSError("disk")

    with monkeypatch.context() as patch:
        patch.setattr(Store, "commit", fail)
        with pytest.raises(OSError):
            poll.capture(rows, now, store)
    assert store.versions(spark).isEmpty() and store.changesets(spark).isEmpty()
    poll.capture(rows, now, store)
    assert store.versions(spark).count() == 2


def test_epochs_lie_over_the_base(spark, store):
    poll.capture(feed(spark, *ROWS[:2]), states(spark, ("a", "master", "2024-06-05")), store)
    own = states(spark, ("a", "own", "2024-06-30"))
    poll.capture(feed(spark, *ROWS), own, store)
    # N2 equals the base, so only N1 is new in the epoch
    assert tuples(store.versions(spark).where("epoch = 'own'"), "path") == [("C/N1.sql",)]
    other = states(spark, ("a", "other", "2024-06-30"))
    versions = store.versions(spark)
    assert tuples(epoch_snapshot(versions, own), "path", "text") == [("C/N1.sql", "2"), ("C/N2.sql", "1")]
    assert tuples(epoch_snapshot(versions, other), "path", "text") == [("C/N1.sql", "1"), ("C/N2.sql", "1")]


def test_run_poll_full_then_incremental(spark, store):
    t, users = tables(spark), allowed(spark)
    tree = elements(spark, ("METHOD", "C", "OLD"))
    now = spark.createDataFrame(
        [("a", NOW, NOW)], "source_db string, as_of timestamp_ntz, local_time timestamp_ntz"
    )
    poll.run_poll(t, now, users, tree, store)
    paths = {r.path for r in store.versions(spark).collect()}
    assert "C/OLD.body.sql" in paths and "C/IN.globals.sql" in paths
    control = store.control(spark).first()
    assert control.epoch == "a_2024.06.30_12.00" and control.high_water == NOW
    later = now.select(
        "source_db", *[(F.col(c) + F.make_dt_interval(days=F.lit(2))).alias(c) for c in ("as_of", "local_time")]
    )
    poll.run_poll(t, later, users, tree, store)
    new = store.versions(spark).where("poll_no = 2")
    assert tuples(new, "path", "epoch") == [("C/FUTURE.body.sql", "a_2024.06.30_12.00")]
    assert LAST < NOW


def test_an_error_in_one_source_stays_there(spark):
    def broken():
        raise ConnectionError("lost")

    status = poll.poll_all(spark, {"a": lambda: "poll-1", "b": broken})
    assert tuples(status) == [
        ("a", "ok", "poll-1", None), ("b", "failed", None, "ConnectionError: lost"),
    ]


def test_parallel_polls_lose_nothing(spark, store):
    names = [f"db{i}" for i in range(8)]

    def one(db):
        rows = [(db, f"N{i}", f"2024-06-{1 + i % 20:02}", f"u{i % 3}", f"{i}") for i in range(40)]
        return lambda: poll.capture(feed(spark, *rows), states(spark, (db, "e", "2024-06-30")), store)

    def broken():
        raise ValueError("no jdbc:oracle:thin:user/secret@host here")

    polls = {db: one(db) for db in names} | {"bad": broken}
    status = {r.source: r for r in poll.poll_all(spark, polls, parallel=8).collect()}
    assert all(status[db].status == "ok" for db in names)
    assert status["bad"].status == "failed" and "secret" not in status["bad"].error
    counts = {r.source_db: r["count"] for r in store.versions(spark).groupBy("source_db").count().collect()}
    assert counts == {db: 40 for db in names}
    sets = store.changesets(spark).groupBy("source_db").sum("n_rows").collect()
    assert sorted(tuple(r) for r in sets) == [(db, 40) for db in names]


def test_rows_without_a_path_are_kept(spark, store):
    full = [
        ("a", "VIEW", None, "N1", at("2024-06-01"), "u", None, "1"),
        ("a", "VIEW", None, "N2", at("2024-06-01"), "u", None, "2"),
        ("a", "VIEW", "C", None, at("2024-06-01"), "u", None, "3"),
        ("a", "METHOD", None, None, at("2024-06-01"), "u", "body", "4"),
        ("a", "METHOD", None, None, at("2024-06-02"), "u", "body", "5"),
    ]
    rows = spark.createDataFrame(full, schemas.CHANGE_ROWS)
    now = states(spark, ("a", "e", "2024-06-30"))
    poll.capture(rows, now, store)
    poll.capture(rows, now, store)
    assert sorted(r.text for r in store.versions(spark).collect()) == ["1", "2", "3", "5"]
    bare = rows.withColumn("path", F.lit(None).cast("string"))
    assert poll.newest_per_path(bare).count() == 4


def test_a_listing_removes_what_a_source_lost(spark, store):
    now = states(spark, ("a", "e", "2024-06-30"), ("b", "e", "2024-06-30"))
    poll.capture(feed(spark, *ROWS), now, store)
    listed = spark.createDataFrame(
        [("a", "VIEW", "C", "N2")], "source_db string, type string, class_id string, short_name string"
    )
    poll.capture(feed(spark), now, store, listing=listed)
    # the listing speaks for source a alone
    assert tuples(epoch_snapshot(store.current(spark), now), "source_db", "path") == [
        ("a", "C/N2.sql"), ("b", "C/N1.sql"),
    ]
    assert tuples(store.versions(spark).where("removed"), "path") == [("C/N1.sql",)]
    assert store.changesets(spark).groupBy().sum("n_rows").first()[0] == 3


def test_folding_changes_no_snapshot(spark, store):
    now = states(spark, ("a", "e", "2024-06-30"), ("b", "e", "2024-06-30"))

    def snapshot():
        return tuples(epoch_snapshot(store.current(spark), now), "source_db", "path", "text", "poll_no")

    poll.capture(feed(spark, *ROWS[:2]), now, store)
    store.fold(spark)
    poll.capture(feed(spark, *ROWS[2:]), now, store)
    before = snapshot()
    assert before == tuples(
        epoch_snapshot(store.versions(spark), now), "source_db", "path", "text", "poll_no"
    )
    store.fold(spark)
    assert snapshot() == before and len(before) == 3
    poll.capture(feed(spark, ("b", "N9", "2024-06-09", "u", "9")), now, store)
    assert len(snapshot()) == 4


def test_a_new_epoch_starts_from_the_base(spark, store):
    own = states(spark, ("a", "own", "2024-06-30"), ("b", "own", "2024-06-30"))
    poll.capture(feed(spark, *ROWS), own, store)
    poll.merge_into_base(spark, store)
    new = states(spark, ("a", "new", "2024-07-30"))
    assert tuples(epoch_snapshot(store.current(spark), new), "path", "text") == [
        ("C/N1.sql", "2"), ("C/N2.sql", "1"),
    ]
    # the base is no source's present epoch
    assert {r.epoch for r in store.last_control(spark).collect()} == {"own"}
    poll.capture(feed(spark, *ROWS), new, store)
    assert store.versions(spark).where("epoch = 'new'").isEmpty()
    gone = spark.createDataFrame(
        [("a", "VIEW", "C", "N2")], "source_db string, type string, class_id string, short_name string"
    )
    poll.capture(feed(spark), own, store, listing=gone)
    poll.merge_into_base(spark, store)
    assert tuples(epoch_snapshot(store.current(spark), new), "path") == [("C/N2.sql",)]


def test_sources_do_not_shuffle_the_feed(spark):
    """The size of the small side is not known to the optimizer, but looked up."""
    unknown = states(spark, ("a", "e", "2024-06-30")).select(
        "source_db", F.col("as_of").alias("last"), "as_of"
    ).repartition(3).mapInArrow(lambda batches: batches, "source_db string, last timestamp_ntz, as_of timestamp_ntz")
    plan = with_bounds(feed(spark, *ROWS), unknown)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning(source_db" not in plan


def test_late_rows(spark):
    rows = feed(spark, *ROWS)
    bounds = spark.createDataFrame([("a", at("2024-06-03"))], "source_db string, last timestamp_ntz")
    known = rows.where("short_name = 'N2'")
    late = poll.late_rows(rows, bounds, known, ["source_db", "short_name", "modified"])
    assert tuples(late, "short_name", "modified") == [("N1", at("2024-06-01"))]
