import pytest
from conftest import at, tuples
from test_poll import feed, states

from snapsync import schemas
from snapsync.plans import poll
from snapsync.plans.store import Store
from snapsync.streaming.late import LateRows, capture_late, late_stream

KEYS = ("source_db", "class_id", "short_name", "modified")
OLD, NEW = "2024-06-01", "2024-06-20"


def marks(spark, when="2024-06-10"):
    return spark.createDataFrame([("a", at(when))], "source_db string, last timestamp_ntz")


def names(df):
    return tuples(df, "short_name", "text")


@pytest.fixture
def kept(tmp_path):
    return LateRows(str(tmp_path / "late"), schemas.CHANGE_ROWS, KEYS)


def test_none_lost_or_doubled(spark, kept, tmp_path):
    folder, known = str(tmp_path / "in"), feed(spark, ("a", "K", OLD, "u", "1"))
    drops = [
        [("a", "K", OLD, "u", "1"), ("a", "N1", OLD, "u", "1"), ("a", "N2", NEW, "u", "1")],
        [("a", "N1", OLD, "u", "1"), ("a", "N3", OLD, "u", "2"), ("b", "N1", OLD, "u", "1")],
        [("a", "N4", NEW, "u", "2")],
    ]
    for drop in drops:
        feed(spark, *drop).coalesce(1).write.mode("append").parquet(folder)
        rows = spark.readStream.schema(schemas.CHANGE_ROWS).parquet(folder)
        late_stream(rows, kept, lambda: marks(spark), lambda: known, str(tmp_path / "marks")).awaitTermination()
    everything = feed(spark, *[row for drop in drops for row in drop])
    want = poll.late_rows(everything, marks(spark), known, list(KEYS)).dropDuplicates(list(KEYS))
    labels = kept.waiting(spark)
    assert len(labels) == 3 and names(kept.rows(spark, labels)) == names(want) == [("N1", "1"), ("N3", "2")]


def test_a_batch_that_comes_again_after_the_mark_moved(spark, kept):
    nothing, rows = feed(spark).limit(0), feed(spark, ("a", "N1", OLD, "u", "1"), ("a", "N2", NEW, "u", "1"))
    kept.add(rows, "stream-x-0", marks(spark), nothing)
    kept.add(rows, "stream-x-0", marks(spark, "2024-06-30"), nothing)
    assert names(kept.rows(spark, kept.waiting(spark))) == [("N1", "1")]


def test_rows_wait_until_a_poll_is_done(spark, kept):
    rows, seen = feed(spark, ("a", "N1", OLD, "u", "1")), []
    kept.add(rows, "one", marks(spark), feed(spark).limit(0))

    def fails(_):
        raise RuntimeError("lost")

    with pytest.raises(RuntimeError):
        kept.take(spark, fails)
    assert kept.take(spark, lambda df: seen.extend(names(df))) == 1
    assert seen == [("N1", "1")] and kept.take(spark, fails) == 0
    kept.add(rows, "two", marks(spark), feed(spark).limit(0))  # taken before, so not late again
    assert kept.rows(spark, kept.waiting(spark)).count() == 0
    kept.forget(spark, -1)
    kept.add(rows, "three", marks(spark), feed(spark).limit(0))
    assert kept.rows(spark, kept.waiting(spark)).count() == 1


def test_the_next_poll_captures_them(spark, kept, tmp_path):
    store, own = Store(str(tmp_path / "store")).create(spark), states(spark, ("a", "e", "2024-06-30"))
    poll.capture(feed(spark, ("a", "N1", NEW, "u", "newer")), own, store)
    late = feed(spark, ("a", "N1", OLD, "u", "older"), ("a", "N2", OLD, "u", "missed"))
    kept.add(late, "one", marks(spark), store.versions(spark).limit(0))
    with pytest.raises(ValueError, match="no state of source a"):
        capture_late(kept, states(spark, ("b", "e", "2024-06-30")), store)
    assert capture_late(kept, own, store) == 1
    current = tuples(store.current(spark), "short_name", "modified")
    assert current == [("N1", at(NEW)), ("N2", at(OLD))]
    assert capture_late(kept, own, store) == 0
