from conftest import at, tuples
from test_poll import ROWS, feed, states

from snapsync import schemas
from snapsync.plans import poll
from snapsync.plans.store import Store, epoch_snapshot
from snapsync.streaming.capture import capture_stream, first_seen


def test_three_drops_equal_the_batches(spark, tmp_path):
    drops = [feed(spark, *ROWS[:2]), feed(spark, *ROWS[1:3]), feed(spark, *ROWS[3:])]
    streamed, batched = (Store(str(tmp_path / n)).create(spark) for n in ("streamed", "batched"))
    folder = str(tmp_path / "in")
    for drop in drops:
        drop.coalesce(1).write.mode("append").parquet(folder)
        rows = spark.readStream.schema(schemas.CHANGE_ROWS).parquet(folder)
        capture_stream(rows, streamed, str(tmp_path / "marks"), how="window").awaitTermination()
        seen = [r.source_db for r in drop.select("source_db").distinct().collect()]
        now = states(spark, *[(db, "e", "2024-06-30") for db in seen])
        poll.capture(drop, now, batched)
    columns = ["source_db", "changeset_id", "author", "n_messages", "n_rows"]
    assert tuples(streamed.changesets(spark), *columns) == tuples(batched.changesets(spark), *columns)
    epochs = streamed.last_control(spark)
    assert tuples(epoch_snapshot(streamed.versions(spark), epochs), "source_db", "path", "text") == [
        ("a", "C/N1.sql", "2"), ("a", "C/N2.sql", "1"), ("b", "C/N1.sql", "1"),
    ]


def test_streams_and_restarts_share_a_store(spark, tmp_path):
    store = Store(str(tmp_path / "store")).create(spark)
    other = [("c", "N1", "2024-06-02", "u", "1"), ("c", "N2", "2024-06-03", "u", "1")]

    def run(folder, checkpoint, *rows):
        feed(spark, *rows).coalesce(1).write.mode("append").parquet(str(tmp_path / folder))
        stream = spark.readStream.schema(schemas.CHANGE_ROWS).parquet(str(tmp_path / folder))
        capture_stream(stream, store, str(tmp_path / checkpoint)).awaitTermination()

    run("one", "one-marks", *ROWS)
    run("two", "two-marks", *other)  # a second stream, whose batches count from 0 too
    run("one", "new-marks", ("a", "N7", "2024-06-09", "u", "1"))  # started again from nothing
    epochs = store.last_control(spark)
    assert tuples(epoch_snapshot(store.current(spark), epochs), "source_db", "path") == [
        ("a", "C/N1.sql"), ("a", "C/N2.sql"), ("a", "C/N7.sql"), ("b", "C/N1.sql"),
        ("c", "C/N1.sql"), ("c", "C/N2.sql"),
    ]


def test_a_late_batch_moves_no_mark_back(spark, tmp_path):
    store = Store(str(tmp_path / "store")).create(spark)
    for rows in (ROWS[:3], [("a", "N5", "2024-05-01", "u", "1"), ("a", "N6", None, "u", "1")]):
        rows = [(db, "VIEW", "C", n, at(t) if t else None, u, None, x) for db, n, t, u, x in rows]
        drop = spark.createDataFrame(rows, schemas.CHANGE_ROWS)
        drop.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(schemas.CHANGE_ROWS).parquet(str(tmp_path / "in"))
        capture_stream(stream, store, str(tmp_path / "marks")).awaitTermination()
    assert store.last_control(spark).first().high_water == at("2024-06-03")
    assert store.versions(spark).count() == 4


def test_first_seen_drops_the_overlap(spark, tmp_path):
    feed(spark, *ROWS, *ROWS).write.parquet(str(tmp_path / "in"))
    rows = spark.readStream.schema(schemas.CHANGE_ROWS).parquet(str(tmp_path / "in"))
    once = first_seen(rows, ["source_db", "short_name", "modified"], "1 hour")
    query = (
        once.writeStream.format("memory").queryName("once").trigger(availableNow=True).start()
    )
    query.awaitTermination()
    assert spark.table("once").count() == 4
