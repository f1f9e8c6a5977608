"""Capture of a stream of change rows."""

from concurrent.futures import Future

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from snapsync.functions.times import epoch_name
from snapsync.operators.joins import join_null_safe
from snapsync.operators.sizing import written
from snapsync.plans.poll import capture
from snapsync.plans.store import Store
from snapsync.settings import Settings


def capture_stream(
    rows: DataFrame,
    store: Store,
    checkpoint: str,
    settings=Settings(),
    interval: str | None = None,
    how="ranges",
) -> StreamingQuery:
    """Turn each micro-batch into object versions and change sets of the store.

    Without an interval the query takes what is there and ends. A batch that is delivered again
    after a failure is skipped for the sources whose control rows exist, and starts anew for the
    others. It is known by the id that its checkpoint gave the query, so that other streams into the store, or one
    with a new checkpoint, are not taken for it. A mark never moves back.
    """

    def one_batch(batch: DataFrame, label: str) -> None:
        spark = batch.sparkSession
        committed = store.state(spark)
        done = store.committed_sources(spark, label, committed)
        rows = written(join_null_safe(batch, done, ["source_db"], "left_anti"), "batch")
        if rows.isEmpty():
            return
        now = rows.groupBy("source_db").agg(F.max("modified").alias("newest"))
        known = store.last_control(spark, settings, committed).select(
            "source_db", F.col("epoch").alias("known"), "high_water"
        )
        states = now.join(known, "source_db", "left").withColumn(
            "as_of", F.greatest("newest", "high_water")
        )
        # A source whose rows have no time at all has an epoch without one.
        first = F.coalesce(epoch_name(F.col("source_db"), F.col("as_of")), F.col("source_db"))
        states = states.select(
            "source_db",
            F.coalesce("known", first).alias("epoch"),
            "as_of",
            F.col("as_of").alias("local_time"),
        )
        capture(rows, written(states, "states"), store, label, settings, how)

    return by_batches(rows, checkpoint, one_batch, interval)


def by_batches(rows: DataFrame, checkpoint: str, work, interval: str | None = None) -> StreamingQuery:
    """Call `work` with each micro-batch and its label. The label has the id that the checkpoint gave the
    query, so that a batch that comes again has the same one, and no other stream has."""
    started: Future = Future()

    def one_batch(batch: DataFrame, batch_id: int) -> None:
        work(batch, f"stream-{started.result()}-{batch_id:010d}")

    writer = rows.writeStream.option("checkpointLocation", checkpoint).foreachBatch(one_batch)
    trigger = {"processingTime": interval} if interval else {"availableNow": True}
    try:
        query = writer.trigger(**trigger).start()
    except BaseException as error:
        started.set_exception(error)
        raise
    started.set_result(query.id)
    return query


def first_seen(rows: DataFrame, keys, delay: str, time="modified") -> DataFrame:
    """Drop repeated rows of a stream whose polls overlap. A row that comes later than `delay`
    after its first copy counts as new."""
    stamped = rows.withColumn("_event_time", F.col(time).cast("timestamp"))
    return (
        stamped.withWatermark("_event_time", delay)
        .dropDuplicatesWithinWatermark(list(keys))
        .drop("_event_time")
    )
