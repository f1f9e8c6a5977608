"""Late rows of a stream: stamped before the mark of their source, and not known to the snapshot.

A poll by time misses them. Each micro-batch puts its late rows, after a join with the marks, into a folder
of its own; the next poll reads the folders that wait and moves them away when it is done.
"""

import uuid
from collections.abc import Callable
from dataclasses import dataclass
from time import time

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from snapsync.operators.joins import join_null_safe, known_size
from snapsync.plans import poll
from snapsync.plans.store import Store
from snapsync.settings import Settings
from snapsync.sources.folders import children, move_if_absent, remove
from snapsync.streaming.capture import by_batches

PATH = ["source_db", "path"]


@dataclass(frozen=True)
class LateRows:
    """Rows of `schema` below `root`, a folder that all executors share. `keys` tell a row from others; of
    rows with the same keys one is kept, null keys being equal."""

    root: str
    schema: StructType
    keys: tuple

    def waiting(self, spark: SparkSession) -> list[str]:
        """Labels of the batches that no poll has taken."""
        return sorted(name for name, _ in children(spark, f"{self.root}/waiting"))

    def taken(self, spark: SparkSession) -> list[str]:
        return sorted(name for name, _ in children(spark, f"{self.root}/taken"))

    def rows(self, spark: SparkSession, waiting: list[str], taken: list[str] = ()) -> DataFrame:
        places = [f"{self.root}/waiting/{n}" for n in waiting] + [f"{self.root}/taken/{n}" for n in taken]
        if not places:
            return spark.createDataFrame([], self.schema)
        return spark.read.schema(self.schema).parquet(*places)

    def add(self, batch: DataFrame, label: str, bounds: DataFrame, known: DataFrame) -> None:
        """Keep the late rows of a batch. A batch that comes again is known by its label, also where the
        marks have moved since or it had no late row."""
        spark, keys = batch.sparkSession, list(self.keys)
        waiting, taken = self.waiting(spark), self.taken(spark)
        if label in waiting or label in taken:
            return
        late = poll.late_rows(batch, bounds.select("source_db", "last"), known, keys)
        once = late.select(*self.schema.fieldNames()).dropDuplicates(keys)
        new = join_null_safe(once, self.rows(spark, waiting, taken).select(*keys), keys, "left_anti")
        attempt = f"{self.root}/attempts/{uuid.uuid4().hex}"
        new.write.parquet(attempt)
        if not move_if_absent(spark, attempt, f"{self.root}/waiting/{label}"):
            remove(spark, attempt)

    def take(self, spark: SparkSession, work: Callable[[DataFrame], object]) -> int:
        """Hand the rows that wait to `work` and, when it is done, move them away. If it fails they wait on,
        and come again: work must not count equal rows twice (a capture doesn't). Returns the number of
        batches. One poll at a time takes rows."""
        labels = self.waiting(spark)
        if labels:
            work(self.rows(spark, labels))
        for label in labels:
            move_if_absent(spark, f"{self.root}/waiting/{label}", f"{self.root}/taken/{label}")
        return len(labels)

    def forget(self, spark: SparkSession, keep_hours: float) -> None:
        """Remove taken batches older than that. Their rows count as new if they come again."""
        before = (time() - keep_hours * 3600) * 1000
        for name, changed in children(spark, f"{self.root}/taken"):
            if changed < before:
                remove(spark, f"{self.root}/taken/{name}")


def late_stream(
    rows: DataFrame,
    kept: LateRows,
    bounds: Callable[[], DataFrame],
    known: Callable[[], DataFrame],
    checkpoint: str,
    interval: str | None = None,
) -> StreamingQuery:
    """Keep the late rows of a stream. `bounds` (source_db, last) and `known` (rows with the keys) are asked
    for with each micro-batch. Without an interval the query takes what is there and ends."""

    def one_batch(batch: DataFrame, label: str) -> None:
        kept.add(batch, label, bounds(), known())

    return by_batches(rows, checkpoint, one_batch, interval)


def capture_late(
    kept: LateRows, states: DataFrame, store: Store, settings=Settings(), how="ranges"
) -> int:
    """A poll of the late change rows that wait. A row older than the stored version of its file is
    history and doesn't replace it. `states` are those of `poll.capture`; a source that
    has late rows and no state is an error, after which all rows wait on."""
    spark = states.sparkSession
    states = known_size(states)

    def work(rows: DataFrame) -> None:
        lacking = rows.join(states, "source_db", "left_anti").select("source_db").first()
        if lacking:
            raise ValueError(f"no state of source {lacking.source_db}, which has late rows")
        stored = store.current(spark).select(*PATH, F.col("modified").alias("_stored"))
        feed = rows.withColumn("path", poll.feed_path())
        feed = join_null_safe(feed, stored.groupBy(*PATH).agg(F.max("_stored").alias("_stored")), PATH, "left")
        newer = feed.where("_stored is null or modified is null or modified > _stored")
        poll.capture(newer.drop("path", "_stored"), states, store, "late", settings, how)

    return kept.take(spark, work)
