"""Publishing exactly once: a ledger of what was published, and an outbox of batches for the staging table.

    root/batches/<number>   rows of a batch, claimed in one step before anything is sent
    root/sent/<number>      mark of a batch that is in the staging table as a whole

A batch holds the rows that differ from what was published last for their object. Its content is fixed when it
is claimed, and each row has an id, so that a batch of which a part was appended can be sent again without
that part.
"""

import uuid
from dataclasses import dataclass
from typing import Protocol

from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import StructType

from snapsync.operators.joins import join_null_safe
from snapsync.sources.database import append_jdbc, jdbc_scan
from snapsync.sources.folders import children, exists, move_if_absent, remove

KEY = ("source_db", "class_id", "short_name")
MARKS = ("publish_no", "publish_id", "row_sha")


class Conflict(Exception):
    """Another publish was claimed first; plan again."""


class Unfinished(Exception):
    """A batch was claimed and not sent as a whole. `resume` sends the rest."""


class Sink(Protocol):
    def append(self, rows: DataFrame) -> None:
        """Append rows; a failure may leave a part of them."""

    def ids(self, spark: SparkSession, number: int) -> DataFrame:
        """(publish_id) of the rows of a batch that the table holds."""


@dataclass(frozen=True)
class ParquetSink:
    folder: str
    schema: StructType

    def append(self, rows: DataFrame) -> None:
        rows.write.mode("append").parquet(self.folder)

    def rows(self, spark: SparkSession) -> DataFrame:
        if not exists(spark, self.folder):
            return spark.createDataFrame([], self.schema)
        return spark.read.schema(self.schema).parquet(self.folder)

    def ids(self, spark: SparkSession, number: int) -> DataFrame:
        return self.rows(spark).where(F.col("publish_no") == number).select("publish_id")


@dataclass(frozen=True)
class JdbcSink:
    """A staging table with the columns of the rows, `publish_no`, `publish_id` and `row_sha`."""

    options: dict
    table: str

    def append(self, rows: DataFrame) -> None:
        append_jdbc(rows, self.options, self.table)

    def ids(self, spark: SparkSession, number: int) -> DataFrame:
        query = f"select publish_id from {self.table} where publish_no = {int(number)}"
        return jdbc_scan(spark, self.options, query=query, single_task=True)


@dataclass(frozen=True)
class Ledger:
    """The ledger of one staging table. `columns` are those of the rows, one row per `key`."""

    root: str
    columns: StructType
    key: tuple = KEY

    @property
    def schema(self) -> StructType:
        return StructType([*self.columns.fields]).add("publish_no", "long").add("publish_id", "string").add("row_sha", "string")

    def batches(self, spark: SparkSession) -> list[int]:
        return sorted(int(name) for name, _ in children(spark, f"{self.root}/batches"))

    def unfinished(self, spark: SparkSession) -> list[int]:
        sent = {int(name) for name, _ in children(spark, f"{self.root}/sent")}
        return [n for n in self.batches(spark) if n not in sent]

    def batch(self, spark: SparkSession, number: int) -> DataFrame:
        return spark.read.schema(self.schema).parquet(self._batch(number))

    def published(self, spark: SparkSession) -> DataFrame:
        """What was published last of each object: key, `publish_no` and `row_sha`, no texts."""
        numbers = self.batches(spark)
        if not numbers:
            return spark.createDataFrame([], self.schema).select(*self.key, "publish_no", "row_sha")
        rows = spark.read.schema(self.schema).parquet(*map(self._batch, numbers))
        last = F.rank().over(Window.partitionBy(*self.key).orderBy(F.desc("publish_no")))
        return (
            rows.select(*self.key, "publish_no", "row_sha")
            .withColumn("_rank", last)
            .where("_rank = 1")
            .drop("_rank")
        )

    def publish(self, rows: DataFrame, sink: Sink) -> int | None:
        """Send what differs from what was published last; the number of the batch, None if nothing does.
        An object whose text comes back is sent again. Equal rows count once, null keys are equal.

        If it fails after the batch was claimed, further calls raise Unfinished until `resume` has sent
        the rest. It isn't sent by itself, since its first sender may still be at work.
        """
        spark, key = rows.sparkSession, list(self.key)
        if waiting := self.unfinished(spark):
            raise Unfinished(f"batches {waiting} of {self.root}")
        number = max(self.batches(spark), default=0) + 1
        named = rows.select(*self.columns.fieldNames())
        whole = F.to_json(F.struct(*named.columns), {"ignoreNullFields": "false"})
        marked = named.withColumn("row_sha", F.sha2(F.encode(whole, "UTF-8"), 256)).dropDuplicates([*key, "row_sha"])
        new = join_null_safe(marked, self.published(spark), [*key, "row_sha"], "left_anti")
        publish_id = F.sha2(F.concat_ws("/", F.lit(str(number)), "row_sha"), 256)
        new = new.withColumns({"publish_no": F.lit(number).cast("long"), "publish_id": publish_id})
        attempt = f"{self.root}/attempts/{uuid.uuid4().hex}"
        new.select(*self.schema.fieldNames()).write.parquet(attempt)
        if spark.read.schema(self.schema).parquet(attempt).isEmpty():
            remove(spark, attempt)
            return None
        if not move_if_absent(spark, attempt, self._batch(number)):
            remove(spark, attempt)
            raise Conflict(f"batch {number} of {self.root} was claimed by another publish")
        self._send(spark, number, sink)
        return number

    def resume(self, spark: SparkSession, sink: Sink) -> list[int]:
        """Send the rest of the batches that were left, once their senders are gone; their numbers."""
        waiting = self.unfinished(spark)
        for number in waiting:
            self._send(spark, number, sink)
        return waiting

    def _batch(self, number: int) -> str:
        return f"{self.root}/batches/{number:010d}"

    def _send(self, spark: SparkSession, number: int, sink: Sink) -> None:
        rest = self.batch(spark, number).join(sink.ids(spark, number), "publish_id", "left_anti")
        sink.append(rest.select(*self.schema.fieldNames()))
        mark = f"{self.root}/attempts/{uuid.uuid4().hex}"
        spark.createDataFrame([(number,)], "number long").write.parquet(mark)
        if not move_if_absent(spark, mark, f"{self.root}/sent/{number:010d}"):
            remove(spark, mark)
