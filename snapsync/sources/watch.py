"""A tree of files as an incremental source: what was added, changed and deleted since the last look.

A look lists the tree (names, times, sizes), compares the list with that of the look before and reads only
files that are new or have another time or size. What it found is committed in one step, as the next
number, so that looks can be read one by one, and by a stream.
"""

import uuid
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from snapsync.functions.text import text_sha
from snapsync.operators.joins import join_null_safe
from snapsync.sources.folders import children, exists, move_if_absent, remove
from snapsync.sources.tree import _files, decoded

FILE = ("folder", "file")
FILES = "path string, modificationTime timestamp, length long, content binary, folder string, file string"
LISTED = "folder string, file string, modified timestamp, size long"
KNOWN = f"{LISTED}, text_sha string"
CHANGES = "folder string, file string, change string, modified timestamp, size long, text_sha string, text string"


class Conflict(Exception):
    """Another look at the same tree was committed first."""


def listed_changes(known: DataFrame, listed: DataFrame, keys=FILE) -> DataFrame:
    """(keys, change, modified, size, known_sha) of files that two lists tell apart: 'added', 'deleted', or
    'changed' where time or size differ. The time and size are the new ones, null for deleted files.
    `keys` name a file; null names are equal."""
    new = listed.select(*keys, F.struct("modified", "size").alias("_new"))
    old = known.select(*keys, F.struct("modified", "size").alias("_old"), F.col("text_sha").alias("known_sha"))
    both = (
        new.withColumn("known_sha", F.lit(None).cast("string"))
        .unionByName(old, allowMissingColumns=True)
        .groupBy(*keys)
        .agg(F.max("_new").alias("_new"), F.max("_old").alias("_old"), F.max("known_sha").alias("known_sha"))
    )
    change = (
        F.when(F.col("_old").isNull(), "added")
        .when(F.col("_new").isNull(), "deleted")
        .when(~F.col("_new").eqNullSafe(F.col("_old")), "changed")
    )
    return (
        both.withColumn("change", change)
        .where("change is not null")
        .select(*keys, "change", "_new.modified", "_new.size", "known_sha")
    )


@dataclass(frozen=True)
class TreeWatch:
    """Looks at the tree below `root`, kept below `state`, a folder that all executors share.

    An empty file counts as none, as everywhere in the engine (Spark doesn't list it).
    A file that is written again within the time step of its file system and with the same size is not
    seen. A look that fails leaves nothing that a later one or a reader takes into account; it can be
    repeated. Of two looks at the same time one is committed, the other raises Conflict.
    """

    root: str
    state: str
    encoding: str = "utf8"

    def last(self, spark: SparkSession) -> int:
        return max((int(name) for name, _ in children(spark, f"{self.state}/looks")), default=0)

    def known(self, spark: SparkSession, number: int | None = None) -> DataFrame:
        """The list of files as of a look (the last one if None)."""
        number = self.last(spark) if number is None else number
        if not number:
            return spark.createDataFrame([], KNOWN)
        return spark.read.schema(KNOWN).parquet(f"{self._look(number)}/known")

    def changes(self, spark: SparkSession, number: int) -> DataFrame:
        """What a look found: one row per file, its text null if deleted."""
        return spark.read.schema(CHANGES).parquet(f"{self._look(number)}/changes")

    def stream(self, spark: SparkSession) -> DataFrame:
        """The changes of all looks, each once, as a stream."""
        return spark.readStream.schema(CHANGES).parquet(f"{self.state}/looks/*/changes")

    def look(self, spark: SparkSession) -> DataFrame:
        """Commit what changed since the last look and return it."""
        number = self.last(spark)
        known, attempt = self.known(spark, number), f"{self.state}/attempts/{uuid.uuid4().hex}"
        listed = self._files(spark).select(
            *FILE, F.col("modificationTime").alias("modified"), F.col("length").alias("size")
        )
        listed_changes(known, listed).write.parquet(f"{attempt}/candidates")
        candidates = spark.read.parquet(f"{attempt}/candidates")
        found = self._read(spark, candidates.where("change <> 'deleted'"))
        known_sha = candidates.where("change = 'changed'").select(*FILE, "known_sha")
        # A file whose time is another one and whose text is the same has not changed.
        found = join_null_safe(found, known_sha, FILE, "left").withColumn(
            "change",
            F.when(F.col("known_sha").isNull(), "added")
            .when(F.col("known_sha") == F.col("text_sha"), "touched")
            .otherwise("changed"),
        )
        gone = candidates.where("change = 'deleted'").select(*FILE, "change")
        rows = found.drop("known_sha").unionByName(gone, allowMissingColumns=True)
        columns = [c.split()[0] for c in CHANGES.split(", ")]
        rows.select(*columns).write.parquet(f"{attempt}/read")
        rows = spark.read.schema(CHANGES).parquet(f"{attempt}/read")
        rows.where("change <> 'touched'").write.parquet(f"{attempt}/changes")
        kept = join_null_safe(known, rows.select(*FILE), FILE, "left_anti")
        now = rows.where("change <> 'deleted'").select(*FILE, "modified", "size", "text_sha")
        kept.unionByName(now).write.parquet(f"{attempt}/known")
        for part in ("candidates", "read"):
            remove(spark, f"{attempt}/{part}")
        if not move_if_absent(spark, attempt, self._look(number + 1)):
            remove(spark, attempt)
            raise Conflict(f"look {number + 1} of {self.root} was committed by another one")
        return self.changes(spark, number + 1)

    def _look(self, number: int) -> str:
        return f"{self.state}/looks/{number:010d}"

    def _files(self, spark: SparkSession) -> DataFrame:
        """Files of the tree. A tree without any is empty; a root that isn't there (not mounted, say) is an
        error, not a tree whose files were deleted."""
        try:
            return _files(spark, self.root)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND" or not exists(spark, self.root):
                raise
            return spark.createDataFrame([], FILES)

    def _read(self, spark: SparkSession, candidates: DataFrame) -> DataFrame:
        """The candidates with texts, and the times and sizes that these had when they were read. The bounds of
        their times go to the source, which doesn't open other files."""
        low, high = candidates.agg(F.min("modified"), F.max("modified")).first()
        files = self._files(spark)
        if low is not None:
            time = F.col("modificationTime")
            files = files.where((time >= F.lit(low)) & (time <= F.lit(high)))
        text = decoded(F.col("content"), self.encoding)
        chosen = files.join(candidates.select(*FILE), [*FILE], "left_semi")
        return chosen.select(
            *FILE, F.col("modificationTime").alias("modified"), F.col("length").alias("size"), text.alias("text")
        ).withColumn("text_sha", text_sha(F.col("text")))
