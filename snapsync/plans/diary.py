"""State of the audit diaries, kept between polls: the last entry of each object.

A state is one row per object. States of parts of a diary merge into the state of the whole, in any order
and with any overlap, so that a poll reads new entries alone and adds their state as a further segment.
A reader merges the segments; `fold` makes them one.
"""

import time
import uuid
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession, functions as F

from snapsync.functions.text import strip_domain
from snapsync.operators.joins import known_size
from snapsync.schemas import DIARY_COVERED as COVERED, DIARY_STATE as STATE
from snapsync.settings import Settings
from snapsync.sources import folders
from snapsync.sources.catalog import ID, Tables

def diary_state(diary: DataFrame, actions=Settings.logged_actions) -> DataFrame:
    """State of a diary (source_db, id, time and perhaps seq, action, user_id): the time of each object's
    last entry and, among the given actions, time, number and user of the newest one."""
    newest, seq = F.lit(None).cast(STATE["newest"].dataType), F.lit(None).cast("bigint")
    if "user_id" in diary.columns:
        seq = F.col("seq").cast("bigint")
        entry = F.struct("time", seq.alias("seq"), "user_id")
        newest = F.when(F.col("action").isin(*actions), entry)
    rows = diary.select(*ID, F.col("time").alias("action_time"), seq.alias("last_seq"), newest.alias("newest"))
    return merged(rows)


def merged(*states: DataFrame) -> DataFrame:
    """One state out of several. Each row is the greatest of its object's, so that nothing depends on the
    order, and rows fold before they are moved."""
    rows = states[0]
    for other in states[1:]:
        rows = rows.unionByName(other)
    return rows.groupBy(*ID).agg(
        *[F.max(c).alias(c) for c in ("action_time", "last_seq", "newest")]
    ).select(*[F.col(f.name).cast(f.dataType) for f in STATE.fields])


def latest_users(state: DataFrame) -> DataFrame:
    """(source_db, id, user_modified) of the objects with a logged action, as `latest_user` gives them."""
    known = state.where("newest is not null")
    return known.select(*ID, strip_domain(F.col("newest.user_id")).alias("user_modified"))


@dataclass(frozen=True)
class DiaryStore:
    """The state of one diary, in segments below a folder."""

    root: str

    def create(self, spark: SparkSession) -> "DiaryStore":
        for name, schema in (("segments/none", STATE), ("covered/none/none", COVERED)):
            spark.createDataFrame([], schema).write.mode("ignore").parquet(f"{self.root}/{name}")
        return self

    def add(self, entries: DataFrame, actions=Settings.logged_actions) -> str:
        """Add entries; those that were added before change nothing. An attempt that fails leaves
        nothing or some of the state, which the next attempt completes."""
        name = f"new-{uuid.uuid4().hex}"
        diary_state(entries, actions).write.mode("error").parquet(f"{self.root}/segments/{name}")
        return name

    def _folds(self, spark) -> list:
        covered = spark.read.schema(COVERED).parquet(f"{self.root}/covered/*/*")
        return covered.collect()  # one row per segment since the beginning

    def _segments(self, spark) -> tuple[list[str], int]:
        """Segments that make up the state, and the number of the last fold."""
        folds = self._folds(spark)
        gone = {r.segment for r in folds}
        kept = {r.fold for r in folds} - gone
        names = [n for n, _ in folders.children(spark, f"{self.root}/segments")]
        # The result of a fold counts once the fold does.
        found = [n for n in names if n not in gone and (not n.startswith("fold-") or n in kept)]
        # The empty segment stands in while there is no other.
        names = sorted(n for n in found if n != "none") or ["none"]
        return names, max((r.fold_no for r in folds), default=0)

    def state(self, spark) -> DataFrame:
        names, _ = self._segments(spark)
        reader = spark.read.schema(STATE)
        return merged(reader.parquet(*[f"{self.root}/segments/{n}" for n in names]))

    def since(self, diary: DataFrame, overlap: int = 0) -> DataFrame:
        """Entries that may not have been added: those numbered beyond the last one of their source, or,
        in a diary without numbers, not older than it. `overlap` goes back by so many numbers, or seconds,
        for entries that became visible late."""
        spark = diary.sparkSession
        numbered = "seq" in diary.columns
        column = "last_seq" if numbered else "action_time"
        marks = self.state(spark).groupBy("source_db").agg(F.max(column).alias("_mark"))
        marked = diary.join(known_size(marks), "source_db", "left")
        if numbered:
            new = F.col("seq") > F.col("_mark") - overlap
        else:
            new = F.col("time") >= F.col("_mark") - F.make_dt_interval(secs=F.lit(overlap))
        # Entries without a number or time can't be told apart from new ones.
        unknown = F.col("seq" if numbered else "time").isNull()
        return marked.where(F.col("_mark").isNull() | unknown | new).drop("_mark")

    def fold(self, spark) -> str | None:
        """Make the segments one. Returns its name, or None if there was nothing to do or another fold
        was faster."""
        names, number = self._segments(spark)
        if len(names) < 2:
            return None
        fold = f"fold-{uuid.uuid4().hex}"
        reader = spark.read.schema(STATE)
        state = merged(reader.parquet(*[f"{self.root}/segments/{n}" for n in names]))
        state.write.parquet(f"{self.root}/segments/{fold}")
        staged = f"{self.root}/staged/{fold}"
        held = [(number + 1, fold, name) for name in names]
        spark.createDataFrame(held, COVERED).coalesce(1).write.parquet(staged)
        target = f"{self.root}/covered/folds/after={number}"
        return fold if folders.move_if_absent(spark, staged, target) else None

    def sweep(self, spark, keep_hours: float = 24.0) -> list[str]:
        """Remove segments older than `keep_hours` that a fold holds, and those of lost folds."""
        names, _ = self._segments(spark)
        oldest = (time.time() - keep_hours * 3600) * 1000
        found = [
            f"{part}/{name}"
            for part in ("segments", "staged")
            for name, changed in folders.children(spark, f"{self.root}/{part}")
            if changed < oldest and name not in names and name != "none"
        ]
        for name in found:
            folders.remove(spark, f"{self.root}/{name}")
        return sorted(found)


def with_diary_states(
    t: Tables, methods: DiaryStore, views: DiaryStore, overlap: int = 0, settings=Settings()
) -> Tables:
    """Add the new entries of both diaries to their states, and let reads take the states: they join one
    row per object instead of going through the diaries."""
    spark = t.methods.sparkSession
    methods.add(methods.since(t.method_diary, overlap), settings.logged_actions)
    views.add(views.since(t.criteria_diary, overlap), settings.logged_actions)
    return replace(t, method_state=methods.state(spark), criteria_state=views.state(spark))
