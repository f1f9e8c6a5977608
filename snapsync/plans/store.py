"""Tables that a poll reads and writes: object versions, their texts, change sets, messages, control.

Each poll writes to folders of its own, so that polls that run at the same time share nothing. A source's
poll counts once its control row is there. That row is a folder that is moved to the name "after the
source's last poll" in one step, which succeeds once: of two polls that started from the same state one is
committed and the other has to look again. What is not named by a control row is never read.

A text is stored once, by its hash, in the folder of the poll that first brought it; versions name the
hash and that poll. No epoch and no merge copies texts.

`fold` puts together what the polls since the last fold wrote, in a folder of its own: versions with the
polls between which they were valid, and the other tables as they are. Readers take the folds and the
folders of the polls since then. `sweep` removes folders that no reader needs.
"""

import re
import time
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, Row, SparkSession, functions as F, types as T

from snapsync import schemas
from snapsync.operators.joins import join_null_safe, known_size
from snapsync.operators.ordering import latest_row
from snapsync.plans import history
from snapsync.settings import Settings
from snapsync.sources import folders

POLL_NO = T.StructField("poll_no", T.LongType())
ENDS = [T.StructField(c, T.LongType()) for c in ("valid_from", "from_set", "valid_to", "to_set")]
TABLES = {
    "versions": schemas.OBJECT_VERSIONS,
    "texts": schemas.TEXTS,
    "changesets": schemas.CHANGESETS,
    "messages": schemas.MESSAGES,
}
# What folds hold; texts belong to no source.
FOLDED = {
    "versions": T.StructType([*schemas.OBJECT_VERSIONS.fields, POLL_NO, *ENDS]),
    "texts": schemas.TEXTS,
    "changesets": T.StructType([*schemas.CHANGESETS.fields, POLL_NO]),
    "messages": T.StructType([*schemas.MESSAGES.fields, POLL_NO]),
}
PAIR = ["poll", "source_db"]


def chain_name(source_db: str | None, of_base: bool) -> str:
    """Folder of a source's control rows; commits to the base epoch follow each other on their own."""
    kind = "base" if of_base else "source"
    if source_db is None:
        return f"{kind}-_null_"
    return f"{kind}-" + re.sub(r"[^A-Za-z0-9-]", lambda m: f"_{ord(m[0]):x}_", source_db)


@dataclass(frozen=True)
class State:
    """What is committed: the folds, the control rows since the last one, and the newest control row of
    each source and kind of epoch (own or base)."""

    folds: list[str]
    fold_no: int
    fresh: list[Row]
    heads: dict[tuple, Row]
    # Polls since the last fold of which a fold holds some other source; their texts are there.
    partly_folded: frozenset = frozenset()

    @property
    def polls(self) -> list[str]:
        """Polls since the last fold."""
        return sorted({r.poll for r in self.fresh})

    @property
    def last_fold(self) -> str | None:
        return self.folds[-1] if self.folds else None

    @property
    def next_poll_no(self) -> int:
        return max((r.poll_no for r in self.heads.values()), default=0) + 1


class Conflict(Exception):
    """Other polls of the same sources were committed each time."""


@dataclass(frozen=True)
class Store:
    root: str

    def create(self, spark: SparkSession) -> "Store":
        """Make what a reader of an empty store needs."""
        for name, schema in (("control", schemas.CONTROL), ("folded", schemas.FOLDED)):
            spark.createDataFrame([], schema).write.mode("ignore").parquet(f"{self.root}/{name}/none/none")
        return self

    # --- what is committed ---------------------------------------------------------------------

    def state(self, spark, settings=Settings()) -> State:
        """Read control and folds once. Operations that get the state see nothing newer. What reaches the
        driver are the rows since the last fold, one per source, and one per fold."""
        folded = self._folded(spark)
        folds = folded.groupBy("fold").agg(F.max("fold_no").alias("n")).orderBy("n").collect()
        rows = spark.read.schema(schemas.CONTROL).parquet(f"{self.root}/control/*/*")
        partly, newest = frozenset(), []
        if folds:
            rows = join_null_safe(rows, folded.select(*PAIR), PAIR, "left_anti")
            held = folded.join(rows.select("poll").distinct(), "poll", "left_semi")
            partly = frozenset(r.poll for r in held.select("poll").distinct().collect())
            is_base = F.col("epoch").eqNullSafe(settings.base_epoch)
            own = folded.select(*schemas.CONTROL.fieldNames(), is_base.alias("_base"))
            newest = latest_row(own, ["source_db", "_base"], [F.desc("poll_no")]).drop("_base").collect()
        fresh = rows.select(*schemas.CONTROL.fieldNames()).collect()
        heads = {}
        for row in sorted([*newest, *fresh], key=lambda r: (r.poll_no, r.poll)):
            heads[row.source_db, row.epoch == settings.base_epoch] = row
        return State([r.fold for r in folds], folds[-1].n if folds else 0, fresh, heads, partly)

    def _folded(self, spark) -> DataFrame:
        """Control rows of the polls that folds hold."""
        return spark.read.schema(schemas.FOLDED).parquet(f"{self.root}/folded/*/*")

    def _read_folds(self, spark, name, folds) -> DataFrame:
        return spark.read.schema(FOLDED[name]).parquet(*[f"{self.root}/folds/{f}/{name}" for f in folds])

    def _read_polls(self, spark, name, polls) -> DataFrame:
        """The folders of some polls; no other folder is listed."""
        if not polls:
            return spark.createDataFrame([], TABLES[name])
        places = [f"{self.root}/{name}/poll={poll}" for poll in polls]
        reader = spark.read.schema(TABLES[name]).option("basePath", f"{self.root}/{name}")
        return reader.parquet(*places)

    def _since_fold(self, spark, name, state: State) -> DataFrame:
        """Rows of the polls since the last fold, with their numbers."""
        pairs = [(r.poll, r.source_db, r.poll_no) for r in state.fresh]
        numbers = spark.createDataFrame(pairs, "poll string, source_db string, poll_no long")
        rows = self._read_polls(spark, name, state.polls)
        same = (rows.poll == numbers.poll) & rows.source_db.eqNullSafe(numbers.source_db)
        return rows.join(numbers, same).select(rows["*"], numbers.poll_no)

    def _committed(self, spark, name, state: State | None) -> DataFrame:
        state = state or self.state(spark)
        new = self._since_fold(spark, name, state)
        if not state.folds:
            return new
        return self._read_folds(spark, name, state.folds).select(*new.columns).unionByName(new)

    def control(self, spark, state: State | None = None) -> DataFrame:
        state = state or self.state(spark)
        fresh = spark.createDataFrame(state.fresh, schemas.CONTROL)
        if not state.folds:
            return fresh
        return self._folded(spark).select(*fresh.columns).unionByName(fresh)

    def committed_sources(self, spark, label: str, state: State | None = None) -> DataFrame:
        """(source_db) that a poll of exactly this label has committed."""
        control = self.control(spark, state)
        return control.where(F.substring_index("poll", ".", 1) == label).select("source_db").distinct()

    def has_poll(self, spark, label: str) -> bool:
        """Is there a committed poll of exactly this label?"""
        return not self.committed_sources(spark, label).isEmpty()

    def last_control(self, spark, settings=Settings(), state: State | None = None) -> DataFrame:
        """Newest control row of each source, without commits to the base epoch."""
        state = state or self.state(spark, settings)
        own = [row for (_, of_base), row in state.heads.items() if not of_base]
        return spark.createDataFrame(own, schemas.CONTROL)

    def next_poll_no(self, spark, state: State | None = None) -> int:
        return (state or self.state(spark)).next_poll_no

    # --- versions and texts --------------------------------------------------------------------

    def version_rows(self, spark, state: State | None = None) -> DataFrame:
        """All versions of all committed polls, without texts."""
        state = state or self.state(spark)
        rows = self.current_rows(spark, state)
        if not state.folds:
            return rows
        return self._closed(spark, state).select(*rows.columns).unionByName(rows)

    def versions(self, spark) -> DataFrame:
        state = self.state(spark)
        return self.with_texts(spark, self.version_rows(spark, state), state)

    def current_rows(self, spark, state: State | None = None) -> DataFrame:
        """Versions that a snapshot needs: those the last fold holds as valid, and the polls since."""
        state = state or self.state(spark)
        new = self._since_fold(spark, "versions", state)
        if state.last_fold is None:
            return new
        return self._open(spark, state).select(*new.columns).unionByName(new)

    def current(self, spark) -> DataFrame:
        state = self.state(spark)
        return self.with_texts(spark, self.current_rows(spark, state), state)

    def _open(self, spark, state: State) -> DataFrame:
        folded = spark.read.schema(FOLDED["versions"])
        return folded.parquet(f"{self.root}/folds/{state.last_fold}/versions/open=true")

    def _closed(self, spark, state: State) -> DataFrame:
        places = [f"{self.root}/folds/{f}/versions/open=false" for f in state.folds]
        return spark.read.schema(FOLDED["versions"]).parquet(*places)

    def intervals(self, spark, state: State | None = None) -> DataFrame:
        """Every version with the polls between which it was valid: those that folds have closed, and
        the others as they follow from the last fold and the polls since."""
        state = state or self.state(spark)
        alive = history.validity(self.current_rows(spark, state)).select(*FOLDED["versions"].fieldNames())
        if not state.folds:
            return alive
        return self._closed(spark, state).unionByName(alive)

    def as_of(self, spark, points: DataFrame, settings=Settings()) -> DataFrame:
        """Snapshot with texts as of a poll or change set of each source, see `snapshot_as_of`."""
        state = self.state(spark)
        found = history.snapshot_as_of(self.intervals(spark, state), points, settings)
        return self.with_texts(spark, found, state)

    def snapshot(self, spark, epochs: DataFrame, settings=Settings()) -> DataFrame:
        """Current files of each source's epoch, with texts; these are fetched for the files alone."""
        state = self.state(spark)
        found = epoch_snapshot(self.current_rows(spark, state), epochs, settings)
        return self.with_texts(spark, found, state)

    def texts(self, spark, state: State | None = None) -> DataFrame:
        """(poll, text_sha, text): each text in the folder of the poll that brought it."""
        state = state or self.state(spark)
        new = self._read_polls(spark, "texts", sorted(set(state.polls) - state.partly_folded))
        if not state.folds:
            return new
        return self._read_folds(spark, "texts", state.folds).unionByName(new)

    def with_texts(self, spark, rows: DataFrame, state: State | None = None) -> DataFrame:
        """Add the texts of versions; a hash and the poll that brought it name one text."""
        texts = self.texts(spark, state).withColumnRenamed("poll", "text_poll")
        return rows.join(texts, ["text_sha", "text_poll"], "left")

    def known_texts(self, spark, hashes: DataFrame, state: State | None = None) -> DataFrame:
        """(text_sha, text_poll) of those hashes whose text is stored; only hashes are read."""
        stored = self.texts(spark, state).select("text_sha", F.col("poll").alias("text_poll"))
        known = stored.join(hashes.select("text_sha").distinct(), "text_sha", "left_semi")
        return known.groupBy("text_sha").agg(F.min("text_poll").alias("text_poll"))

    def changesets(self, spark) -> DataFrame:
        return self._committed(spark, "changesets", None)

    def messages(self, spark) -> DataFrame:
        return self._committed(spark, "messages", None)

    def poll_versions(self, spark, poll: str) -> DataFrame:
        """Rows of one poll, committed or not, without texts."""
        return self._read_polls(spark, "versions", [poll])

    # --- writing -------------------------------------------------------------------------------

    def append(self, name: str, rows: DataFrame, poll: str) -> None:
        columns = [c for c in TABLES[name].fieldNames() if c != "poll"]
        rows.select(*columns).write.mode("error").parquet(f"{self.root}/{name}/poll={poll}")

    def commit(self, rows: DataFrame, poll: str, state: State, settings=Settings()) -> list:
        """Commit a poll for each source in `rows` (source_db, epoch, poll_no, high_water, updated_at)
        that nobody has committed since `state` was read. Returns the sources that were committed."""
        spark = rows.sparkSession
        columns = [c for c in schemas.CONTROL.fieldNames() if c != "poll"]
        made = rows.select(*columns).collect()  # one row per source
        chains = {chain_name(r.source_db, r.epoch == settings.base_epoch): r for r in made}
        if not chains:
            return []
        heads = {chain_name(*key): row.poll_no for key, row in state.heads.items()}
        staged = f"{self.root}/staged/{poll}"
        full = [(name, poll, *[r[c] for c in columns]) for name, r in chains.items()]
        kinds = T.StructType(
            [T.StructField(c, T.StringType()) for c in ("chain", "poll")] + [schemas.CONTROL[c] for c in columns]
        )
        local = spark.createDataFrame(full, kinds).coalesce(1)
        local.write.partitionBy("chain").parquet(staged)
        won = []
        for name, row in chains.items():
            target = f"{self.root}/control/{name}/after={heads.get(name, 0)}"
            if folders.move_if_absent(spark, f"{staged}/chain={name}", target):
                won.append(row.source_db)
        folders.remove(spark, staged)
        return won

    # --- upkeep --------------------------------------------------------------------------------

    def fold(self, spark) -> str | None:
        """Put together what was committed since the last fold. Returns the fold's name, or None if
        there was nothing or another fold was faster."""
        state = self.state(spark)
        if not state.fresh:
            return None
        fold = f"fold-{uuid.uuid4().hex}"
        place = f"{self.root}/folds/{fold}"
        rows = history.validity(self.current_rows(spark, state))
        kinds = FOLDED["versions"].fieldNames()
        is_open = F.col("valid_to").isNull()
        rows.select(*kinds, is_open.alias("open")).write.partitionBy("open").parquet(f"{place}/versions")
        for kind in ("true", "false"):  # a part without rows must be readable, too
            empty = spark.createDataFrame([], FOLDED["versions"])
            empty.write.mode("append").parquet(f"{place}/versions/open={kind}")
        for name in ("changesets", "messages"):
            self._since_fold(spark, name, state).write.parquet(f"{place}/{name}")
        new = sorted(set(state.polls) - state.partly_folded)
        self._read_polls(spark, "texts", new).write.parquet(f"{place}/texts")
        held = spark.createDataFrame(state.fresh, schemas.CONTROL).withColumns(
            {"fold": F.lit(fold), "fold_no": F.lit(state.fold_no + 1).cast("long")}
        )
        staged = f"{self.root}/staged/{fold}"
        held.coalesce(1).write.parquet(staged)
        target = f"{self.root}/folded/folds/after={state.fold_no}"
        return fold if folders.move_if_absent(spark, staged, target) else None

    def sweep(self, spark, keep_hours: float = 24.0) -> list[str]:
        """Remove folders older than `keep_hours` that no reader needs: of attempts that were never
        committed, and of polls that a fold holds. Returns their names below the root.

        An attempt must not take longer than that, as its folders look like those of a failed one.
        """
        state = self.state(spark)
        oldest = (time.time() - keep_hours * 3600) * 1000
        needed = {f"poll={poll}" for poll in state.polls}
        found = [
            f"{name}/{child}"
            for name in TABLES
            for child, changed in folders.children(spark, f"{self.root}/{name}")
            if child not in needed and changed < oldest
        ]
        for name, kept in (("folds", set(state.folds)), ("staged", set())):
            below = folders.children(spark, f"{self.root}/{name}")
            found += [f"{name}/{child}" for child, changed in below if child not in kept and changed < oldest]
        waiting = {(r.poll, r.source_db) for r in state.fresh}
        control = spark.read.schema(schemas.CONTROL).parquet(f"{self.root}/control/*/*")
        placed = control.select(*PAIR, F.col("_metadata.file_path").alias("file")).collect()
        folded = {tuple(r.file.split("/")[-3:-1]) for r in placed if (r.poll, r.source_db) not in waiting}
        for chain in {chain for chain, _ in folded}:
            ages = dict(folders.children(spark, f"{self.root}/control/{chain}"))
            for own, child in folded:
                if own == chain and ages.get(child, oldest) < oldest:
                    found.append(f"control/{chain}/{child}")
        for name in found:
            folders.remove(spark, f"{self.root}/{name}")
        return sorted(found)

    def upkeep(self, spark, polls: int, settings=Settings()) -> None:
        """Fold and sweep, if that many polls since the last fold are enough."""
        if settings.polls_per_fold and polls >= settings.polls_per_fold:
            if self.fold(spark) is not None:
                self.sweep(spark, settings.keep_hours)


def newest_first():
    return [F.desc("poll_no"), F.desc_nulls_last("modified"), F.desc("poll")]


def epoch_snapshot(versions: DataFrame, epochs: DataFrame, settings=Settings()) -> DataFrame:
    """Current files of each source's epoch: rows of the epoch laid over those of the base epoch.

    `epochs` has (source_db, epoch), one row per source. Versions have poll_no; the newest version
    of a path wins.
    """
    current = known_size(epochs.select("source_db", F.col("epoch").alias("_epoch")))
    is_base = F.col("epoch") == settings.base_epoch
    seen = versions.join(current, "source_db").where(is_base | (F.col("epoch") == F.col("_epoch")))
    order = [F.desc("poll_no"), F.desc_nulls_last("modified")]
    if "poll" in versions.columns:
        order.append(F.desc("poll"))
    # Epoch rows come first, also where the epoch is the base itself.
    newest = latest_row(seen, ["source_db", "path"], [is_base.asc(), *order])
    return newest.where(~F.coalesce("removed", F.lit(False))).drop("_epoch")
