"""Incremental capture: bounds, mode, epoch, and the poll itself."""

import logging
import re
import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from snapsync import schemas
from snapsync.functions.names import object_path
from snapsync.functions.text import text_sha
from snapsync.functions.times import clock_shift, days, epoch_name
from snapsync.operators.changesets import author_islands, changesets_and_messages
from snapsync.operators.diff import changed_vs_baseline
from snapsync.operators.joins import flagged, join_null_safe, known_size
from snapsync.operators.ordering import in_one_task, latest_row
from snapsync.operators.sizing import written
from snapsync.plans.changes import changes_all, changes_or_folder
from snapsync.plans.store import TABLES, Conflict, Store, epoch_snapshot
from snapsync.settings import Settings
from snapsync.sources.catalog import Tables, catalog_objects

logger = logging.getLogger(__name__)

PATH = ("source_db", "path")


def poll_bounds(now: DataFrame, control: DataFrame, settings=Settings()) -> DataFrame:
    """(source_db, last, as_of): from the high-water mark, or some days back on the first visit.

    `now` has (source_db, as_of), the time of each source, taken before its rows are read.
    """
    marks = control.select("source_db", "high_water")
    first = F.col("as_of") - days(settings.first_lookback_days)
    return now.join(marks, "source_db", "left").select(
        "source_db", F.coalesce("high_water", first).alias("last"), "as_of"
    )


def poll_mode(now: DataFrame, control: DataFrame, restored: DataFrame | None = None) -> DataFrame:
    """(source_db, full, epoch): a source without a known epoch, or restored since the last visit,
    is read in full into a new epoch that bears its time; others go on with theirs."""
    known = control.select("source_db", F.col("epoch").alias("_epoch"))
    state = now.join(known, "source_db", "left")
    if restored is not None:
        state = flagged(state, restored, ["source_db"], "_restored").withColumn(
            "_epoch", F.when(~F.col("_restored"), F.col("_epoch"))
        )
    return state.select(
        "source_db",
        F.col("_epoch").isNull().alias("full"),
        F.coalesce("_epoch", epoch_name(F.col("source_db"), F.col("as_of"))).alias("epoch"),
    )


def late_rows(rows: DataFrame, bounds: DataFrame, known: DataFrame, keys) -> DataFrame:
    """Rows stamped before their source's window that the snapshot does not know: a poll by time
    misses them."""
    before = rows.join(known_size(bounds), "source_db").where(F.col("modified") < F.col("last"))
    return before.join(known.select(*keys).distinct(), list(keys), "left_anti")


def newest_per_path(rows: DataFrame) -> DataFrame:
    """One row per file of a feed, so that a file counts once per poll. Rows without a path count by
    their object."""
    order = [F.desc_nulls_last("modified"), F.desc_nulls_last("user_modified"), F.desc("text")]
    named = [c for c in (*schemas.KEY, "extention") if c in rows.columns]
    lacking = F.when(F.col("path").isNull(), F.struct(*named)) if named else F.lit(None)
    return latest_row(rows.withColumn("_object", lacking), [*PATH, "_object"], order).drop("_object")


def feed_path():
    """The file of a change row. A row that lacks its class or name has a path of its own below `?`,
    made of what it has, so that it is kept and known again."""
    known = object_path(*map(F.col, ("class_id", "short_name", "extention")))
    return F.coalesce(known, F.concat(F.lit("?/"), F.to_json(F.struct(*schemas.KEY, "extention"))))


def poll_changesets(
    rows: DataFrame, baseline: DataFrame, settings=Settings(), shift_days=None, how="ranges"
) -> tuple[DataFrame, DataFrame]:
    """Change sets, and their messages, of a feed against a baseline (source_db, path, text_sha):
    newest row per path, without the unchanged ones, in runs of one author."""
    changed = changed_vs_baseline(newest_per_path(rows), baseline, PATH).drop("text")
    if not in_one_task(how):
        # The ordered pass reads its input twice, and the comparison is dear.
        changed = written(changed, "changed")
    islands = author_islands(changed, how=how)
    return changesets_and_messages(islands, shift_days=shift_days, settings=settings, how=how)


def capture(
    rows: DataFrame,
    states: DataFrame,
    store: Store,
    label="poll",
    settings=Settings(),
    how="ranges",
    listing: DataFrame | None = None,
) -> str:
    """Write the versions and change sets of one feed, then the control rows.

    `rows` are change rows; `states` has (source_db, epoch, as_of, local_time), one row per source.
    Rows that equal the snapshot vanish, so a feed that comes twice changes nothing. `listing` has
    (source_db, type, class_id, short_name) of everything that some sources hold: stored files of
    these sources whose object is not listed become removed versions.

    Where another poll of a source was committed meanwhile, the feed of this source is compared and
    written again; after `commit_tries` such losses Conflict is raised. A mark never moves back.
    """
    spark = rows.sparkSession
    # Fixed before anything is written: the state of a source must not move while it is used.
    states = known_size(states)
    for _ in range(settings.commit_tries):
        known = store.state(spark, settings)
        poll, won = _capture_once(rows, states, store, known, label, settings, how, listing)
        lost = [r.source_db for r in states.select("source_db").collect() if r.source_db not in won]
        if not lost:
            store.upkeep(spark, len(known.polls) + 1, settings)
            return poll
        kept = spark.createDataFrame([(source,) for source in lost], "source_db string")
        states, rows = (join_null_safe(df, kept, ["source_db"], "left_semi") for df in (states, rows))
        states = known_size(states)
        if listing is not None:
            listing = join_null_safe(listing, kept, ["source_db"], "left_semi")
    raise Conflict(f"sources {lost}: another poll was committed {settings.commit_tries} times")


def _capture_once(rows, states, store, known, label, settings, how, listing) -> tuple[str, list]:
    """The poll's name and the sources for which it was committed."""
    spark = rows.sparkSession
    # A new name for every attempt: what a failed attempt wrote is never named by control.
    poll = f"{label}.{uuid.uuid4().hex}"
    stored = epoch_snapshot(store.current_rows(spark, known), states, settings)
    feed = rows.withColumn("path", feed_path())
    changed = changed_vs_baseline(newest_per_path(feed), stored.select(*PATH, "text_sha"), PATH)
    new = changed.select(
        *("source_db", "type", "class_id", "short_name", "path", "modified", "user_modified"),
        "text",
        text_sha(F.col("text")).alias("text_sha"),
    )
    # Written once: texts, versions and change sets all come from the changed rows.
    new = written(new.join(states.select("source_db", "epoch"), "source_db"), "changed")
    old_texts = written(store.known_texts(spark, new, known), "known")
    brought = new.where("text_sha is not null").select("text_sha", "text")
    fresh = brought.join(old_texts, "text_sha", "left_anti").dropDuplicates(["text_sha"])
    store.append("texts", fresh, poll)
    versions = author_islands(
        new.drop("text").withColumn("removed", F.lit(False)),
        groups=("source_db", "epoch"),
        order=[F.asc_nulls_last("modified"), "type", "class_id", "short_name", "path"],
        how=how,
    )
    if listing is not None:
        gone = _removed(stored, listing, states).join(states.select("source_db", "epoch"), "source_db")
        versions = versions.unionByName(gone)
    text_poll = F.when(F.col("text_sha").isNotNull(), F.coalesce("text_poll", F.lit(poll)))
    versions = versions.join(old_texts, "text_sha", "left").withColumn("text_poll", text_poll)
    store.append("versions", versions, poll)
    # The change sets are built from what was written: runs of one author are numbered there.
    islands = store.poll_versions(spark, poll).where("not removed")
    shift = clock_shift(F.col("local_time"), F.col("as_of"))
    with_shift = islands.join(states.select("source_db", shift.alias("_shift")), "source_db")
    groups = ("source_db", "epoch", "changeset_id", "_shift")
    sets, messages = changesets_and_messages(with_shift, groups, F.col("_shift"), settings, how)
    store.append("changesets", sets, poll)
    store.append("messages", messages, poll)
    before = store.last_control(spark, settings, known).select("source_db", "high_water")
    control = join_null_safe(states, before, ["source_db"], "left").select(
        "source_db",
        "epoch",
        F.lit(known.next_poll_no).cast("bigint").alias("poll_no"),
        F.greatest("as_of", "high_water").alias("high_water"),
        F.col("local_time").alias("updated_at"),
    )
    return poll, store.commit(control, poll, known, settings)


def _removed(stored: DataFrame, listing: DataFrame, states: DataFrame) -> DataFrame:
    """Stored files of the listed sources whose object the listing lacks, as removed versions. They
    belong to no change set."""
    objects = listing.select("source_db", *schemas.KEY)
    sources = known_size(objects.select("source_db").distinct())
    own = stored.join(sources, "source_db", "left_semi")
    gone = join_null_safe(own, objects.distinct(), ["source_db", *schemas.KEY], "left_anti")
    return gone.join(states.select("source_db", "as_of"), "source_db").select(
        *("source_db", "type", "class_id", "short_name", "path"),
        F.col("as_of").alias("modified"),
        F.lit(None).cast("string").alias("user_modified"),
        F.lit(None).cast("string").alias("text_sha"),
        F.lit(True).alias("removed"),
        F.lit(None).cast("bigint").alias("changeset_id"),
    )


def merge_into_base(spark: SparkSession, store: Store, settings=Settings()) -> str:
    """Bring the base epoch up to each source's present epoch: files that differ become versions of
    the base, files that the epoch lost are removed there. A new epoch then starts from them. Texts
    stay where they are. A source that was merged by someone else meanwhile keeps that merge."""
    state = store.state(spark, settings)
    control = store.last_control(spark, settings, state)
    versions = store.current_rows(spark, state)
    base = control.select("source_db", F.lit(settings.base_epoch).alias("epoch"))
    own = epoch_snapshot(versions, control.select("source_db", "epoch"), settings)
    known = epoch_snapshot(versions, base, settings)
    poll = f"base.{uuid.uuid4().hex}"
    columns = [c for c in schemas.OBJECT_VERSIONS.fieldNames() if c not in ("epoch", "poll")]
    changed = join_null_safe(own, known.select(*PATH, "text_sha"), [*PATH, "text_sha"], "left_anti")
    no_text = F.lit(None).cast("string")
    gone = known.join(own.select(*PATH), list(PATH), "left_anti").withColumns(
        {"removed": F.lit(True), "text_sha": no_text, "text_poll": no_text}
    )
    rows = changed.select(*columns).unionByName(gone.select(*columns)).withColumns(
        # Change sets are numbered per poll and epoch; a merge has none.
        {"epoch": F.lit(settings.base_epoch), "changeset_id": F.lit(None).cast("bigint")}
    )
    store.append("versions", rows, poll)
    for name in ("texts", "changesets", "messages"):
        store.append(name, spark.createDataFrame([], TABLES[name]), poll)
    store.commit(
        control.select(
            "source_db",
            F.lit(settings.base_epoch).alias("epoch"),
            F.lit(state.next_poll_no).cast("bigint").alias("poll_no"),
            "high_water",
            "updated_at",
        ),
        poll,
        state,
        settings,
    )
    return poll


def run_poll(
    t: Tables,
    now: DataFrame,
    allowed: DataFrame,
    tree: DataFrame,
    store: Store,
    restored: DataFrame | None = None,
    settings=Settings(),
    how="ranges",
    package_name: str | None = None,
) -> str:
    """Poll all sources in `now` (source_db, as_of, local_time) at once. A source that is read in
    full also tells which objects it no longer has."""
    spark = now.sparkSession
    control = store.last_control(spark, settings)
    modes = poll_mode(now, control, restored)
    # Fixed before the poll writes: the state of a source must not move while it is used.
    states = written(
        now.join(modes, "source_db").join(
            poll_bounds(now, control, settings).select("source_db", "last"), "source_db"
        ),
        "states",
    )
    full, rest = states.where("full"), states.where("not full")
    # The catalogue is read only for the kinds of visit that there are.
    feeds, listing = [], None
    if not full.isEmpty():
        feeds.append(changes_or_folder(t, full, allowed, tree, settings))
        sources = known_size(full.select("source_db"))
        listing = catalog_objects(t, package_name).join(sources, "source_db", "left_semi")
    if not rest.isEmpty() or not feeds:
        feeds.append(changes_all(t, rest, allowed, settings))
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), feeds)
    return capture(rows, states, store, settings=settings, how=how, listing=listing)


@dataclass(frozen=True)
class PollStatus:
    source: str
    status: str
    poll: str | None = None
    error: str | None = None


def cause(error: BaseException) -> str:
    """Class and first line of the root cause, without the options of a connection."""
    while error.__cause__ is not None:
        error = error.__cause__
    name, text = type(error).__name__, str(error)
    java = getattr(error, "java_exception", None)
    if java is not None:
        while java.getCause() is not None:
            java = java.getCause()
        name, text = java.getClass().getSimpleName(), java.getMessage() or ""
    first = next(iter(text.strip().splitlines()), "")
    return f"{name}: {re.sub(r'jdbc:[^ ]+', 'jdbc:...', first)}"[:500].rstrip(": ")


def poll_all(spark: SparkSession, polls: dict, parallel=4) -> DataFrame:
    """Run one poll per source, each a callable that returns its poll id; an error in one source
    stays there. The result has one status row per source."""

    def one(item):
        source, poll = item
        try:
            return PollStatus(source, "ok", poll())
        except Exception as error:  # the status row carries it
            logger.exception("poll of %s failed", source)
            return PollStatus(source, "failed", None, cause(error))

    with ThreadPoolExecutor(parallel) as pool:
        statuses = list(pool.map(one, polls.items()))
    return spark.createDataFrame(
        [(s.source, s.status, s.poll, s.error) for s in statuses],
        "source string, status string, poll string, error string",
    )
