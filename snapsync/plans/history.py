"""Earlier states: between which polls a version was valid, and snapshots as of a poll or change set.

A point in a source's history is a poll number and, if wanted, the number of a change set of that poll:
the state after it. A version without a change set (a removal) takes effect at the end of its poll.
"""

from pyspark.sql import Column, DataFrame, functions as F

from snapsync.operators.joins import known_size
from snapsync.operators.ordering import latest_row, with_previous
from snapsync.settings import Settings

VERSION_KEY = ("source_db", "epoch", "path")
# Stands for the end of a poll among its change sets.
END_OF_POLL = (1 << 63) - 1


def _set_of(rows: DataFrame) -> Column:
    end = F.lit(END_OF_POLL)
    return F.coalesce("changeset_id", end) if "changeset_id" in rows.columns else end


def validity(versions: DataFrame, keys=VERSION_KEY, how="ranges") -> DataFrame:
    """Add valid_from, from_set (poll and change set that brought the version), valid_to and to_set
    (those that brought the next one of its path; null while it is valid).

    Of versions of one path and change set the newest counts; the others never were a state and go.
    """
    place = F.struct("valid_from", "from_set")
    newest_first = [F.desc("valid_from"), F.desc("from_set"), F.desc_nulls_last("modified")]
    if "poll" in versions.columns:
        newest_first.append(F.desc("poll"))
    rows = versions.withColumns({"valid_from": F.col("poll_no"), "from_set": _set_of(versions)})
    later = with_previous(rows, list(keys), newest_first, place, "_later", how)
    ends = F.col("_later.value")
    return (
        later.withColumns({"valid_to": ends["valid_from"], "to_set": ends["from_set"]})
        .where(F.col("_later").isNull() | (place < ends))
        .drop("_later")
    )


def valid_at(poll_no: Column, changeset_id: Column) -> Column:
    """Was the version valid after a change set of a poll?"""
    point = F.struct(poll_no, changeset_id)
    begun = F.struct("valid_from", "from_set") <= point
    return begun & (F.col("valid_to").isNull() | (point < F.struct("valid_to", "to_set")))


def snapshot_as_of(intervals: DataFrame, points: DataFrame, settings=Settings()) -> DataFrame:
    """Files of each source as they were at a point: rows of the epoch laid over those of the base.

    `points` has (source_db, epoch, poll_no) and perhaps changeset_id (null: the whole poll), one row per
    source. The result equals `epoch_snapshot` of the versions of all polls up to then.
    """
    chosen = known_size(
        points.select(
            "source_db",
            F.col("epoch").alias("_epoch"),
            F.col("poll_no").alias("_poll"),
            _set_of(points).alias("_set"),
        )
    )
    # What began after the last point, or ended before the first one, is left out where it is read.
    first, last = chosen.agg(F.min("_poll")).scalar(), chosen.agg(F.max("_poll")).scalar()
    near = intervals.where(
        (F.col("valid_from") <= last) & (F.col("valid_to").isNull() | (F.col("valid_to") >= first))
    )
    is_base = F.col("epoch") == settings.base_epoch
    own = F.col("epoch") == F.col("_epoch")
    # The base has change sets of its own, which are none of the point's.
    valid = valid_at(F.col("_poll"), F.when(own, F.col("_set")).otherwise(F.lit(END_OF_POLL)))
    seen = near.join(chosen, "source_db").where((is_base | own) & valid)
    newest = latest_row(seen, ["source_db", "path"], [is_base.asc(), F.desc("valid_from")])
    return newest.where(~F.coalesce("removed", F.lit(False))).drop("_epoch", "_poll", "_set")


def points_at(control: DataFrame, times: DataFrame, settings=Settings()) -> DataFrame:
    """(source_db, epoch, poll_no): the last poll of each source whose mark lies at or before a time.

    `control` has (source_db, epoch, poll_no, high_water), `times` (source_db, as_of), one row per source.
    A source without such a poll has no point. Commits to the base epoch are not the source's own.
    """
    own = control.where(~F.col("epoch").eqNullSafe(settings.base_epoch))
    seen = own.join(known_size(times.select("source_db", "as_of")), "source_db")
    before = seen.where(F.col("high_water") <= F.col("as_of"))
    newest = F.max_by(F.struct("epoch", "poll_no"), F.struct("poll_no", "epoch"))
    return before.groupBy("source_db").agg(newest.alias("_p")).select("source_db", "_p.*")


def changed_between(earlier: DataFrame, later: DataFrame) -> DataFrame:
    """(source_db, path, change, old_sha, new_sha) of two snapshots: what was added, changed, removed."""
    old = earlier.select("source_db", "path", F.col("text_sha").alias("old_sha"), F.lit(True).alias("_o"))
    new = later.select("source_db", "path", F.col("text_sha").alias("new_sha"), F.lit(True).alias("_n"))
    change = (
        F.when(F.col("_o").isNull(), "added")
        .when(F.col("_n").isNull(), "removed")
        .when(~F.col("old_sha").eqNullSafe(F.col("new_sha")), "changed")
    )
    both = old.join(new, ["source_db", "path"], "full").withColumn("change", change)
    return both.where("change is not null").select("source_db", "path", "change", "old_sha", "new_sha")
