"""Change sets: consecutive changes by one author, with author, time and message."""

from pyspark.sql import Column, DataFrame, functions as F

from snapsync.functions.times import author_time
from snapsync.operators.assembly import joined_in_order
from snapsync.operators.ordering import in_one_task, number_parts, number_runs
from snapsync.operators.sizing import written
from snapsync.settings import Settings

OBJECT = ("class_id", "short_name")
# Tie-break below `modified`, so that islands do not depend on the order of reading.
TIES = ("type", "class_id", "short_name", "extention")


def author_islands(
    rows: DataFrame,
    groups=("source_db",),
    order=None,
    author="user_modified",
    alias="changeset_id",
    how="ranges",
) -> DataFrame:
    """Number the runs of consecutive rows (by time) that have the same or no author."""
    if order is None:
        order = [F.asc_nulls_last("modified"), *[c for c in TIES if c in rows.columns]]
    return number_runs(rows, list(groups), order, F.col(author), alias, how)


def changeset_objects(rows: DataFrame, groups, how="ranges") -> DataFrame:
    """One row per group and object, with what change sets and messages need of its rows. Written where
    the ordered pass follows, which reads its input twice."""
    objects = rows.groupBy(*groups, *OBJECT).agg(
        F.min("user_modified").alias("_author"),
        F.min("modified").alias("_time"),
        F.count(F.lit(1)).alias("_n"),
    )
    return objects if in_one_task(how) else written(objects, "objects")


def changeset_messages(
    objects: DataFrame, groups, settings: Settings = Settings(), how="ranges"
) -> DataFrame:
    """`autosave C1 [N1, N2], C2 [N3]` per group, classes and names distinct and ascending.

    A message lists `n_objects` objects, `names_per_message` at most; the messages of a group are
    counted by `message_no` from 0, so that no list is ever cut and none outgrows a task. A group
    without any class has no message.
    """
    groups = list(groups)
    return _messages(objects.select(*groups, *OBJECT).distinct(), groups, settings, how)


def _messages(distinct: DataFrame, groups: list, settings: Settings, how) -> DataFrame:
    order = ["class_id", F.asc_nulls_first("short_name")]
    named = distinct.where(F.col("class_id").isNotNull())
    parts = number_parts(named, groups, order, settings.names_per_message, "message_no", how)
    classes = parts.groupBy(*groups, "message_no", "class_id").agg(
        F.array_join(F.sort_array(F.collect_list("short_name")), ", ").alias("_names"),
        F.count(F.lit(1)).alias("_n"),
    )
    listed = F.concat(F.col("class_id"), F.lit(" ["), F.col("_names"), F.lit("]"))
    return classes.groupBy(*groups, "message_no").agg(
        F.sum("_n").alias("n_objects"),
        F.concat(F.lit(settings.message_prefix), joined_in_order(["class_id"], listed, ", ")).alias(
            "message"
        ),
    )


def author_name(author: Column, settings: Settings) -> Column:
    """Null and '' both stand for an unknown author."""
    return F.coalesce(F.nullif(author, F.lit("")), F.lit(settings.unknown_author))


def changesets(
    islands: DataFrame,
    groups=("source_db", "changeset_id"),
    shift_days: Column | None = None,
    settings: Settings = Settings(),
) -> DataFrame:
    """One row per change set, from rows that carry their island number; `changeset_messages` of the
    same groups lists its objects in `n_messages` messages."""
    return _facts(changeset_objects(islands, list(groups), "window"), list(groups), shift_days, settings)


def _facts(objects: DataFrame, groups: list, shift_days, settings: Settings) -> DataFrame:
    shift = F.lit(0) if shift_days is None else shift_days
    facts = objects.groupBy(*groups).agg(
        F.min("_author").alias("_author"),
        F.min("_time").alias("_time"),
        F.sum("_n").alias("_n"),
        F.count("class_id").alias("_named"),
    )
    author = author_name(F.col("_author"), settings)
    return facts.select(
        *groups,
        author.alias("author"),
        F.concat(author, F.lit(settings.mail_suffix)).alias("author_email"),
        F.lit(settings.committer).alias("committer"),
        author_time(F.col("_time"), shift, settings.author_hour_shift).alias("author_time"),
        F.col("_n").alias("n_rows"),
        F.ceil(F.col("_named") / settings.names_per_message).cast("bigint").alias("n_messages"),
    )


def changesets_and_messages(
    islands: DataFrame,
    groups=("source_db", "changeset_id"),
    shift_days: Column | None = None,
    settings: Settings = Settings(),
    how="ranges",
) -> tuple[DataFrame, DataFrame]:
    """Change sets and their messages out of one pass over the rows, which are summed up by object."""
    groups = list(groups)
    objects = changeset_objects(islands, groups, how)
    keyed = objects.select(*groups, *OBJECT)
    return _facts(objects, groups, shift_days, settings), _messages(keyed, groups, settings, how)
