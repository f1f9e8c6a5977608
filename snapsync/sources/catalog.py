"""Object catalogues and texts of the source databases.

All tables carry source_db, so one scan serves every database. Keys are (source_db, id).
"""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from snapsync.functions.names import class_after_hash, class_after_prefix, part_types
from snapsync.functions.text import strip_domain, trigger_text, view_text
from snapsync.functions.times import days, parse_object_time
from snapsync.operators.assembly import assemble_text
from snapsync.operators.joins import flagged, with_bounds
from snapsync.operators.predicates import (
    NAME_KEY,
    above_floor,
    by_allow_list,
    by_keys,
    folder_keys,
    in_window,
    with_allowed,
)
from snapsync.operators.sizing import written
from snapsync.settings import Settings

ID = ("source_db", "id")
# Up to so many ids of methods the optimizer chooses how lines meet them; they may be broadcast.
FEW_METHODS = 2_000_000


@dataclass(frozen=True)
class Tables:
    """methods(source_db, id, class_id, short_name, modified, user_modified, package_name),
    lines(source_db, id, type, line, text), method_diary(source_db, id, time),
    criteria(source_db, id, class_id, short_name, modified, condition, order_by, group_by),
    criteria_diary(source_db, id, time, seq, action, user_id),
    triggers(source_db, trigger_name, table_name, description, trigger_body),
    user_objects(source_db, object_name, object_type, timestamp),
    all_objects(source_db, object_name, object_type, last_ddl_time).
    `line_ties` orders lines of equal number. `method_state` and `criteria_state`, if given, are the
    states of the diaries (plans/diary.py) and are read in their place."""

    methods: DataFrame
    lines: DataFrame
    method_diary: DataFrame
    criteria: DataFrame
    criteria_diary: DataFrame
    triggers: DataFrame
    user_objects: DataFrame
    all_objects: DataFrame | None = None
    line_ties: tuple = ()
    method_state: DataFrame | None = None
    criteria_state: DataFrame | None = None


def catalog_objects(t: Tables, package_name: str | None = None) -> DataFrame:
    """Methods, views and triggers, and one named package when asked for."""
    key = ["source_db", "class_id", "short_name", "modified"]
    methods = t.methods.select(*key, F.lit("METHOD").alias("type"))
    views = t.criteria.select(*key, F.lit("VIEW").alias("type"))
    triggers = (
        t.user_objects.where("object_type = 'TRIGGER'")
        .join(
            t.triggers.select("source_db", F.col("trigger_name").alias("object_name"), "table_name"),
            ["source_db", "object_name"],
            "left",
        )
        .select(
            "source_db",
            class_after_prefix(F.col("table_name")).alias("class_id"),
            F.col("object_name").alias("short_name"),
            parse_object_time(F.col("timestamp")).alias("modified"),
            F.col("object_type").alias("type"),
        )
    )
    objects = methods.unionByName(views).unionByName(triggers)
    if package_name is None:
        return objects
    packages = t.all_objects.where(
        (F.upper("object_type") == "PACKAGE") & (F.col("object_name") == package_name)
    ).select(
        "source_db",
        F.lit("PACKAGES").alias("class_id"),
        F.col("object_name").alias("short_name"),
        F.col("last_ddl_time").alias("modified"),
        F.lit("PACKAGE").alias("type"),
    )
    return objects.unionByName(packages)


# --- methods -----------------------------------------------------------------------------------


def last_action(diary: DataFrame) -> DataFrame:
    return diary.groupBy(*ID).agg(F.max("time").alias("action_time"))


def last_action_time(objects: DataFrame, diary: DataFrame) -> DataFrame:
    """Add action_time: the last diary time of each object, or its own modification time."""
    return _with_last_action(objects, last_action(diary))


def _with_last_action(objects: DataFrame, actions: DataFrame) -> DataFrame:
    return objects.join(actions, list(ID), "left").withColumn(
        "action_time", F.coalesce("action_time", "modified")
    )


def _method_window(t: Tables, methods: DataFrame, bounds: DataFrame, few=False) -> DataFrame:
    """Add last, as_of and action_time.

    Diary entries before the earliest `last` cannot move a change into a window nor out of it, so
    the diary is cut where it is read; with `few` methods also to these.
    """
    earliest = bounds.agg(F.min("last")).scalar()
    if t.method_state is not None:
        actions = t.method_state.where(F.col("action_time") >= earliest).select(*ID, "action_time")
    else:
        diary = t.method_diary.where(F.col("time") >= earliest)
        if few:
            diary = diary.join(methods.select(*ID).distinct(), list(ID), "left_semi")
        actions = last_action(diary)
    return _with_last_action(with_bounds(methods, bounds), actions)


def _moved_in_window() -> Column:
    moved = F.greatest("modified", "action_time")
    return in_window(moved, F.col("last"), F.col("as_of"))


def _floor(settings: Settings) -> Column:
    return above_floor(F.col("modified"), F.col("as_of"), settings.floor_days)


def _above_common_floor(df: DataFrame, bounds: DataFrame, settings: Settings) -> DataFrame:
    """The lowest floor of all sources, as a value the scan can use to skip row groups."""
    lowest = bounds.agg(F.min("as_of") - days(settings.floor_days)).scalar()
    return df.where(F.col("modified") >= lowest)


def with_method_texts(t: Tables, methods: DataFrame, many=False) -> DataFrame:
    """Five rows per method, one for each part; a part without lines has the text ''. The ids of `many`
    methods are hashed in their shuffle's partitions, so that the lines beside them are not sorted."""
    ids = methods.select(*ID).distinct()
    lines = t.lines.join(ids.hint("shuffle_hash") if many else ids, list(ID), "left_semi")
    texts = assemble_text(lines, [*ID, "type"], ties=t.line_ties)
    parts = methods.withColumn("_part", F.explode(part_types())).select(
        *ID,
        "class_id",
        "short_name",
        "modified",
        "user_modified",
        F.col("_part.type").alias("type"),
        F.col("_part.extention").alias("extention"),
    )
    return (
        parts.join(texts, [*ID, "type"], "left")
        .withColumn("text", F.coalesce("text", F.lit("")))
        .drop("id", "type")
    )


def _chosen(methods: DataFrame) -> DataFrame:
    """Written, as the methods lead both to the lines and to the rows: diary and tree are read once,
    and the join with the lines knows how few methods are left."""
    return written(
        methods.select(*ID, "class_id", "short_name", "modified", "user_modified"), "methods"
    )


def method_rows(t: Tables, bounds, allowed, settings=Settings()) -> DataFrame:
    """Method parts that moved in the window, above the floor, by a listed user."""
    methods = by_allow_list(_above_common_floor(t.methods, bounds, settings), allowed)
    found = _method_window(t, methods, bounds, few=True).where(_moved_in_window() & _floor(settings))
    return with_method_texts(t, _chosen(found))


def method_rows_or_folder(t, bounds, allowed, tree, settings=Settings()) -> DataFrame:
    """(window and floor and listed user) or named in the tree. Only sources with bounds count."""
    named = flagged(t.methods, folder_keys(tree, "METHOD"), NAME_KEY, "in_folder")
    marked = with_allowed(_method_window(t, named, bounds), allowed)
    moved = _moved_in_window() & _floor(settings) & F.col("allowed")
    return with_method_texts(t, _chosen(marked.where(moved | F.col("in_folder"))))


# --- views -------------------------------------------------------------------------------------


def latest_user(diary: DataFrame, actions) -> DataFrame:
    """User of each object's newest entry among the given actions, without the domain."""
    return (
        diary.where(F.col("action").isin(*actions))
        .groupBy(*ID)
        .agg(F.max_by("user_id", F.struct("time", "seq")).alias("user_id"))
        .select(*ID, strip_domain(F.col("user_id")).alias("user_modified"))
    )


def _views_above_floor(t: Tables, bounds: DataFrame, settings: Settings) -> DataFrame:
    views = with_bounds(_above_common_floor(t.criteria, bounds, settings), bounds)
    return views.where(_floor(settings))


def _with_actions(t: Tables, views: DataFrame, settings: Settings) -> DataFrame:
    """Add action time and latest user, both out of one pass over the diary of these views, or out of
    its state."""
    if t.criteria_state is not None:
        diary = t.criteria_state.select(
            *ID, F.col("action_time").alias("action_date"), F.col("newest.user_id").alias("user_id")
        )
    else:
        logged = F.col("action").isin(*settings.logged_actions)
        diary = (
            t.criteria_diary.join(views.select(*ID).distinct(), list(ID), "left_semi")
            .groupBy(*ID)
            .agg(
                F.max("time").alias("action_date"),
                F.max_by("user_id", F.when(logged, F.struct("time", "seq"))).alias("user_id"),
            )
        )
    return (
        views.join(diary, list(ID), "left")
        .withColumn("action_date", F.coalesce("action_date", "modified"))
        .withColumn("user_modified", strip_domain(F.col("user_id")))
    )


def _view_columns(df: DataFrame) -> DataFrame:
    return df.select(
        "source_db",
        "class_id",
        "short_name",
        "modified",
        "action_date",
        "user_modified",
        "condition",
        "order_by",
        "group_by",
        F.lit(None).cast("string").alias("extention"),
    )


def _view_moved() -> Column:
    moved = F.greatest("modified", "action_date")
    return in_window(moved, F.col("last"), F.col("as_of"))


def view_rows(t: Tables, bounds, allowed, settings=Settings()) -> DataFrame:
    views = _with_actions(t, _views_above_floor(t, bounds, settings), settings)
    return _view_columns(by_allow_list(views.where(_view_moved()), allowed))


def view_rows_or_folder(t, bounds, allowed, tree, settings=Settings(), strict=False) -> DataFrame:
    """((window and listed user) or named in the tree) and floor.

    With `strict` the floor belongs to the first branch, as it does for methods.
    """
    if strict:
        views, moved = with_bounds(t.criteria, bounds), _view_moved() & _floor(settings)
    else:
        views, moved = _views_above_floor(t, bounds, settings), _view_moved()
    named = flagged(views, folder_keys(tree, "VIEW"), NAME_KEY, "in_folder")
    marked = with_allowed(_with_actions(t, named, settings), allowed)
    return _view_columns(marked.where((moved & F.col("allowed")) | F.col("in_folder")))


# --- triggers ----------------------------------------------------------------------------------


def trigger_objects(t: Tables) -> DataFrame:
    """Triggers with their modification time; class from the table name after '#'."""
    dates = t.user_objects.select(
        "source_db",
        F.col("object_name").alias("trigger_name"),
        parse_object_time(F.col("timestamp")).alias("modified"),
    )
    return t.triggers.join(dates, ["source_db", "trigger_name"]).select(
        "source_db",
        class_after_hash(F.col("table_name")).alias("class_id"),
        F.col("trigger_name").alias("short_name"),
        "modified",
        F.lit(None).cast("string").alias("user_modified"),
        trigger_text(F.col("description"), F.lit(None).cast("string")).alias("header"),
        F.col("trigger_body").alias("text"),
        F.lit("trg").alias("extention"),
    )


def trigger_rows(t: Tables, bounds: DataFrame, tree=None, strict=False) -> DataFrame:
    """Triggers that moved in the window. No user is known, so no user is checked.

    The reading by window or folder gives the same rows, as its folder clause is joined to an
    always-true condition; `strict` with a tree adds the triggers named there.
    """
    rows = with_bounds(trigger_objects(t), bounds)
    moved = in_window(F.col("modified"), F.col("last"), F.col("as_of"))
    if strict and tree is not None:
        rows = flagged(rows, folder_keys(tree, "TRIGGER"), NAME_KEY, "in_folder")
        moved = moved | F.col("in_folder")
    return rows.where(moved).drop("last", "as_of", "in_folder")


def max_modified(t: Tables) -> DataFrame:
    """Latest modification over all kinds."""
    return (
        t.methods.select("modified")
        .unionByName(trigger_objects(t).select("modified"))
        .unionByName(t.criteria.select("modified"))
        .agg(F.max("modified").alias("modified"))
    )


def line_order(t: Tables) -> list:
    """Total order of source lines: by class, name, type and line, and then by what tells equal ones
    apart. Lines that agree in all of it are the same."""
    return ["class_id", "short_name", "type", "line", "source_db", "id", *t.line_ties, "text"]


def methods_lines(t: Tables) -> DataFrame:
    """Every source line beside its method."""
    return t.lines.join(t.methods, list(ID))


def source_lines(t: Tables) -> DataFrame:
    """Every source line beside its method, in `line_order`."""
    return methods_lines(t).orderBy(*line_order(t)).select(
        "source_db",
        "class_id",
        "short_name",
        "package_name",
        "modified",
        "user_modified",
        "type",
        "line",
        "text",
    )


def line_counts(t: Tables) -> DataFrame:
    """Lines per method and part; they are counted by key before the methods are joined."""
    counts = t.lines.groupBy(*ID, "type").agg(F.count(F.lit(1)).alias("_n"))
    return (
        counts.join(t.methods, list(ID))
        .groupBy("class_id", "short_name", "package_name", "modified", "user_modified", "type")
        .agg(F.sum("_n").alias("n_lines"))
    )


def audit_users(*diaries: DataFrame, user="user_id") -> DataFrame:
    """Distinct users of several audit diaries, without their domains, in order."""
    users = [strip_domain(F.col(user)).alias(user)]
    found = diaries[0].select(*users).distinct()
    for diary in diaries[1:]:
        # Each diary folds on its own before they are put together.
        found = found.unionByName(diary.select(*users).distinct())
    return found.distinct().orderBy(user)


def recent_users(t: Tables, as_of: Column, n_days=30) -> DataFrame:
    return (
        t.methods.where(F.col("modified") >= as_of - days(n_days))
        .select("user_modified")
        .distinct()
        .orderBy("user_modified")
    )


def view_texts(t: Tables, keys: DataFrame, on=NAME_KEY) -> DataFrame:
    """Texts of the views with the given keys; all keys in one pass."""
    return by_keys(t.criteria, keys, on).select(
        "source_db",
        "class_id",
        "short_name",
        view_text(F.col("condition"), F.col("order_by"), F.col("group_by")).alias("text"),
    )


def trigger_texts(t: Tables, keys: DataFrame, on=NAME_KEY) -> DataFrame:
    """Texts of the triggers with the given keys, class as in the object catalogue."""
    triggers = t.triggers.select(
        "source_db",
        class_after_prefix(F.col("table_name")).alias("class_id"),
        F.col("trigger_name").alias("short_name"),
        trigger_text(F.col("description"), F.col("trigger_body")).alias("text"),
    )
    return by_keys(triggers, keys, on)


def method_texts(t: Tables, keys: DataFrame, on=NAME_KEY) -> DataFrame:
    """Part texts of the methods with the given keys; empty parts are null."""
    methods = _chosen(by_keys(t.methods, keys, on))
    rows = with_method_texts(t, methods, many=methods.count() > FEW_METHODS)
    return rows.withColumn("text", F.nullif("text", F.lit("")))
