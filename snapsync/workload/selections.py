"""Predicates, joins, aggregations, set operations and orders."""

from pyspark.sql import functions as F

from snapsync.functions.names import part_types
from snapsync.functions.text import nonblank
from snapsync.functions.times import days
from snapsync.operators import assembly, changesets, diff, joins, predicates
from snapsync.operators.ordering import latest_row, number_rows
from snapsync.settings import Settings
from snapsync.sources import catalog, tree
from snapsync.workload import fixtures as fx
from snapsync.workload.registry import query
from snapsync.workload.scans import CATALOG3, CATALOG4

S = Settings()


@query(
    "window_closed",
    f"""select c.source_db, type, class_id, short_name, modified
        from ({CATALOG4}) c join fx_bounds b on c.source_db = b.source_db
        where modified between last and as_of""",
)
def window_closed(spark, sf):
    objects = catalog.catalog_objects(fx.tables(spark, sf), fx.PACKAGE)
    found = joins.with_bounds(objects, fx.bounds(spark, sf)).where(
        predicates.in_window(F.col("modified"), F.col("last"), F.col("as_of"))
    )
    return found.drop("last", "as_of")


def _time_of_sources(spark, sf):
    """One time for all sources, as a value."""
    return fx.now(spark, sf).agg(F.max("as_of")).scalar()


@query(
    "window_lookback",
    f"""select source_db, type, class_id, short_name, modified from ({CATALOG4})
        where modified > (select max(as_of) from fx_now) - to_hours(100)""",
)
def window_lookback(spark, sf):
    objects = catalog.catalog_objects(fx.tables(spark, sf), fx.PACKAGE)
    hours = F.make_dt_interval(hours=F.lit(100))
    return objects.where(
        predicates.in_lookback(F.col("modified"), _time_of_sources(spark, sf), hours)
    )


@query(
    "recency_floor",
    """select * from fx_methods where modified >= (select max(as_of) from fx_now) - to_days(30)""",
)
def recency_floor(spark, sf):
    now = _time_of_sources(spark, sf)
    return fx.methods(spark, sf).where(
        predicates.above_floor(F.col("modified"), now, S.floor_days)
    )


@query(
    "allow_list",
    """select * from fx_methods
       where upper(user_modified) in (select upper(user_name) from fx_allow)""",
)
def allow_list(spark, sf):
    return predicates.by_allow_list(fx.methods(spark, sf), fx.allow(spark, sf))


@query(
    "select_by_keys",
    f"""select distinct c.source_db, c.type, c.class_id, c.short_name from ({CATALOG4}) c
        join fx_wanted_files f on f.type = c.type and f.source_db = c.source_db
         and f.folder = c.class_id and f.short_name = c.short_name""",
)
def select_by_keys(spark, sf):
    objects = catalog.catalog_objects(fx.tables(spark, sf), fx.PACKAGE)
    found = predicates.by_keys(objects, tree.tree_schema(fx.files(spark, sf)))
    return found.select(*predicates.OBJECT_KEY).distinct()


@query(
    "select_by_folder",
    """select m.* from fx_methods m where exists (
           select 1 from fx_wanted_files f where f.type = 'METHOD' and f.source_db = m.source_db
              and f.folder = m.class_id and upper(f.short_name) = m.short_name)""",
)
def select_by_folder(spark, sf):
    elements = tree.tree_elements(fx.files(spark, sf))
    return predicates.by_folder(fx.methods(spark, sf), elements, "METHOD")


@query(
    "nonblank_text",
    r"""select doc_id, text from (
            select doc_id, case source when 'src3' then chr(160) || chr(8195) || chr(10)
                   when 'src4' then '' when 'src5' then null when 'src6' then '  ' || text
                   else text end as text from documents)
        where regexp_matches(text, '[^\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]')""",
)
def nonblank_text(spark, sf):
    source = F.col("source")
    text = (
        F.when(source == "src3", "\u00a0\u2003\n")
        .when(source == "src4", "")
        .when(source == "src5", None)
        .when(source == "src6", F.concat(F.lit("  "), "text"))
        .otherwise(F.col("text"))
    )
    return fx.documents(spark, sf).select("doc_id", text.alias("text")).where(
        nonblank(F.col("text"))
    )


@query(
    "excluded_folders",
    """select source_db, folder, file from fx_files
       where folder not in ('.git', '.idea', '.sync', 'PLSQL', 'TESTS')""",
)
def excluded_folders(spark, sf):
    files = fx.files(spark, sf).select("source_db", "folder", "file")
    return files.where(predicates.outside_folders(F.col("folder"), S.excluded_folders))


@query(
    "any_null_rows",
    f"""select * from ({CATALOG3}) where source_db is null or class_id is null
        or short_name is null or modified is null or type is null""",
)
def any_null_rows(spark, sf):
    return predicates.any_null(catalog.catalog_objects(fx.tables(spark, sf)))


# --- joins -------------------------------------------------------------------------------------

_OBJECT_TIME = """coalesce(try_strptime(u.timestamp, '%Y-%m-%d:%H:%M:%S'),
                           try_strptime(u.timestamp, '%Y-%m-%d %H:%M:%S'))"""


@query(
    "join_inner",
    f"""select t.source_db, substr(t.table_name, instr(t.table_name, '#') + 1) as class_id,
               t.trigger_name as short_name, {_OBJECT_TIME} as modified
        from fx_triggers t join fx_user_objects u
          on t.source_db = u.source_db and t.trigger_name = u.object_name""",
)
def join_inner(spark, sf):
    return catalog.trigger_objects(fx.tables(spark, sf)).select(
        "source_db", "class_id", "short_name", "modified"
    )


@query("join_left", f"select * from ({CATALOG3}) where type = 'TRIGGER'")
def join_left(spark, sf):
    return catalog.catalog_objects(fx.tables(spark, sf)).where("type = 'TRIGGER'")


@query(
    "join_cross_parts",
    """select source_db, id, type, extention from fx_methods
       cross join (values ('EXECUTE', 'body'), ('VALIDATE', 'validate'), ('PUBLIC', 'globals'),
                          ('PRIVATE', 'locals'), ('VBSCRIPT', 'script')) e(type, extention)""",
)
def join_cross_parts(spark, sf):
    """Each method with the five fixed parts; an inlined list, so neither a join nor a shuffle."""
    return fx.methods(spark, sf).select("source_db", "id", F.inline(part_types()))


@query(
    "nested_lines",
    """select source_db, id, type, string_agg(line || ':' || coalesce(text, '?'), '|'
              order by line, tie1, tie2, text nulls first) as lines
       from fx_lines group by 1, 2, 3""",
)
def nested_lines(spark, sf):
    nested = assembly.nested_lines(
        fx.lines(spark, sf), ["source_db", "id", "type"], ties=("tie1", "tie2")
    )
    shown = F.transform(
        "lines", lambda row: F.concat_ws(":", row.line, F.coalesce(row.text, F.lit("?")))
    )
    return nested.withColumn("lines", F.array_join(shown, "|"))


@query(
    "last_action_time",
    """select m.*, coalesce((select max(time) from fx_method_diary d
                             where d.source_db = m.source_db and d.id = m.id), modified)
              as action_time
       from fx_methods m""",
)
def last_action_time(spark, sf):
    return catalog.last_action_time(fx.methods(spark, sf), fx.method_diary(spark, sf))


@query(
    "diff_indicator",
    f"""with stored as (select distinct source_db, type, folder as class_id, short_name
                        from fx_wanted_files),
             source as (select distinct source_db, type, class_id, short_name from ({CATALOG4}))
        select coalesce(a.source_db, b.source_db) as source_db, coalesce(a.type, b.type) as type,
               coalesce(a.class_id, b.class_id) as class_id,
               coalesce(a.short_name, b.short_name) as short_name,
               case when a.type is null then 'right_only' when b.type is null then 'left_only'
               else 'both' end as side
        from stored a full join source b on a.source_db is not distinct from b.source_db
         and a.type is not distinct from b.type and a.class_id is not distinct from b.class_id
         and a.short_name is not distinct from b.short_name""",
)
def diff_indicator(spark, sf):
    stored = tree.tree_elements(fx.files(spark, sf))
    source = catalog.catalog_objects(fx.tables(spark, sf), fx.PACKAGE)
    return diff.diff_indicator(stored, source, predicates.OBJECT_KEY)


_STALE = f"""
    select distinct source_db, type, folder as class_id, short_name from fx_wanted_files
    except select source_db, type, class_id, short_name from ({CATALOG4})"""


@query("stale_objects", _STALE)
def stale_objects(spark, sf):
    stored = tree.tree_elements(fx.files(spark, sf))
    source = catalog.catalog_objects(fx.tables(spark, sf), fx.PACKAGE)
    return diff.stale_objects(stored, source, predicates.OBJECT_KEY)


@query(
    "stale_not_recent",
    """with stored as (select doc_id, source from fx_snapshot),
       source as (select doc_id, source from documents where lang = 'en'),
       recent as (select id, class_id from fx_criteria where modified >= timestamp '2024-01-15')
       select * from stored except select * from source except select * from recent""",
)
def stale_not_recent(spark, sf):
    """Documents taken as the source's objects; those changed since a day are spared."""
    source = fx.table(spark, sf, "documents").where("lang = 'en'")
    since = F.lit("2024-01-15").cast("timestamp_ntz")
    recent = fx.criteria(spark, sf).where(F.col("modified") >= since).select(
        F.col("id").alias("doc_id"), F.col("class_id").alias("source")
    )
    return diff.stale_not_recent(fx.snapshot(spark, sf), source, recent, ["doc_id", "source"])


@query(
    "diff_subtract",
    """select doc_id, source, text from documents except select doc_id, source, text
       from fx_snapshot""",
)
def diff_subtract(spark, sf):
    """Rows that differ from the snapshot in any column."""
    return fx.documents(spark, sf).subtract(fx.snapshot(spark, sf))


# --- aggregations ------------------------------------------------------------------------------

_ASSEMBLED = """
    select source_db, id, type, string_agg(coalesce(text, '') || chr(10), ''
           order by line, tie1, tie2, text nulls first) as text
    from fx_lines group by 1, 2, 3"""


@query("assemble_text", _ASSEMBLED)
def assemble_text(spark, sf):
    return assembly.assemble_text(
        fx.lines(spark, sf), ["source_db", "id", "type"], ties=("tie1", "tie2")
    )


@query("assemble_text_blocks", _ASSEMBLED)
def assemble_text_blocks(spark, sf):
    """Blocks of three lines: nearly every text is joined from several."""
    return assembly.assemble_text(
        fx.lines(spark, sf), ["source_db", "id", "type"], ties=("tie1", "tie2"), lines_per_block=3
    )


@query(
    "assemble_conversations",
    """select conv_id, string_agg(text || chr(10), '' order by turn, role) as text
       from conversations group by 1""",
)
def assemble_conversations(spark, sf):
    turns = fx.table(spark, sf, "conversations")
    return assembly.assemble_text(turns, ["conv_id"], line="turn", ties=("role",))


@query(
    "max_modified",
    f"""select max(modified) as modified from (
            select modified from fx_methods union all select modified from fx_criteria union all
            select {_OBJECT_TIME} from fx_triggers t join fx_user_objects u
              on t.source_db = u.source_db and t.trigger_name = u.object_name)""",
)
def max_modified(spark, sf):
    return catalog.max_modified(fx.tables(spark, sf))


@query(
    "latest_user",
    """select source_db, id,
              regexp_replace(arg_max(user_id, (time, seq)), '.*\\.(.*)', '\\1') as user_modified
       from fx_criteria_diary where action in ('INSERTED', 'UPDATED') group by 1, 2""",
)
def latest_user(spark, sf):
    return catalog.latest_user(fx.criteria_diary(spark, sf), S.logged_actions)


@query(
    "names_per_class",
    """select source_db, class_id, 0::bigint as part_no,
              string_agg(distinct short_name, ', ' order by short_name) as names
       from fx_methods group by 1, 2""",
)
def names_per_class(spark, sf):
    return assembly.list_names(fx.methods(spark, sf), ["source_db", "class_id"], "short_name")


@query(
    "changeset_message",
    """with names as (select source_db, user_modified, class_id,
                             string_agg(distinct short_name, ', ' order by short_name) as n
                      from fx_methods group by 1, 2, 3)
       select source_db, user_modified, 0::bigint as message_no,
              (select count(distinct (class_id, short_name)) from fx_methods m
               where m.source_db = names.source_db
                 and m.user_modified is not distinct from names.user_modified) as n_objects,
              'autosave ' || string_agg(class_id || ' [' || n || ']', ', ' order by class_id)
                  as message
       from names group by 1, 2""",
)
def changeset_message(spark, sf):
    return changesets.changeset_messages(
        fx.methods(spark, sf), ["source_db", "user_modified"]
    )


@query(
    "recent_users",
    """select distinct user_modified from fx_methods
       where modified >= (select max(as_of) from fx_now) - to_days(30) order by 1""",
)
def recent_users(spark, sf):
    return catalog.recent_users(fx.tables(spark, sf), _time_of_sources(spark, sf))


@query(
    "distinct_keys",
    "select distinct source_db, folder as class_id, split_part(file, '.', 1) as short_name "
    "from fx_files",
)
def distinct_keys(spark, sf):
    name = F.substring_index("file", ".", 1).alias("short_name")
    return (
        fx.files(spark, sf)
        .select("source_db", F.col("folder").alias("class_id"), name)
        .dropDuplicates()
    )


@query(
    "lines_per_part",
    """select class_id, short_name, package_name, modified, user_modified, type,
              count(*) as n_lines
       from fx_lines l join fx_methods m on l.source_db = m.source_db and l.id = m.id
       group by 1, 2, 3, 4, 5, 6""",
)
def lines_per_part(spark, sf):
    return catalog.line_counts(fx.tables(spark, sf))


@query(
    "latest_row",
    """select * from fx_feed
       qualify row_number() over (partition by source_db, path order by modified desc) = 1""",
)
def newest_rows(spark, sf):
    return latest_row(fx.feed(spark, sf), ["source_db", "path"], [F.desc("modified")])


# --- orders and set operations -----------------------------------------------------------------


_RECENT = "modified desc nulls last, source_db, type, class_id, short_name"
_BY_NAME = "class_id nulls first, short_name nulls first, source_db, type, modified"


def _numbered(df, *order):
    """Rows in order with their place in it, so that a check of the rows also checks the order."""
    return number_rows(df, [], list(order), "place").orderBy("place")


@query(
    "recent_first",
    f"select *, row_number() over (order by {_RECENT}) as place from ({CATALOG4}) order by place",
)
def recent_first(spark, sf):
    objects = catalog.catalog_objects(fx.tables(spark, sf), fx.PACKAGE)
    ties = ["source_db", "type", "class_id", "short_name"]
    return _numbered(objects, F.desc_nulls_last("modified"), *ties)


@query(
    "sorted_objects",
    f"select *, row_number() over (order by {_BY_NAME}) as place from ({CATALOG4}) order by place",
)
def sorted_objects(spark, sf):
    objects = catalog.catalog_objects(fx.tables(spark, sf), fx.PACKAGE)
    return _numbered(objects, "class_id", "short_name", "source_db", "type", "modified")


@query(
    "all_users",
    """select distinct regexp_replace(user_id, '.*\\.(.*)', '\\1') as user_id from (
           select user_id from fx_criteria_diary
           union select c_mktsegment || '.' || c_name from customer
           union select 'X.Y.' || s_name from supplier
           union select n_name from nation)
       order by 1""",
)
def all_users(spark, sf):
    """Users of several audit diaries, without their domains."""
    def users(name, user):
        return fx.table(spark, sf, name).select(user.alias("user_id"))

    return catalog.audit_users(
        fx.criteria_diary(spark, sf),
        users("customer", F.concat_ws(".", "c_mktsegment", "c_name")),
        users("supplier", F.concat(F.lit("X.Y."), "s_name")),
        users("nation", F.col("n_name")),
    )


_BY_LINE = (
    "class_id nulls first, short_name nulls first, type nulls first, line nulls first, m.source_db, m.id, "
    "tie1 nulls first, tie2 nulls first, text nulls first"
)


@query(
    "source_lines_in_order",
    f"""select m.source_db, class_id, short_name, type, line, text,
               row_number() over (order by {_BY_LINE}) as place
        from fx_lines l join fx_methods m on l.source_db = m.source_db and l.id = m.id
        order by place""",
)
def source_lines_in_order(spark, sf):
    """The order of `source_lines` as a column."""
    t = fx.tables(spark, sf)
    found = _numbered(catalog.methods_lines(t), *catalog.line_order(t))
    return found.select("source_db", "class_id", "short_name", "type", "line", "text", "place")


@query(
    "recent_users_in_order",
    """select user_modified, row_number() over (order by user_modified nulls first) as place
       from (select distinct user_modified from fx_methods
             where modified >= (select max(as_of) from fx_now) - to_days(30)) order by place""",
)
def recent_users_in_order(spark, sf):
    users = catalog.recent_users(fx.tables(spark, sf), _time_of_sources(spark, sf))
    return _numbered(users, "user_modified")


@query(
    "floor_at_source_times",
    """select m.source_db, id, modified from fx_methods m join (
           select source_db, as_of - to_days(9 * substr(source_db, 3)::int) as as_of from fx_now) n
       on m.source_db = n.source_db where modified >= as_of - to_days(30)""",
)
def floor_at_source_times(spark, sf):
    """The recency floor of sources whose times lie days apart: more rows than one floor gives."""
    behind = 9 * F.substr("source_db", F.lit(3)).cast("int")
    bounds = fx.bounds(spark, sf).withColumn("as_of", F.col("as_of") - days(behind))
    rows = joins.with_bounds(fx.methods(spark, sf), bounds)
    floor = predicates.above_floor(F.col("modified"), F.col("as_of"), S.floor_days)
    return rows.where(floor).select("source_db", "id", "modified")


@query(
    "floor_per_source",
    """select m.source_db, id, modified from fx_methods m join fx_bounds b
       on m.source_db = b.source_db where modified >= as_of - to_days(30)""",
)
def floor_per_source(spark, sf):
    """The recency floor at each source's own time."""
    rows = joins.with_bounds(fx.methods(spark, sf), fx.bounds(spark, sf))
    return rows.where(F.col("modified") >= F.col("as_of") - days(S.floor_days)).select(
        "source_db", "id", "modified"
    )
