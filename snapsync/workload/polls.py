"""Change reads, snapshot comparison, pulls, change sets and polls."""

from dataclasses import replace

from pyspark.sql import functions as F

from snapsync.functions.text import text_sha
from snapsync.operators import changesets, diff
from snapsync.operators.sizing import new_folder, written
from snapsync.plans import changes, diary, digests, history, poll, pull, store
from snapsync.plans.store import Store
from snapsync.settings import Settings
from snapsync.sources import catalog, tree
from snapsync.streaming.capture import capture_stream, first_seen
from snapsync.streaming.late import LateRows, late_stream
from snapsync.workload import fixtures as fx
from snapsync.workload.registry import query
from snapsync.workload.scans import METHOD_TEXTS, CATALOG4

NONBLANK = (
    r"regexp_matches(text, '[^\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]')"
)
_ALLOWED = "upper(user_modified) in (select upper(user_name) from fx_allow)"

# --- rows of each kind -------------------------------------------------------------------------

_MOVED_METHODS = f"""
    select m.*, greatest(modified, coalesce((select max(time) from fx_method_diary d
                     where d.source_db = m.source_db and d.id = m.id), modified))
                between last and as_of and modified >= as_of - to_days(30)
                and {_ALLOWED} as moved
    from fx_methods m join fx_bounds b on m.source_db = b.source_db"""
_IN_TREE = """exists (select 1 from fx_wanted_files f where f.type = '{kind}'
    and f.source_db = {row}.source_db and f.folder = {row}.class_id
    and upper(f.short_name) = {row}.short_name)"""


def _method_rows(where):
    return f"""
        with chosen as (select * from ({_MOVED_METHODS}) c where {where}),
        texts as ({METHOD_TEXTS.format(methods='chosen')})
        select c.source_db, c.class_id, c.short_name, modified, user_modified,
               t.part as extention, coalesce(text, '') as text
        from chosen c join texts t on c.source_db = t.source_db and c.class_id = t.class_id
                                   and c.short_name = t.short_name"""


METHOD_ROWS = _method_rows("moved")
METHOD_OR_FOLDER = _method_rows("moved or " + _IN_TREE.format(kind="METHOD", row="c"))

_VIEWS = """
    select cr.source_db, cr.class_id, cr.short_name, cr.modified,
           coalesce((select max(time) from fx_criteria_diary d
                     where d.source_db = cr.source_db and d.id = cr.id), cr.modified) as action_date,
           (select regexp_replace(arg_max(user_id, (time, seq)), '.*\\.(.*)', '\\1')
            from fx_criteria_diary d where d.source_db = cr.source_db and d.id = cr.id
              and action in ('INSERTED', 'UPDATED')) as user_modified,
           condition, order_by, group_by, null::varchar as extention, last, as_of
    from fx_criteria cr join fx_bounds b on cr.source_db = b.source_db
    {floor}"""
_FLOOR = "where cr.modified >= as_of - to_days(30)"
_VIEW_MOVED = f"greatest(modified, action_date) between last and as_of and {_ALLOWED}"


def _view_rows(where, floor=_FLOOR):
    return f"""select * exclude (last, as_of) from ({_VIEWS.format(floor=floor)}) c
               where {where}"""


VIEW_ROWS = _view_rows(_VIEW_MOVED)
_VIEW_IN_TREE = _IN_TREE.format(kind="VIEW", row="c")
VIEW_OR_FOLDER = _view_rows(f"({_VIEW_MOVED}) or {_VIEW_IN_TREE}")
VIEW_OR_FOLDER_STRICT = _view_rows(
    f"({_VIEW_MOVED} and modified >= as_of - to_days(30)) or {_VIEW_IN_TREE}", floor=""
)

_TRIGGERS = """
    select t.source_db, substr(t.table_name, instr(t.table_name, '#') + 1) as class_id,
           t.trigger_name as short_name,
           coalesce(try_strptime(u.timestamp, '%Y-%m-%d:%H:%M:%S'),
                    try_strptime(u.timestamp, '%Y-%m-%d %H:%M:%S')) as modified,
           null::varchar as user_modified,
           'CREATE OR REPLACE TRIGGER ' || coalesce(t.description, '') as header,
           t.trigger_body as text, 'trg' as extention, last, as_of
    from fx_triggers t
    join fx_user_objects u on t.source_db = u.source_db and t.trigger_name = u.object_name
    join fx_bounds b on t.source_db = b.source_db"""
TRIGGER_ROWS = f"""select * exclude (last, as_of) from ({_TRIGGERS})
                   where modified between last and as_of"""
TRIGGER_OR_FOLDER_STRICT = f"""select * exclude (last, as_of) from ({_TRIGGERS}) c
    where modified between last and as_of or {_IN_TREE.format(kind='TRIGGER', row='c')}"""

_VIEW_TEXT = "coalesce(condition, '') || coalesce(order_by, '') || coalesce(group_by, '')"


def _all_kinds(methods, views, triggers):
    return f"""
        select * from (
            select source_db, class_id, short_name, modified, user_modified, extention, text,
                   'METHOD' as type, null::timestamp as action_date from ({methods})
            union all
            select source_db, class_id, short_name, modified, user_modified, extention,
                   {_VIEW_TEXT} as text, 'VIEW', action_date from ({views})
            union all
            select source_db, class_id, short_name, modified, user_modified, extention,
                   header || coalesce(text, '') as text, 'TRIGGER', null from ({triggers}))
        where {NONBLANK}"""


CHANGES_ALL = _all_kinds(METHOD_ROWS, VIEW_ROWS, TRIGGER_ROWS)
CHANGES_OR_FOLDER = _all_kinds(METHOD_OR_FOLDER, VIEW_OR_FOLDER, TRIGGER_ROWS)


def _inputs(spark, sf):
    """Tables, bounds and users; the bounds of a poll are a stored table."""
    return fx.tables(spark, sf), written(fx.bounds(spark, sf), "bounds"), fx.allow(spark, sf)


def _elements(spark, sf):
    return tree.tree_schema(fx.files(spark, sf))


@query("method_parts", METHOD_ROWS)
def method_parts(spark, sf):
    return catalog.method_rows(*_inputs(spark, sf))


@query("view_rows", VIEW_ROWS)
def view_rows(spark, sf):
    return catalog.view_rows(*_inputs(spark, sf))


def _diary_stores(spark, sf):
    """States of both diaries after three batches, of which each goes on within the one before."""
    stores = []
    folder = new_folder(spark, "diary")
    for name, entries in (("methods", fx.method_diary(spark, sf)), ("views", fx.criteria_diary(spark, sf))):
        kept = diary.DiaryStore(f"{folder}/{name}").create(spark)
        day = F.dayofmonth("time")
        for first, last in ((1, 12), (10, 22), (20, 31)):
            kept.add(entries.where(day.between(first, last)))
        kept.fold(spark)
        stores.append(kept)
    return stores


def _with_states(spark, sf):
    """The inputs with the states in the diaries' place; the diaries themselves are empty."""
    t, bounds, allowed = _inputs(spark, sf)
    methods, views = _diary_stores(spark, sf)
    t = replace(t, method_diary=t.method_diary.limit(0), criteria_diary=t.criteria_diary.limit(0))
    return diary.with_diary_states(t, methods, views), bounds, allowed


@query(
    "latest_user_incremental",
    """select source_db, id,
              regexp_replace(arg_max(user_id, (time, seq)), '.*\\.(.*)', '\\1') as user_modified
       from fx_criteria_diary where action in ('INSERTED', 'UPDATED') group by 1, 2""",
)
def latest_user_incremental(spark, sf):
    return diary.latest_users(_diary_stores(spark, sf)[1].state(spark))


@query("view_rows_by_state", VIEW_ROWS)
def view_rows_by_state(spark, sf):
    return catalog.view_rows(*_with_states(spark, sf))


@query("method_parts_by_state", METHOD_ROWS)
def method_parts_by_state(spark, sf):
    return catalog.method_rows(*_with_states(spark, sf))


@query("trigger_rows", TRIGGER_ROWS)
def trigger_rows(spark, sf):
    return catalog.trigger_rows(fx.tables(spark, sf), fx.bounds(spark, sf))


@query("window_or_folder_method", METHOD_OR_FOLDER)
def window_or_folder_method(spark, sf):
    t, bounds, allowed = _inputs(spark, sf)
    return changes.window_or_folder(t, "METHOD", bounds, allowed, _elements(spark, sf))


@query("window_or_folder_view", VIEW_OR_FOLDER)
def window_or_folder_view(spark, sf):
    t, bounds, allowed = _inputs(spark, sf)
    return changes.window_or_folder(t, "VIEW", bounds, allowed, _elements(spark, sf))


@query("window_or_folder_trigger", TRIGGER_ROWS)
def window_or_folder_trigger(spark, sf):
    t, bounds, allowed = _inputs(spark, sf)
    return changes.window_or_folder(t, "TRIGGER", bounds, allowed, _elements(spark, sf))


@query("window_or_folder_view_strict", VIEW_OR_FOLDER_STRICT)
def window_or_folder_view_strict(spark, sf):
    t, bounds, allowed = _inputs(spark, sf)
    return changes.window_or_folder(t, "VIEW", bounds, allowed, _elements(spark, sf), strict=True)


@query("window_or_folder_trigger_strict", TRIGGER_OR_FOLDER_STRICT)
def window_or_folder_trigger_strict(spark, sf):
    t, bounds, allowed = _inputs(spark, sf)
    return changes.window_or_folder(t, "TRIGGER", bounds, allowed, _elements(spark, sf), strict=True)


@query(
    "normalized_rows",
    f"""select source_db, class_id, short_name, modified, action_date, user_modified, extention,
               text, 'VIEW' as type
        from (select *, {_VIEW_TEXT} as text from ({VIEW_ROWS})) where {NONBLANK}""",
)
def normalized_rows(spark, sf):
    return changes.normalized_rows(catalog.view_rows(*_inputs(spark, sf)), "VIEW")


@query(
    "changes_of_kind",
    f"""select *, 'METHOD' as type from ({METHOD_ROWS}) where {NONBLANK}""",
)
def changes_of_kind(spark, sf):
    t, bounds, allowed = _inputs(spark, sf)
    return changes.changes_of_kind(t, "METHOD", bounds, allowed)


@query("changes_all", CHANGES_ALL)
def changes_all(spark, sf):
    return changes.changes_all(*_inputs(spark, sf))


@query("changes_or_folder", CHANGES_OR_FOLDER)
def changes_or_folder(spark, sf):
    return changes.changes_or_folder(*_inputs(spark, sf), _elements(spark, sf))


@query(
    "concat_kinds",
    """select source_db, class_id, short_name, modified, null::varchar as package_name, 'V' as kind
       from fx_criteria
       union all
       select source_db, class_id, short_name, modified, package_name, 'M' from fx_methods""",
)
def concat_kinds(spark, sf):
    """Kinds with different columns; what one lacks is null."""
    key = ["source_db", "class_id", "short_name", "modified"]
    views = fx.criteria(spark, sf).select(*key, F.lit("V").alias("kind"))
    methods = fx.methods(spark, sf).select(*key, "package_name", F.lit("M").alias("kind"))
    return changes.concat_kinds([views, methods])


# --- comparison with a snapshot ----------------------------------------------------------------


@query(
    "changed_vs_baseline",
    """select d.doc_id, d.source, d.text from documents d left join fx_snapshot s
         on d.doc_id = s.doc_id where d.text is distinct from s.text""",
)
def changed_vs_baseline(spark, sf):
    stored = fx.snapshot(spark, sf).select("doc_id", text_sha(F.col("text")).alias("text_sha"))
    return diff.changed_vs_baseline(fx.documents(spark, sf), stored, ["doc_id"])


_EFFECTIVE = """
    select * exclude (dirty, prev) from (
        select *, lag(dirty, 1, false) over (partition by source_db, path order by modified) as prev
        from (select f.*, b.text is distinct from f.text as dirty
              from fx_recent_feed f left join fx_baseline b
                on f.source_db = b.source_db and f.path = b.path))
    where dirty <> prev"""


def _effective(spark, sf, how):
    found = diff.effective_changes(
        fx.recent_feed(spark, sf),
        fx.baseline(spark, sf),
        ["source_db", "path"],
        ["modified"],
        how=how,
    )
    return found.drop("dirty")


@query("effective_changes", _EFFECTIVE)
def effective_changes(spark, sf):
    return _effective(spark, sf, "window")


@query("effective_changes_ranges", _EFFECTIVE)
def effective_changes_ranges(spark, sf):
    return _effective(spark, sf, "ranges")


# --- pulls -------------------------------------------------------------------------------------


def _export(keys, catalog_class="substr(t.table_name, 3)"):
    """Files of the non-package objects in the CTE named by `keys`."""
    return f"""
        select source_db, 'METHOD' as type, class_id, short_name,
               class_id || '/' || short_name || '.' || part || '.sql' as path, text
        from ({METHOD_TEXTS.format(methods=f'''(select m.* from fx_methods m join {keys} k
              on k.type = 'METHOD' and k.source_db = m.source_db and k.class_id = m.class_id
              and k.short_name = m.short_name)''')})
        union all
        select c.source_db, 'VIEW', c.class_id, c.short_name,
               c.class_id || '/' || c.short_name || '.sql', {_VIEW_TEXT}
        from fx_criteria c join {keys} k on k.type = 'VIEW' and k.source_db = c.source_db
              and k.class_id = c.class_id and k.short_name = c.short_name
        union all
        select t.source_db, 'TRIGGER', k.class_id, t.trigger_name,
               k.class_id || '/' || t.trigger_name || '.trg.sql',
               'CREATE OR REPLACE TRIGGER ' || coalesce(t.description, '') ||
               coalesce(t.trigger_body, '')
        from fx_triggers t join {keys} k on k.type = 'TRIGGER' and k.source_db = t.source_db
              and k.class_id = {catalog_class} and k.short_name = t.trigger_name"""


_FILES = """select source_db, type, folder as class_id, short_name,
                   folder || '/' || file as path, text from fx_wanted_files"""


def _pulled(keys, stored=_FILES):
    return f"""
        with keys as (select distinct source_db, type, class_id, short_name from ({keys})),
        export as ({_export('keys')}), stored as ({stored})
        select * from export where text <> ''
        union all
        select * from stored s where not exists (
            select 1 from export e where e.source_db = s.source_db and e.path = s.path)"""


_FOUND = f"""select c.* from ({CATALOG4}) c join fx_wanted_files f on f.type = c.type
    and f.source_db = c.source_db and f.folder = c.class_id and f.short_name = c.short_name"""


def _snapshot(spark, sf):
    return pull.snapshot_of_files(fx.files(spark, sf))


def _time(spark, sf):
    return fx.now(spark, sf).agg(F.max("as_of")).scalar()


@query("export_parts", f"with keys as (select distinct source_db, type, class_id, short_name "
                       f"from ({_FOUND})) {_export('keys')}")
def export_parts(spark, sf):
    t = fx.tables(spark, sf)
    keys = pull.predicates.by_keys(
        catalog.catalog_objects(t, fx.PACKAGE), _elements(spark, sf)
    ).distinct()
    return pull.export_parts(t, keys)


PULL_ALL = _pulled(
    _FOUND,
    f"""select * from ({_FILES}) w where w.type <> 'UNKNOWN' and exists (
            select 1 from ({CATALOG4}) c where c.type = w.type and c.source_db = w.source_db
            and c.class_id = w.class_id and c.short_name = w.short_name)""",
)


@query("pull_all", PULL_ALL)
def pull_all(spark, sf):
    return pull.pull_all(fx.tables(spark, sf), _snapshot(spark, sf), fx.PACKAGE)


def _edited(files):
    """A pulled snapshot in which two classes were changed by hand and one got files of no kind."""
    text = F.when(F.col("class_id").isin("1-URGENT", "src3"), F.concat("text", F.lit(" edited")))
    junk = files.where("class_id = '2-HIGH'").select(
        "source_db",
        F.lit("UNKNOWN").alias("type"),
        "class_id",
        "short_name",
        F.concat("path", F.lit(".txt")).alias("path"),
        "text",
    )
    return files.withColumn("text", text.otherwise(F.col("text"))).unionByName(junk)


@query("pull_changed_classes", PULL_ALL)
def pull_changed_classes(spark, sf):
    """A second full pull, after some files were edited and one class of the sources has moved: it gives
    what the first one gave."""
    t = fx.tables(spark, sf)
    # A join of two tables that each step reads.
    t = replace(t, methods=written(t.methods, "methods"))
    pulled = written(pull.pull_all(t, _snapshot(spark, sf), fx.PACKAGE), "pulled")
    day = F.make_dt_interval(days=F.lit(1))
    moved = F.when(F.col("class_id") == "3-MEDIUM", F.col("modified") - day)
    before = replace(t, methods=t.methods.withColumn("modified", moved.otherwise(F.col("modified"))))
    kept = written(digests.pull_digests(before, pulled, fx.PACKAGE), "digests")
    return digests.pull_changed_classes(t, _edited(pulled), kept, fx.PACKAGE)


def _code(*columns, place):
    """One number of a row's digest."""
    parts = " || chr(31) || ".join(f"coalesce('=' || {c}::varchar, '')" for c in columns)
    return f"('0x' || substr(md5({parts}), {place}, 8))::bigint"


_DIGESTED = ("source_db", "class_id", "type", "short_name", "modified")


@query(
    "digest_tree",
    f"""select case when grouping(class_id) = 1 then 'source' when grouping(short_name) = 1 then 'class'
               else 'object' end as level, source_db, class_id, type, short_name,
               count(*) as n, sum({_code(*_DIGESTED, place=1)})::bigint as low,
               sum({_code(*_DIGESTED, place=9)})::bigint as high
        from ({CATALOG4}) group by grouping sets ((source_db), (source_db, class_id),
                                                  (source_db, class_id, type, short_name))""",
)
def digest_tree(spark, sf):
    objects = catalog.catalog_objects(fx.tables(spark, sf), fx.PACKAGE)
    return digests.digest_tree(objects, "modified")


@query(
    "pull_last",
    _pulled(f"""select * from ({CATALOG4})
                where modified > (select max(as_of) from fx_now) - to_hours(200)"""),
)
def pull_last(spark, sf):
    return pull.pull(
        fx.tables(spark, sf),
        _snapshot(spark, sf),
        as_of=_time(spark, sf),
        interval=F.make_dt_interval(hours=F.lit(200)),
        package_name=fx.PACKAGE,
    )


@query(
    "pull_since",
    _pulled(f"""select * from ({CATALOG4}) where modified between timestamp '2024-01-15'
                and (select max(as_of) from fx_now)"""),
)
def pull_since(spark, sf):
    return pull.pull(
        fx.tables(spark, sf),
        _snapshot(spark, sf),
        as_of=_time(spark, sf),
        last=F.lit("2024-01-15").cast("timestamp_ntz"),
        package_name=fx.PACKAGE,
    )


@query(
    "refresh_class",
    f"""with named as (select m.* from fx_methods m where exists (
             select 1 from fx_wanted_files f where f.source_db = m.source_db
             and f.folder = m.class_id and f.short_name = m.short_name)),
        texts as ({METHOD_TEXTS.format(methods='named')})
        select source_db, class_id, short_name, part as extention,
               regexp_replace(text, '[ \\t\\r\\f\\x0B]*\\n', chr(13) || chr(10), 'g') as text
        from texts where text <> ''""",
)
def refresh_class(spark, sf):
    return pull.refresh_classes(fx.tables(spark, sf), fx.files(spark, sf))


# --- change sets -------------------------------------------------------------------------------

_ISLANDS = """
    select *, sum(starts) over (partition by source_db order by modified)::bigint as changeset_id
    from (select *, case when row_number() over w = 1 or lag(user_modified) over w
                         is distinct from user_modified then 1 else 0 end as starts
          from {feed} window w as (partition by source_db order by modified))"""


@query("author_islands", f"select * exclude (starts) from ({_ISLANDS.format(feed='fx_feed')})")
def author_islands(spark, sf):
    return changesets.author_islands(fx.feed(spark, sf), how="window")


@query(
    "author_islands_ranges", f"select * exclude (starts) from ({_ISLANDS.format(feed='fx_feed')})"
)
def author_islands_ranges(spark, sf):
    return changesets.author_islands(fx.feed(spark, sf), how="ranges")


def _sets(feed, shift_days="0", per_message=100_000):
    """Change sets of the rows in the CTE named by `feed`."""
    return f"""
        islands as ({_ISLANDS.format(feed=feed)}),
        facts as (select source_db, changeset_id,
                         coalesce(min(user_modified), 'Неизвестный автор') as author,
                         min(modified) as first_time, count(*) as n_rows
                  from islands group by 1, 2),
        placed as (select *, (row_number() over (partition by source_db, changeset_id
                                     order by class_id, short_name) - 1) // {per_message} as message_no
                   from (select distinct source_db, changeset_id, class_id, short_name from islands)),
        names as (select source_db, changeset_id, message_no, class_id, count(*) as k,
                         string_agg(short_name, ', ' order by short_name) as n
                  from placed group by 1, 2, 3, 4),
        messages as (select source_db, changeset_id, message_no::bigint as message_no,
                            sum(k)::bigint as n_objects, max(message_no) over (
                                partition by source_db, changeset_id) + 1 as n_messages,
                            'autosave ' || string_agg(class_id || ' [' || n || ']', ', '
                                                      order by class_id) as message
                     from names group by source_db, changeset_id, names.message_no)
        select f.source_db, f.changeset_id, m.message_no, author,
               author || '@mail' as author_email, 'sources_sync_job' as committer,
               strftime(first_time - to_hours(3) + to_days({shift_days}), '%d.%m.%YT%H:%M:%S')
                   as author_time, n_rows, n_messages, n_objects, message
        from facts f join messages m
          on f.source_db = m.source_db and f.changeset_id = m.changeset_id"""


def _with_messages(sets, messages, on=("source_db", "changeset_id")):
    """Change sets beside each of their messages."""
    return sets.join(messages, list(on))


def _change_sets(spark, sf, how):
    islands = changesets.author_islands(fx.feed(spark, sf), how=how)
    return _with_messages(*changesets.changesets_and_messages(islands, how=how))


@query("changesets", "with " + _sets("fx_feed"))
def change_sets(spark, sf):
    return _change_sets(spark, sf, "window")


@query("changesets_ranges", "with " + _sets("fx_feed"))
def change_sets_ranges(spark, sf):
    """For sources of any size."""
    return _change_sets(spark, sf, "ranges")


@query("changesets_in_parts", "with " + _sets("fx_feed", per_message=1))
def change_sets_in_parts(spark, sf):
    """Messages that list one object each: the sets stay one row each."""
    settings = replace(Settings(), names_per_message=1)
    islands = changesets.author_islands(fx.feed(spark, sf))
    return _with_messages(*changesets.changesets_and_messages(islands, settings=settings))


_CHANGED = """
    changed as (
        select f.* from (select * from fx_recent_feed qualify
                         row_number() over (partition by source_db, path order by modified desc) = 1) f
        left join fx_baseline b on f.source_db = b.source_db and f.path = b.path
        where f.text is distinct from b.text)"""


@query("poll_changesets", f"with {_CHANGED}, " + _sets("changed"))
def poll_changesets(spark, sf):
    """The whole incremental path: newest row per file, changed ones, islands, change sets."""
    return _with_messages(
        *poll.poll_changesets(fx.recent_feed(spark, sf), fx.baseline(spark, sf), how="window")
    )


@query("poll_changesets_ranges", f"with {_CHANGED}, " + _sets("changed"))
def poll_changesets_ranges(spark, sf):
    return _with_messages(*poll.poll_changesets(fx.recent_feed(spark, sf), fx.baseline(spark, sf)))


# --- incremental state -------------------------------------------------------------------------


@query(
    "poll_bounds",
    """select n.source_db, coalesce(high_water, as_of - to_days(7)) as last, as_of
       from fx_now n left join fx_control c on n.source_db = c.source_db""",
)
def poll_bounds(spark, sf):
    return poll.poll_bounds(fx.now(spark, sf), fx.control(spark, sf))


@query(
    "poll_mode",
    """select n.source_db, epoch is null as full,
              coalesce(epoch, n.source_db || '_' || strftime(as_of, '%Y.%m.%d_%H.%M')) as epoch
       from fx_now n left join fx_control c on n.source_db = c.source_db""",
)
def poll_mode(spark, sf):
    return poll.poll_mode(fx.now(spark, sf), fx.control(spark, sf))


@query(
    "poll_idempotent",
    """with second as (
           select f.* from fx_feed f join fx_control c on f.source_db = c.source_db
           where f.modified >= c.high_water
           qualify row_number() over (partition by f.source_db, path order by modified desc) = 1)
       select s.source_db, s.path, s.modified, s.text from second s left join fx_baseline b
         on s.source_db = b.source_db and s.path = b.path
       where s.text is distinct from b.text""",
)
def poll_idempotent(spark, sf):
    """What a second poll finds that starts at the first one's mark. The row on the mark is read
    again; where it is still the newest of its file it equals the snapshot and vanishes."""
    marks = fx.control(spark, sf).select("source_db", F.col("high_water").alias("last"))
    rows = fx.feed(spark, sf).join(marks, "source_db").where(F.col("modified") >= F.col("last"))
    newest = poll.newest_per_path(rows).select("source_db", "path", "modified", "text")
    return diff.changed_vs_baseline(newest, fx.baseline(spark, sf), ["source_db", "path"])


@query(
    "epoch_base",
    """select source_db, path, modified, text, poll_no, epoch, removed from (
           select * from fx_versions where epoch = 'master'
              or epoch = source_db || '_2024.01.02_03.04'
           qualify row_number() over (partition by source_db, path
                   order by epoch = 'master', poll_no desc, modified desc) = 1)
       where not removed""",
)
def epoch_base(spark, sf):
    rows = fx.versions(spark, sf)
    epochs = fx.now(spark, sf).select(
        "source_db", F.concat("source_db", F.lit("_2024.01.02_03.04")).alias("epoch")
    )
    return store.epoch_snapshot(rows, epochs)


@query(
    "late_rows",
    """select f.source_db, f.path, f.modified from fx_feed f
       join (select n.source_db, coalesce(high_water, as_of - to_days(7)) as last
             from fx_now n left join fx_control c on n.source_db = c.source_db) b
         on f.source_db = b.source_db
       where f.modified < last and not exists (
           select 1 from fx_versions v where v.epoch = 'old' and v.source_db = f.source_db
             and v.path = f.path and v.modified = f.modified)""",
)
def late_rows(spark, sf):
    """Rows before the window that the stored versions (here one epoch of them) do not hold."""
    rows = fx.feed(spark, sf).select("source_db", "path", "modified")
    bounds = poll.poll_bounds(fx.now(spark, sf), fx.control(spark, sf))
    known = fx.versions(spark, sf).where("epoch = 'old'")
    keys = ["source_db", "path", "modified"]
    return poll.late_rows(rows, bounds, known, keys).select(*keys)


@query(
    "stream_late_rows",
    """select distinct f.source_db, f.path, f.modified from fx_feed f
       join (select n.source_db, coalesce(high_water, as_of - to_days(7)) as last
             from fx_now n left join fx_control c on n.source_db = c.source_db) b
         on f.source_db = b.source_db
       where f.modified < last and not exists (
           select 1 from fx_versions v where v.epoch = 'old' and v.source_db = f.source_db
             and v.path = f.path and v.modified = f.modified)""",
)
def stream_late_rows(spark, sf):
    """The same rows out of a stream that brings each row twice, kept for the next poll."""
    folder, keys = new_folder(spark, "late"), ("source_db", "path", "modified")
    stream = _event_stream(spark, sf).select(*keys)
    kept = LateRows(folder, stream.schema, keys)
    late_stream(
        stream.union(_event_stream(spark, sf).select(*keys)),
        kept,
        lambda: poll.poll_bounds(fx.now(spark, sf), fx.control(spark, sf)),
        lambda: fx.versions(spark, sf).where("epoch = 'old'"),
        f"{folder}/checkpoint",
    ).awaitTermination()
    return kept.rows(spark, kept.waiting(spark))


# --- earlier states -----------------------------------------------------------------------------

_INTERVALS = """
    select * from (
        select *, poll_no as valid_from, lead(poll_no) over (
                   partition by source_db, epoch, path order by poll_no, modified) as valid_to
        from fx_versions)
    where valid_to is null or valid_from < valid_to"""
# A point of its own for each source, within its polls.
_POINTS = """select source_db, source_db || '_2024.01.02_03.04' as epoch,
                    (11 + 4 * substr(source_db, 3)::bigint) as poll_no from fx_now"""


def _points(spark, sf):
    number = 11 + 4 * F.substr("source_db", F.lit(3)).cast("long")
    epoch = F.concat("source_db", F.lit("_2024.01.02_03.04"))
    return fx.now(spark, sf).select("source_db", epoch.alias("epoch"), number.alias("poll_no"))


def _as_of(points):
    """Replay: the newest versions of the polls up to each source's point, epoch over base."""
    return f"""
        select source_db, path, modified, text, poll_no, epoch from (
            select v.* from fx_versions v join ({points}) p on v.source_db = p.source_db
            where v.poll_no <= p.poll_no and (v.epoch = 'master' or v.epoch = p.epoch)
            qualify row_number() over (partition by v.source_db, path
                    order by v.epoch = 'master', v.poll_no desc, modified desc) = 1)
        where not removed"""


@query("version_intervals", _INTERVALS)
def version_intervals(spark, sf):
    return history.validity(fx.versions(spark, sf)).drop("from_set", "to_set")


@query("snapshot_as_of", _as_of(_POINTS))
def snapshot_as_of(spark, sf):
    """Each source as of another poll, out of the intervals; the SQL replays the polls."""
    intervals = history.validity(fx.versions(spark, sf))
    found = history.snapshot_as_of(intervals, _points(spark, sf))
    return found.select("source_db", "path", "modified", "text", "poll_no", "epoch")


_MARKS = """select source_db, epoch, poll_no, max(modified) as high_water
            from fx_versions group by 1, 2, 3"""


def _marks(spark, sf):
    keys = ["source_db", "epoch", "poll_no"]
    return fx.versions(spark, sf).groupBy(*keys).agg(F.max("modified").alias("high_water"))


@query(
    "points_at",
    f"""select m.source_db, epoch, poll_no from ({_MARKS}) m join fx_now n on m.source_db = n.source_db
        where epoch <> 'master' and high_water <= as_of - to_days(3)
        qualify row_number() over (partition by m.source_db order by poll_no desc, epoch desc) = 1""",
)
def points_at(spark, sf):
    """The last poll of each source three days before its newest row."""
    before = F.col("as_of") - F.make_dt_interval(days=F.lit(3))
    times = fx.now(spark, sf).withColumn("as_of", before)
    return history.points_at(_marks(spark, sf), times)


_LATER_POINTS = f"select source_db, epoch, poll_no + 6 as poll_no from ({_POINTS})"


@query(
    "changed_between",
    f"""select coalesce(o.source_db, n.source_db) as source_db, coalesce(o.path, n.path) as path,
               case when o.path is null then 'added' when n.path is null then 'removed'
               else 'changed' end as change, sha256(o.text) as old_sha, sha256(n.text) as new_sha
        from ({_as_of(_POINTS)}) o full join ({_as_of(_LATER_POINTS)}) n
          on o.source_db = n.source_db and o.path = n.path
        where o.text is distinct from n.text or o.path is null or n.path is null""",
)
def changed_between(spark, sf):
    """What six polls changed, from two snapshots."""
    rows = fx.versions(spark, sf).withColumn("text_sha", text_sha(F.col("text"))).drop("text")
    intervals = history.validity(rows)
    first = _points(spark, sf)
    second = first.withColumn("poll_no", F.col("poll_no") + 6)
    return history.changed_between(
        history.snapshot_as_of(intervals, first), history.snapshot_as_of(intervals, second)
    )


_CAPTURED = f"""with changed as (
    select * from fx_feed qualify
    row_number() over (partition by source_db, path order by modified desc) = 1), """
_SET_COLUMNS = (
    "source_db",
    "changeset_id",
    "message_no",
    "author",
    "author_email",
    "committer",
    "author_time",
    "n_rows",
    "n_messages",
    "n_objects",
    "message",
)


def _stored_sets(spark, tables):
    """The stored change sets beside their messages."""
    on = ("source_db", "epoch", "poll", "poll_no", "changeset_id")
    sets = _with_messages(tables.changesets(spark), tables.messages(spark), on)
    return sets.select(*_SET_COLUMNS)


@query("poll_capture", _CAPTURED + _sets("changed", shift_days="2"))
def poll_capture(spark, sf):
    """A poll through the stored tables: the feed is captured twice and counts once."""
    tables = Store(new_folder(spark, "store")).create(spark)
    states = fx.now(spark, sf).withColumn("epoch", F.lit("first"))
    for _ in range(2):
        poll.capture(fx.feed(spark, sf).drop("path"), states, tables)
    return _stored_sets(spark, tables)


def _captured(spark, sf, parts=1):
    """A store into which the feed was captured in parts by time, one poll each."""
    tables = Store(new_folder(spark, "store")).create(spark)
    states = fx.now(spark, sf).withColumn("epoch", F.lit("first"))
    feed = fx.feed(spark, sf).drop("path")
    for part in range(parts):
        days = F.dayofmonth("modified") % parts == part
        poll.capture(feed.where(days), states, tables)
    return tables


@query(
    "stored_texts",
    """with newest as (
           select *, day(modified) % 2 as part from fx_feed qualify row_number() over (
               partition by source_db, path, day(modified) % 2 order by modified desc) = 1)
       select distinct text, sha256(text) as text_sha from newest""",
)
def stored_texts(spark, sf):
    """Two polls that bring many files of few texts: each text is stored once."""
    return _captured(spark, sf, 2).texts(spark).select("text", "text_sha")


def _event_stream(spark, sf):
    """The events file as a stream of files, in the columns of the feed."""
    schema = fx.table(spark, sf, "events").schema
    events = spark.readStream.schema(schema).parquet(f"{sf}/events*.parquet")
    return fx.feed_of(events)


@query("stream_changes", _CAPTURED + _sets("changed"))
def stream_changes(spark, sf):
    """The feed as a stream; one file makes one micro-batch, so the result is the batch's."""
    folder = new_folder(spark, "stream")
    tables = Store(f"{folder}/store").create(spark)
    rows = _event_stream(spark, sf).drop("path")
    capture_stream(rows, tables, f"{folder}/checkpoint").awaitTermination()
    return _stored_sets(spark, tables)


@query(
    "stream_first_seen",
    """select source_db, path, text, count(distinct modified) as n from fx_feed group by 1, 2, 3""",
)
def stream_first_seen(spark, sf):
    """A stream in which every row comes twice, as from two overlapping polls."""
    folder = new_folder(spark, "stream")
    once = _event_stream(spark, sf)
    twice = once.union(_event_stream(spark, sf))
    seen = first_seen(twice, ["source_db", "path", "modified"], "1 hour")
    (
        seen.writeStream.format("parquet")
        .option("path", f"{folder}/rows")
        .option("checkpointLocation", f"{folder}/checkpoint")
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
    rows = spark.read.schema(seen.schema).parquet(f"{folder}/rows")
    return rows.groupBy("source_db", "path", "text").agg(F.count(F.lit(1)).alias("n"))
