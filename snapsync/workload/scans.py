"""Catalogue scans, tree listings, sinks as row sets."""

from pyspark.sql import functions as F

from snapsync.functions.names import METHOD_PARTS, object_path
from snapsync.functions.text import line_slice, normalized_text, text_sha
from snapsync.functions.times import parse_marker
from snapsync.operators import assembly, diff, predicates
from snapsync.operators.ordering import latest_row
from snapsync.operators.sizing import new_folder, written
from snapsync.plans import pull
from snapsync.plans.publish import Ledger, ParquetSink
from snapsync.sources import catalog, splits, tree
from snapsync.sources.database import bound_query
from snapsync.sources.splits import plan_splits
from snapsync.sources.watch import listed_changes
from snapsync.workload import fixtures as fx
from snapsync.workload.registry import SQL, query

CATALOG3 = """
    select source_db, class_id, short_name, modified, 'METHOD' as type from fx_methods
    union all
    select source_db, class_id, short_name, modified, 'VIEW' from fx_criteria
    union all
    select u.source_db, substr(t.table_name, 3), u.object_name,
           coalesce(try_strptime(u.timestamp, '%Y-%m-%d:%H:%M:%S'),
                    try_strptime(u.timestamp, '%Y-%m-%d %H:%M:%S')), u.object_type
    from fx_user_objects u
    left join fx_triggers t on u.source_db = t.source_db and u.object_name = t.trigger_name
    where u.object_type = 'TRIGGER'"""
CATALOG4 = CATALOG3 + f"""
    union all
    select source_db, 'PACKAGES', object_name, last_ddl_time, 'PACKAGE'
    from fx_all_objects where upper(object_type) = 'PACKAGE' and object_name = '{fx.PACKAGE}'"""


@query(
    "bind_lookup",
    """select class_id, short_name, coalesce(order_by, '') as order_by,
              coalesce(group_by, '') as group_by
       from fx_criteria where class_id = 'src7' or order_by = 'de'""",
)
def bind_lookup(spark, sf):
    fx.criteria(spark, sf).createOrReplaceTempView("criteria")
    return bound_query(
        spark,
        """select class_id, short_name, order_by, group_by from criteria
           where class_id = :class_id or order_by = :lang""",
        class_id="src7",
        lang="de",
    )


@query("catalog_objects3", CATALOG3)
def catalog_objects3(spark, sf):
    return catalog.catalog_objects(fx.tables(spark, sf))


@query("catalog_objects4", CATALOG4)
def catalog_objects4(spark, sf):
    return catalog.catalog_objects(fx.tables(spark, sf), fx.PACKAGE)


@query(
    "tree_objects_a",
    """select distinct source_db, folder as class_id, split_part(file, '.', 1) as short_name,
              case when len(string_split(file, '.')) <= 2 then 'VIEW'
                   when lower(string_split(file, '.')[-2]) in
                        ('body', 'validate', 'script', 'globals', 'locals') then 'METHOD'
                   when lower(string_split(file, '.')[-2]) in ('package', 'package body')
                        then 'PACKAGE'
                   when lower(string_split(file, '.')[-2]) = 'trg' then 'TRIGGER' end as type
       from fx_files where folder not in ('.git', '.idea', '.sync', 'PLSQL', 'TESTS')""",
)
def tree_objects_a(spark, sf):
    return tree.objects_in_folder(fx.files(spark, sf))


@query("tree_files_b", "select source_db, folder, file, type from fx_wanted_files")
def tree_files_b(spark, sf):
    return tree.typed_files(fx.files(spark, sf)).select("source_db", "folder", "file", "type")


@query(
    "tree_schema",
    "select distinct source_db, type, folder as class_id, short_name from fx_wanted_files",
)
def tree_schema(spark, sf):
    return tree.tree_schema(fx.files(spark, sf))


@query(
    "tree_elements", "select source_db, type, folder as class_id, short_name from fx_wanted_files"
)
def tree_elements(spark, sf):
    return tree.tree_elements(fx.files(spark, sf))


FOLDER_SETS = """
    select source_db, class_id, part_no, string_agg(short_name, ', ' order by short_name) as names
    from (select *, (row_number() over (partition by source_db, class_id order by short_name) - 1)
                    // {per_row} as part_no
          from (select distinct source_db, folder as class_id, short_name from fx_wanted_files))
    group by 1, 2, 3"""


@query("folder_name_sets", FOLDER_SETS.format(per_row=100_000))
def folder_name_sets(spark, sf):
    names = tree.folder_name_sets(fx.files(spark, sf))
    return assembly.list_names(names, ["source_db", "class_id"], "short_name")


@query("folder_name_sets_ranges", FOLDER_SETS.format(per_row=100))
def folder_name_sets_ranges(spark, sf):
    names = tree.folder_name_sets(fx.files(spark, sf))
    return assembly.list_names(
        names, ["source_db", "class_id"], "short_name", per_row=100, how="ranges"
    )


METHOD_TEXTS = """
    select m.source_db, m.class_id, m.short_name, e.part,
           string_agg(coalesce(l.text, '') || chr(10), '' order by line, tie1, tie2, l.text nulls first)
               filter (l.id is not null) as text
    from {methods} m
    cross join (values ('EXECUTE', 'body'), ('VALIDATE', 'validate'), ('PUBLIC', 'globals'),
                       ('PRIVATE', 'locals'), ('VBSCRIPT', 'script')) e(type, part)
    left join fx_lines l on l.source_db = m.source_db and l.id = m.id and l.type = e.type
    group by all"""
_WIDE = "max(text) filter (part = 'body') as body, max(text) filter (part = 'validate') as validate, \
max(text) filter (part = 'globals') as globals, max(text) filter (part = 'locals') as locals, \
max(text) filter (part = 'script') as script"


@query(
    "parts_wide",
    f"""with parts as ({METHOD_TEXTS.format(methods='fx_methods')})
        select source_db, class_id, short_name, {_WIDE} from parts group by 1, 2, 3""",
)
def parts_wide(spark, sf):
    t = fx.tables(spark, sf)
    parts = catalog.with_method_texts(t, t.methods).select(
        "source_db",
        "class_id",
        "short_name",
        F.col("extention").alias("part"),
        F.nullif("text", F.lit("")).alias("text"),
    )
    return tree.parts_wide(parts, ("source_db", "class_id", "short_name"))


@query(
    "parts_one_method",
    f"""with one as (select * from fx_methods
             qualify row_number() over (partition by source_db order by modified desc, id) = 1),
        parts as ({METHOD_TEXTS.format(methods='one')})
        select source_db, class_id, short_name, {_WIDE} from parts where text <> ''
        group by 1, 2, 3""",
)
def parts_one_method(spark, sf):
    """The parts of one method of each source, the one changed last."""
    t = fx.tables(spark, sf)
    one = latest_row(t.methods, ["source_db"], [F.desc("modified"), "id"])
    parts = catalog.method_texts(t, one).where("text is not null")
    return tree.parts_wide(
        parts.withColumnRenamed("extention", "part"), ("source_db", "class_id", "short_name")
    )


@query(
    "view_text_by_key",
    """select source_db, class_id, short_name,
              coalesce(condition, '') || coalesce(order_by, '') || coalesce(group_by, '') as text
       from fx_criteria c where exists (
           select 1 from fx_wanted_files f where f.type = 'VIEW' and f.source_db = c.source_db
              and f.folder = c.class_id and f.short_name = c.short_name)""",
)
def view_text_by_key(spark, sf):
    keys = tree.tree_schema(fx.files(spark, sf)).where("type = 'VIEW'")
    return catalog.view_texts(fx.tables(spark, sf), keys)


@query(
    "trigger_text_by_key",
    """select source_db, substr(table_name, 3) as class_id, trigger_name as short_name,
              'CREATE OR REPLACE TRIGGER ' || description || coalesce(trigger_body, '') as text
       from fx_triggers t where exists (
           select 1 from fx_wanted_files f where f.type = 'TRIGGER' and f.source_db = t.source_db
              and f.folder = substr(t.table_name, 3) and f.short_name = t.trigger_name)""",
)
def trigger_text_by_key(spark, sf):
    keys = tree.tree_schema(fx.files(spark, sf)).where("type = 'TRIGGER'")
    return catalog.trigger_texts(fx.tables(spark, sf), keys)


@query(
    "source_lines",
    """select m.source_db, class_id, short_name, package_name, modified, user_modified, type, line,
              text
       from fx_lines l join fx_methods m on l.source_db = m.source_db and l.id = m.id
       order by class_id, short_name, type, line""",
)
def source_lines(spark, sf):
    return catalog.source_lines(fx.tables(spark, sf))


@query(
    "refresh_marker",
    """select source_db, case when source_db <> 'db3'
              then date_trunc('second', max(modified)) end as marker
       from fx_feed group by 1""",
)
def refresh_marker(spark, sf):
    """Marker text of each source, as a settings value; db3 has none."""
    value = F.date_format(F.max("modified"), "dd/MM/yyyy HH:mm:ss")
    settings = (
        fx.feed(spark, sf)
        .groupBy("source_db")
        .agg(value.alias("value"))
        .withColumn("value", F.when(F.col("source_db") != "db3", F.col("value")))
    )
    return settings.select("source_db", parse_marker(F.col("value")).alias("marker"))


@query(
    "line_slice",
    """select doc_id, coalesce(array_to_string(
              list_slice(string_split(text, chr(10)), 1, (doc_id % 5)::int), chr(10)), '') as text
       from documents""",
)
def lines_of_script(spark, sf):
    """Scripts made of the document texts: a head, a line with the count, the text's lines."""
    script = F.concat(
        F.lit("head\n"), (F.col("doc_id") % 5).cast("string"), F.lit("\n"), F.col("text")
    )
    return fx.documents(spark, sf).select("doc_id", line_slice(script).alias("text"))


@query(
    "snapshot_paths",
    """select source_db, class_id || '/' || short_name || '.trg.sql' as trg_path,
              class_id || '/' || short_name ||
                  case when coalesce(order_by, '') = '' then '' else '.' || order_by end || '.sql'
                  as path
       from fx_criteria""",
)
def snapshot_paths(spark, sf):
    name = [F.col("class_id"), F.col("short_name")]
    return fx.criteria(spark, sf).select(
        "source_db",
        object_path(*name, F.lit("trg")).alias("trg_path"),
        object_path(*name, F.col("order_by")).alias("path"),
    )


@query(
    "upsert_with_delete",
    """with new_rows as (
           select doc_id, source, case when source = 'src0' then '' when source <> 'src1' then text
                  end as text from documents)
       select doc_id, source, text from new_rows where text <> ''
       union all
       select doc_id, source, text from fx_snapshot s
       where not exists (select 1 from new_rows n where n.doc_id = s.doc_id)""",
)
def upsert_with_delete(spark, sf):
    text = F.when(F.col("source") == "src0", "").when(F.col("source") != "src1", F.col("text"))
    rows = fx.documents(spark, sf).withColumn("text", text)
    return diff.upsert_with_delete(fx.snapshot(spark, sf), rows, ["doc_id"])


@query(
    "normalized_text",
    r"""select doc_id, regexp_replace(replace(text, '. ', '. ' || chr(9) || chr(10)),
               '[ \t\r\f\x0B]*\n', chr(13) || chr(10), 'g') as text
        from documents""",
)
def normalized_texts(spark, sf):
    blanks = F.replace("text", F.lit(". "), F.lit(". \t\n"))
    return fx.documents(spark, sf).select("doc_id", normalized_text(blanks).alias("text"))


@query(
    "parts_long",
    f"""select source_db, class_id, short_name, part, text
        from ({METHOD_TEXTS.format(methods='fx_methods')}) where text <> ''""",
)
def parts_long(spark, sf):
    return tree.parts_long(parts_wide(spark, sf), ("source_db", "class_id", "short_name"))


@query(
    "snapshot_remove",
    """select s.doc_id, s.source, s.text from fx_snapshot s
       where not exists (select 1 from documents d where d.doc_id = s.doc_id
             and d.source = s.source and d.lang = 'fr')""",
)
def snapshot_remove(spark, sf):
    removed = fx.table(spark, sf, "documents").where("lang = 'fr'")
    return diff.remove_objects(fx.snapshot(spark, sf), removed, ["doc_id", "source"])


@query(
    "drop_unknown",
    """select source_db, type, folder as class_id, short_name, folder || '/' || file as path, text
       from fx_wanted_files where type <> 'UNKNOWN'""",
)
def drop_unknown(spark, sf):
    return diff.drop_unknown(pull.snapshot_of_files(fx.files(spark, sf)))


LISTED = """
    select distinct split_part(pair, '.', 1) as class_id, split_part(pair, '.', 2) as short_name
    from (select unnest(string_split(o_orderpriority || '.M' || o_custkey || ',' ||
                 o_orderpriority || '.M' || o_orderkey, ',')) as pair
          from orders)"""


def object_lists(spark, sf):
    """Texts CLASS.NAME,CLASS.NAME, one per order."""
    orders = fx.table(spark, sf, "orders")
    return orders.select(
        F.concat(
            "o_orderpriority",
            F.lit(".M"),
            "o_custkey",
            F.lit(","),
            "o_orderpriority",
            F.lit(".M"),
            "o_orderkey",
        ).alias("list")
    )


@query(
    "publish_rows",
    f"""with parts as (
            select f.source_db, f.folder as class_id, f.short_name,
                   regexp_extract(file, '\\.(body|validate|globals|locals|script)\\.sql$', 1) as part,
                   text
            from fx_wanted_files f join ({LISTED}) l
              on f.folder = l.class_id and f.short_name = l.short_name
            where f.type = 'METHOD')
        select source_db, upper(class_id) as class_id, upper(short_name) as short_name, {_WIDE}
        from parts group by 1, 2, 3""",
)
def publish_rows(spark, sf):
    files = pull.with_parts(pull.snapshot_of_files(fx.files(spark, sf)))
    return pull.publish_rows(files, object_lists(spark, sf), "list")


@query(
    "publish_twice",
    f"""with first as ({SQL["publish_rows"].replace("with parts as (", "select * from (with parts as (")}))
        select 1::bigint as publish_no, * from first
        union all
        select 2, source_db, class_id, short_name, {", ".join(
            "body || '!' as body" if part == "body" else part for part in METHOD_PARTS)}
        from first where class_id like '1%' and body is not null""",
)
def publish_twice(spark, sf):
    """What the staging table holds after three publishes: all rows, then all rows of which some bodies
    are others, then the same once more."""
    first = written(publish_rows(spark, sf), "rows")
    other = F.when(F.col("class_id").startswith("1"), F.concat("body", F.lit("!"))).otherwise(F.col("body"))
    second = first.withColumn("body", other)
    folder = new_folder(spark, "publish")
    ledger = Ledger(f"{folder}/ledger", first.schema)
    sink = ParquetSink(f"{folder}/staging", ledger.schema)
    for rows in (first, second, second):
        ledger.publish(rows, sink)
    return sink.rows(spark).drop("publish_id", "row_sha")


@query(
    "select_by_list",
    f"""select c.* from ({CATALOG3}) c
        where exists (select 1 from ({LISTED}) l
                      where l.class_id = c.class_id and l.short_name = c.short_name)""",
)
def select_by_list(spark, sf):
    objects = catalog.catalog_objects(fx.tables(spark, sf))
    return predicates.by_list(objects, object_lists(spark, sf), "list")


@query(
    "parse_object_list",
    """select split_part(pair, '.', 1) as class_id, split_part(pair, '.', 2) as short_name
       from (select unnest(string_split(o_orderpriority || '.M' || o_custkey || ',' ||
                    o_orderpriority || '.M' || o_orderkey, ',')) as pair
             from orders)""",
)
def parse_object_list(spark, sf):
    return predicates.parse_object_list(object_lists(spark, sf), "list")


# Times and sizes of the files, as of two looks: what the second one misses, has anew, or has with a later time.
_LOOKS = """files as (
        select source_db, folder, file, timestamp '2024-01-01' as modified, length(text)::bigint as size,
               sha256(text) as text_sha from fx_files),
    known as (select * from files where size % 11 <> 0 or size is null),
    listed as (select source_db, folder, file, case when size % 5 = 0 then modified + to_days(1)
                      else modified end as modified, size from files where size % 7 <> 0 or size is null)"""


@query(
    "tree_changes",
    f"""with {_LOOKS}
        select coalesce(n.source_db, o.source_db) as source_db, coalesce(n.folder, o.folder) as folder,
               coalesce(n.file, o.file) as file, n.modified, n.size, o.text_sha as known_sha,
               case when o.file is null then 'added' when n.file is null then 'deleted'
               else 'changed' end as change
        from listed n full join known o
          on n.source_db = o.source_db and n.folder = o.folder and n.file = o.file
        where o.file is null or n.file is null or n.modified <> o.modified
           or n.size is distinct from o.size""",
)
def tree_changes(spark, sf):
    size = F.col("size")
    files = fx.files(spark, sf).select(
        "source_db",
        "folder",
        "file",
        F.lit("2024-01-01").cast("timestamp_ntz").alias("modified"),
        F.length("text").cast("long").alias("size"),
        text_sha(F.col("text")).alias("text_sha"),
    )
    later = F.col("modified") + F.make_dt_interval(days=F.when(size % 5 == 0, 1).otherwise(0))
    listed = files.where((size % 7 != 0) | size.isNull()).withColumn("modified", later)
    known = files.where((size % 11 != 0) | size.isNull())
    return listed_changes(known, listed, ("source_db", "folder", "file"))


@query(
    "scan_in_splits",
    """select l_returnflag, l_suppkey, count(*) as n, sum(l_orderkey)::bigint as orders,
              min(l_shipdate) as first_shipped
       from lineitem group by all""",
)
def scan_in_splits(spark, sf):
    """Line items read in splits that a sketch of their keys gives, each row once."""
    items = fx.table(spark, sf, "lineitem")
    planned = plan_splits(items.select("l_suppkey", "l_orderkey"), "l_suppkey", 8, "l_orderkey")
    return (
        splits.scan_in_splits(items, planned)
        .groupBy("l_returnflag", "l_suppkey")
        .agg(
            F.count("*").alias("n"),
            F.sum("l_orderkey").alias("orders"),
            F.min("l_shipdate").alias("first_shipped"),
        )
    )
