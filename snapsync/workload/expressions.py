"""Column expressions over whole tables."""

from pyspark.sql import functions as F

from snapsync.functions import names, text, times
from snapsync.settings import Settings
from snapsync.sources.tree import tree_elements
from snapsync.workload import fixtures as fx
from snapsync.workload.registry import query


@query(
    "view_text",
    """select id, coalesce(condition, '') || coalesce(order_by, '') || coalesce(group_by, '')
              as text from fx_criteria""",
)
def view_text(spark, sf):
    columns = [F.col(c) for c in ("condition", "order_by", "group_by")]
    return fx.criteria(spark, sf).select("id", text.view_text(*columns).alias("text"))


@query(
    "trigger_text",
    """select trigger_name, 'CREATE OR REPLACE TRIGGER ' || coalesce(description, '') ||
              coalesce(trigger_body, '') as text from fx_triggers""",
)
def trigger_text(spark, sf):
    body = text.trigger_text(F.col("description"), F.col("trigger_body"))
    return fx.triggers(spark, sf).select("trigger_name", body.alias("text"))


@query(
    "strip_domain",
    """select event_id, regexp_replace(user_id, '.*\\.(.*)', '\\1') as user_id from (
           select event_id, case when event_type = 'view' then 'A.' else '' end ||
                  case when event_type <> 'click' then 'DOM.' else '' end || 'User' || user_id
                  as user_id from events)""",
)
def strip_domain(spark, sf):
    kind = F.col("event_type")
    user = F.concat(
        F.when(kind == "view", "A.").otherwise(""),
        F.when(kind != "click", "DOM.").otherwise(""),
        F.lit("User"),
        F.col("user_id"),
    )
    return fx.table(spark, sf, "events").select(
        "event_id", text.strip_domain(user).alias("user_id")
    )


@query(
    "class_from_table",
    """select table_name, substr(table_name, 3) as after_prefix,
              substr(table_name, instr(table_name, '#') + 1) as after_hash,
              string_split(table_name, '#')[2] as between_hashes
       from (select case when c_nationkey = 1 then replace(c_name, '#', '')
                         when c_nationkey = 2 then c_name || '#' || c_mktsegment
                         else c_name end as table_name from customer)""",
)
def class_from_table(spark, sf):
    name = (
        F.when(F.col("c_nationkey") == 1, F.replace("c_name", F.lit("#"), F.lit("")))
        .when(F.col("c_nationkey") == 2, F.concat_ws("#", "c_name", "c_mktsegment"))
        .otherwise(F.col("c_name"))
    )
    named = fx.table(spark, sf, "customer").select(name.alias("table_name"))
    c = F.col("table_name")
    return named.select(
        c,
        names.class_after_prefix(c).alias("after_prefix"),
        names.class_after_hash(c).alias("after_hash"),
        names.class_between_hashes(c).alias("between_hashes"),
    )


@query(
    "parse_object_time",
    """select source_db, object_name, coalesce(try_strptime(timestamp, '%Y-%m-%d:%H:%M:%S'),
              try_strptime(timestamp, '%Y-%m-%d %H:%M:%S')) as modified
       from fx_user_objects""",
)
def parse_object_time(spark, sf):
    return fx.user_objects(spark, sf).select(
        "source_db", "object_name", times.parse_object_time(F.col("timestamp")).alias("modified")
    )


_FILE_NAMES = """
    select file from fx_files
    union all select p_name || '.Body.sql' from part
    union all select p_name || '.package body.sql' from part
    union all select p_name || '.x.sql' from part
    union all select p_name || '.' from part
    union all select p_brand from part"""


def _file_names(spark, sf):
    part = fx.table(spark, sf, "part")
    found = fx.files(spark, sf).select("file")
    for suffix in (".Body.sql", ".package body.sql", ".x.sql", "."):
        found = found.union(part.select(F.concat("p_name", F.lit(suffix))))
    return found.union(part.select("p_brand"))


@query(
    "classify_a",
    f"""select file, case when len(string_split(file, '.')) <= 2 then 'VIEW'
               when lower(string_split(file, '.')[-2]) in
                    ('body', 'validate', 'script', 'globals', 'locals') then 'METHOD'
               when lower(string_split(file, '.')[-2]) in ('package', 'package body') then 'PACKAGE'
               when lower(string_split(file, '.')[-2]) = 'trg' then 'TRIGGER' end as type
        from ({_FILE_NAMES})""",
)
def classify_a(spark, sf):
    return _file_names(spark, sf).select(
        "file", names.kind_by_pieces(F.col("file")).alias("type")
    )


@query(
    "classify_b",
    f"""select file, case when suffix in ('.bdy', '.spc') then 'PACKAGE'
               when suffix = '.sql' then 'VIEW' when suffix = '.trg.sql' then 'TRIGGER'
               when suffix in ('.body.sql', '.validate.sql', '.globals.sql', '.locals.sql',
                               '.script.sql') then 'METHOD' else 'UNKNOWN' end as type
        from (select file, case when file like '%.' then ''
                     else regexp_extract(file, '^\\.*[^.]*(\\..*)$', 1) end as suffix
              from ({_FILE_NAMES}))""",
)
def classify_b(spark, sf):
    return _file_names(spark, sf).select(
        "file", names.kind_by_suffix(F.col("file")).alias("type")
    )


@query(
    "author_time",
    """select seq, strftime(modified - to_hours(3) + to_days((seq % 5)::int),
              '%d.%m.%YT%H:%M:%S') as author_time
       from (select ts as modified, event_id as seq from events)""",
)
def author_time(spark, sf):
    """The clock shift differs per row here; in a poll it is one value per source."""
    shift = (F.col("event_id") % 5).cast("int")
    return fx.table(spark, sf, "events").select(
        F.col("event_id").alias("seq"),
        times.author_time(F.col("ts"), shift, Settings.author_hour_shift).alias("author_time"),
    )


@query(
    "clock_shift",
    """select event_id, datediff('day', ts, ts + to_hours((event_id % 100)::int))::int as days
       from events""",
)
def clock_shift(spark, sf):
    hours = F.make_dt_interval(hours=(F.col("event_id") % 100).cast("int"))
    return fx.table(spark, sf, "events").select(
        "event_id", times.clock_shift(F.col("ts") + hours, F.col("ts")).alias("days")
    )


@query(
    "epoch_name",
    """select event_id, source_db || '_' || strftime(ts, '%Y.%m.%d_%H.%M') as epoch,
              source_db || '_' || strftime(ts, '%d.%m.%Y_%H.%M') as day_first,
              source_db || '_' || strftime(ts, '%Y%m%d_%H%M') as compact
       from (select event_id, ts, 'db' || (user_id % 4) as source_db from events)""",
)
def epoch_name(spark, sf):
    db = F.concat(F.lit("db"), F.col("user_id") % 4)
    return fx.table(spark, sf, "events").select(
        "event_id",
        times.epoch_name(db, F.col("ts")).alias("epoch"),
        times.epoch_name(db, F.col("ts"), "day_first").alias("day_first"),
        times.epoch_name(db, F.col("ts"), "compact").alias("compact"),
    )


@query(
    "parse_duration",
    """select o_orderkey, epoch(case unit when 'd' then to_days(n) when 'h' then to_hours(n)
              when 'm' then to_minutes(n) when 's' then to_seconds(n) end)::bigint as seconds
       from (select o_orderkey, (o_custkey % 90)::int as n,
                    (['d', 'h', 'm', 's', 'x'])[1 + o_orderkey % 5] as unit from orders)""",
)
def parse_duration(spark, sf):
    units = F.array(*[F.lit(u) for u in "dhmsx"])
    spelled = F.concat(
        (F.col("o_custkey") % 90).cast("string"),
        F.get(units, (F.col("o_orderkey") % 5).cast("int")),
    )
    interval = times.parse_duration(spelled)
    origin = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    seconds = F.timestamp_diff("SECOND", origin, origin + interval)
    return fx.table(spark, sf, "orders").select("o_orderkey", seconds.alias("seconds"))


@query(
    "source_label",
    """select c_custkey, case when c_nationkey <> 3 then c_mktsegment end as source_db
       from customer""",
)
def source_label(spark, sf):
    """Connection texts made of customer columns; nation 3 gives one without a database."""
    connection = F.concat(
        "c_name", F.lit("/p@ss"), F.when(F.col("c_nationkey") != 3, "@").otherwise(""),
        F.when(F.col("c_nationkey") != 3, F.col("c_mktsegment")).otherwise(""),
    )
    shortened = F.when(
        F.col("c_nationkey") != 3, connection
    ).otherwise(F.replace(connection, F.lit("@"), F.lit("")))
    return fx.table(spark, sf, "customer").select(
        "c_custkey", names.source_label(shortened).alias("source_db")
    )


@query(
    "object_label",
    """select case type when 'METHOD' then 'Method' when 'VIEW' then 'View' when 'TRIGGER' then
              'Trigger' when 'PACKAGE' then 'Package' else 'Unknown' end || ' ::[' || folder ||
              '].[' || short_name || ']' as label
       from fx_wanted_files""",
)
def object_label(spark, sf):
    elements = tree_elements(fx.files(spark, sf))
    label = names.object_label(F.col("type"), F.col("class_id"), F.col("short_name"))
    return elements.select(label.alias("label"))


@query(
    "part_extension",
    """select id, line, type, case type when 'EXECUTE' then 'body' when 'VALIDATE' then 'validate'
              when 'VBSCRIPT' then 'script' when 'PUBLIC' then 'globals'
              when 'PRIVATE' then 'locals' end as extention
       from fx_lines""",
)
def part_extension(spark, sf):
    return fx.lines(spark, sf).select(
        "id", "line", "type", names.part_extension(F.col("type")).alias("extention")
    )
