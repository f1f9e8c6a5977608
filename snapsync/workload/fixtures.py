"""The engine's input tables, bound to the given tables in Spark and in SQL."""

from pyspark.sql import functions as F

from snapsync.functions.names import object_path
from snapsync.functions.text import text_sha
from snapsync.sources.catalog import Tables
from snapsync.workload.registry import FIXTURE_SQL

# Order dates end in August 2001; moved so that they end beside the events of January 2024.
SHIFT_DAYS = 8215
WINDOW_DAYS = 10
PACKAGE = "small ring"
PART_TYPE_OF_FLAG = {"A": "EXECUTE", "N": "PUBLIC", "R": "PRIVATE"}
FILE_SUFFIXES = (
    ".body.sql .validate.sql .globals.sql .locals.sql .script.sql .sql .trg.sql .bdy .spc .txt"
).split()


_SCHEMAS = {}


def table(spark, sf, name):
    """A given table; its schema is read from the file once per process."""
    path = f"{sf}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def _db(key):
    return F.concat(F.lit("db"), (F.col(key) % 4).cast("string"))


def _minutes(n):
    return F.make_dt_interval(mins=n.cast("int"))


def _at(text):
    return F.lit(text).cast("timestamp_ntz")


FIXTURE_SQL["fx_methods"] = f"""
    select 'db' || (o_orderkey % 4) as source_db, o_orderkey as id, o_orderpriority as class_id,
           'M' || o_orderkey as short_name, o_orderdate + to_days({SHIFT_DAYS}) as modified,
           c_name as user_modified, c_mktsegment as package_name
    from orders join customer on o_custkey = c_custkey"""


def methods(spark, sf):
    customer = table(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment")
    joined = table(spark, sf, "orders").join(customer, F.col("o_custkey") == F.col("c_custkey"))
    return joined.select(
        _db("o_orderkey").alias("source_db"),
        F.col("o_orderkey").alias("id"),
        F.col("o_orderpriority").alias("class_id"),
        F.concat(F.lit("M"), "o_orderkey").alias("short_name"),
        (F.col("o_orderdate") + F.make_dt_interval(days=F.lit(SHIFT_DAYS))).alias("modified"),
        F.col("c_name").alias("user_modified"),
        F.col("c_mktsegment").alias("package_name"),
    )


FIXTURE_SQL["fx_lines"] = """
    select 'db' || (l_orderkey % 4) as source_db, l_orderkey as id,
           case l_returnflag when 'A' then 'EXECUTE' when 'N' then 'PUBLIC' when 'R' then 'PRIVATE'
           end as type,
           l_linenumber as line, l_partkey as tie1, l_suppkey as tie2,
           case when l_quantity <> 1 then l_linestatus || ':' || l_partkey end as text
    from lineitem"""


def lines(spark, sf):
    kind = F.lit(None).cast("string")
    for flag, name in PART_TYPE_OF_FLAG.items():
        kind = F.when(F.col("l_returnflag") == flag, name).otherwise(kind)
    return table(spark, sf, "lineitem").select(
        _db("l_orderkey").alias("source_db"),
        F.col("l_orderkey").alias("id"),
        kind.alias("type"),
        F.col("l_linenumber").alias("line"),
        F.col("l_partkey").alias("tie1"),
        F.col("l_suppkey").alias("tie2"),
        F.when(F.col("l_quantity") != 1, F.concat_ws(":", "l_linestatus", "l_partkey")).alias(
            "text"
        ),
    )


FIXTURE_SQL["fx_method_diary"] = f"""
    select 'db' || (l_orderkey % 4) as source_db, l_orderkey as id,
           l_shipdate + to_days({SHIFT_DAYS}) as time
    from lineitem"""


def method_diary(spark, sf):
    return table(spark, sf, "lineitem").select(
        _db("l_orderkey").alias("source_db"),
        F.col("l_orderkey").alias("id"),
        (F.col("l_shipdate") + F.make_dt_interval(days=F.lit(SHIFT_DAYS))).alias("time"),
    )


FIXTURE_SQL["fx_criteria"] = """
    select 'db' || (doc_id % 4) as source_db, doc_id as id, source as class_id,
           'V' || doc_id as short_name,
           timestamp '2023-12-10' + to_minutes((doc_id * 7919) % 72000) as modified,
           text as condition, case when doc_id % 3 <> 0 then lang end as order_by,
           case when doc_id % 2 <> 0 then n_chars::varchar end as group_by
    from documents"""


def criteria(spark, sf):
    return table(spark, sf, "documents").select(
        _db("doc_id").alias("source_db"),
        F.col("doc_id").alias("id"),
        F.col("source").alias("class_id"),
        F.concat(F.lit("V"), "doc_id").alias("short_name"),
        (_at("2023-12-10") + _minutes(F.col("doc_id") * 7919 % 72000)).alias("modified"),
        F.col("text").alias("condition"),
        F.when(F.col("doc_id") % 3 != 0, F.col("lang")).alias("order_by"),
        F.when(F.col("doc_id") % 2 != 0, F.col("n_chars").cast("string")).alias("group_by"),
    )


FIXTURE_SQL["fx_criteria_diary"] = """
    select 'db' || (user_id % 4) as source_db, user_id as id, ts as time, event_id as seq,
           case event_type when 'signup' then 'INSERTED' when 'purchase' then 'UPDATED'
           else upper(event_type) end as action,
           'DOM.User' || (event_id % 25) as user_id
    from events"""


def criteria_diary(spark, sf):
    kind = F.col("event_type")
    return table(spark, sf, "events").select(
        _db("user_id").alias("source_db"),
        F.col("user_id").alias("id"),
        F.col("ts").alias("time"),
        F.col("event_id").alias("seq"),
        F.when(kind == "signup", "INSERTED")
        .when(kind == "purchase", "UPDATED")
        .otherwise(F.upper(kind))
        .alias("action"),
        F.concat(F.lit("DOM.User"), F.col("event_id") % 25).alias("user_id"),
    )


FIXTURE_SQL["fx_triggers"] = """
    select 'db' || (c_custkey % 4) as source_db, 'T' || c_custkey as trigger_name,
           c_name as table_name, c_mktsegment || ' ' as description,
           case when c_nationkey <> 0 then c_name end as trigger_body
    from customer"""


def triggers(spark, sf):
    return table(spark, sf, "customer").select(
        _db("c_custkey").alias("source_db"),
        F.concat(F.lit("T"), "c_custkey").alias("trigger_name"),
        F.col("c_name").alias("table_name"),
        F.concat("c_mktsegment", F.lit(" ")).alias("description"),
        F.when(F.col("c_nationkey") != 0, F.col("c_name")).alias("trigger_body"),
    )


FIXTURE_SQL["fx_user_objects"] = """
    select 'db' || (c_custkey % 4) as source_db, 'T' || c_custkey as object_name,
           'TRIGGER' as object_type,
           '2024-01-' || lpad((1 + c_custkey % 28)::varchar, 2, '0') || ':10:00:00' as timestamp
    from customer
    union all
    select 'db' || (s_suppkey % 4), 'TS' || s_suppkey, 'TRIGGER',
           '2024-01-' || lpad((1 + s_suppkey % 28)::varchar, 2, '0') || ' 11:30:00'
    from supplier
    union all
    select 'db' || (p_partkey % 4), 'P' || p_partkey, 'PROCEDURE', 'no time'
    from part"""


def user_objects(spark, sf):
    def objects(name, key, prefix, kind, time):
        return table(spark, sf, name).select(
            _db(key).alias("source_db"),
            F.concat(F.lit(prefix), key).alias("object_name"),
            F.lit(kind).alias("object_type"),
            time.alias("timestamp"),
        )

    def day(key):
        return F.lpad((F.col(key) % 28 + 1).cast("string"), 2, "0")

    colon = F.concat(F.lit("2024-01-"), day("c_custkey"), F.lit(":10:00:00"))
    space = F.concat(F.lit("2024-01-"), day("s_suppkey"), F.lit(" 11:30:00"))
    return (
        objects("customer", "c_custkey", "T", "TRIGGER", colon)
        .unionByName(objects("supplier", "s_suppkey", "TS", "TRIGGER", space))
        .unionByName(objects("part", "p_partkey", "P", "PROCEDURE", F.lit("no time")))
    )


FIXTURE_SQL["fx_all_objects"] = """
    select 'db' || (p_partkey % 4) as source_db, p_name as object_name,
           case when p_size > 25 then 'Package' else 'TABLE' end as object_type,
           timestamp '2024-01-01' + to_minutes(p_partkey % 43200) as last_ddl_time
    from part"""


def all_objects(spark, sf):
    return table(spark, sf, "part").select(
        _db("p_partkey").alias("source_db"),
        F.col("p_name").alias("object_name"),
        F.when(F.col("p_size") > 25, "Package").otherwise("TABLE").alias("object_type"),
        (_at("2024-01-01") + _minutes(F.col("p_partkey") % 43200)).alias("last_ddl_time"),
    )


def tables(spark, sf):
    return Tables(
        methods=methods(spark, sf),
        lines=lines(spark, sf),
        method_diary=method_diary(spark, sf),
        criteria=criteria(spark, sf),
        criteria_diary=criteria_diary(spark, sf),
        triggers=triggers(spark, sf),
        user_objects=user_objects(spark, sf),
        all_objects=all_objects(spark, sf),
        line_ties=("tie1", "tie2"),
    )


FIXTURE_SQL["fx_now"] = """
    select 'db' || (user_id % 4) as source_db, max(ts) as as_of,
           max(ts) + to_days(2) as local_time
    from events group by 1"""


def now(spark, sf):
    return (
        table(spark, sf, "events")
        .groupBy(_db("user_id").alias("source_db"))
        .agg(F.max("ts").alias("as_of"))
        .withColumn("local_time", F.col("as_of") + F.make_dt_interval(days=F.lit(2)))
    )


FIXTURE_SQL["fx_bounds"] = f"""
    select source_db, as_of - to_days({WINDOW_DAYS}) as last, as_of from fx_now"""


def bounds(spark, sf):
    return now(spark, sf).select(
        "source_db",
        (F.col("as_of") - F.make_dt_interval(days=F.lit(WINDOW_DAYS))).alias("last"),
        "as_of",
    )


FIXTURE_SQL["fx_allow"] = """
    select lower(c_name) as user_name from customer where c_nationkey < 15
    union all select 'USER' || n_nationkey from nation where n_regionkey < 3"""


def allow(spark, sf):
    customers = table(spark, sf, "customer").where("c_nationkey < 15")
    nations = table(spark, sf, "nation").where("n_regionkey < 3")
    return customers.select(F.lower("c_name").alias("user_name")).unionByName(
        nations.select(F.concat(F.lit("USER"), "n_nationkey").alias("user_name"))
    )


_SUFFIX_LIST = ", ".join(f"'{s}'" for s in FILE_SUFFIXES)
FIXTURE_SQL["fx_files"] = f"""
    select 'db' || ((o_orderkey // 3) % 4) as source_db,
           case when o_orderstatus = 'P' and o_orderpriority = '5-LOW' then 'TESTS'
           else o_orderpriority end as folder,
           'M' || (o_orderkey // 3) || ([{_SUFFIX_LIST}])[1 + o_orderkey % 10] as file,
           o_orderstatus || ' ' || o_custkey as text
    from orders
    union all
    select 'db' || (doc_id % 4), source, 'V' || doc_id || '.sql', text
    from documents where lang = 'en'
    union all
    select 'db' || (c_custkey % 4), case c_mktsegment when 'BUILDING' then substr(c_name, 3)
               else substr(c_name, instr(c_name, '#') + 1) end,
           'T' || c_custkey || '.trg.sql', c_name
    from customer where c_mktsegment in ('BUILDING', 'MACHINERY')"""


def files(spark, sf):
    suffixes = F.array(*[F.lit(s) for s in FILE_SUFFIXES])
    third = F.expr("o_orderkey div 3")
    low = (F.col("o_orderstatus") == "P") & (F.col("o_orderpriority") == "5-LOW")
    of_orders = table(spark, sf, "orders").select(
        F.concat(F.lit("db"), (third % 4).cast("string")).alias("source_db"),
        F.when(low, "TESTS").otherwise(F.col("o_orderpriority")).alias("folder"),
        F.concat(
            F.lit("M"), third.cast("string"), F.get(suffixes, (F.col("o_orderkey") % 10).cast("int"))
        ).alias("file"),
        F.concat_ws(" ", "o_orderstatus", "o_custkey").alias("text"),
    )
    of_documents = (
        table(spark, sf, "documents")
        .where("lang = 'en'")
        .select(
            _db("doc_id").alias("source_db"),
            F.col("source").alias("folder"),
            F.concat(F.lit("V"), "doc_id", F.lit(".sql")).alias("file"),
            "text",
        )
    )
    of_customers = (
        table(spark, sf, "customer")
        .where("c_mktsegment in ('BUILDING', 'MACHINERY')")
        .select(
            _db("c_custkey").alias("source_db"),
            F.when(F.col("c_mktsegment") == "BUILDING", F.substr("c_name", F.lit(3)))
            .otherwise(F.substring_index("c_name", "#", -1))
            .alias("folder"),
            F.concat(F.lit("T"), "c_custkey", F.lit(".trg.sql")).alias("file"),
            F.col("c_name").alias("text"),
        )
    )
    return of_orders.unionByName(of_documents).unionByName(of_customers)


FIXTURE_SQL["fx_wanted_files"] = """
    select *, split_part(file, '.', 1) as short_name,
           case when regexp_extract(file, '^\\.*[^.]*(\\..*)$', 1) in ('.bdy', '.spc') then 'PACKAGE'
                when regexp_extract(file, '^\\.*[^.]*(\\..*)$', 1) = '.sql' then 'VIEW'
                when regexp_extract(file, '^\\.*[^.]*(\\..*)$', 1) = '.trg.sql' then 'TRIGGER'
                when regexp_extract(file, '^\\.*[^.]*(\\..*)$', 1) in ('.body.sql', '.validate.sql',
                     '.globals.sql', '.locals.sql', '.script.sql') then 'METHOD'
                else 'UNKNOWN' end as type
    from fx_files where folder not in ('.git', '.idea', '.sync', 'PLSQL', 'TESTS')"""

FIXTURE_SQL["fx_snapshot"] = """
    select doc_id, source, case when lang = 'fr' then text || ' *' else text end as text
    from documents where lang <> 'de'
    union all
    select 1000000000 + page_id, 'page', html from pages"""


def snapshot(spark, sf):
    """Documents with all kinds of difference: those in German are new, those in French changed,
    the pages are no longer in the source."""
    text = F.when(F.col("lang") == "fr", F.concat("text", F.lit(" *"))).otherwise(F.col("text"))
    documents = table(spark, sf, "documents").where("lang <> 'de'")
    pages = table(spark, sf, "pages").select(
        (F.col("page_id") + 1000000000).alias("doc_id"),
        F.lit("page").alias("source"),
        F.col("html").alias("text"),
    )
    return documents.select("doc_id", "source", text.alias("text")).unionByName(pages)


def documents(spark, sf):
    return table(spark, sf, "documents").select("doc_id", "source", "text")


FIXTURE_SQL["fx_feed"] = """
    select 'db' || (user_id % 4) as source_db, 'VIEW' as type, 'C' || (user_id % 7) as class_id,
           'N' || user_id as short_name, ts as modified, nullif(event_type, 'error') as user_modified,
           null::varchar as extention, event_type as text,
           'C' || (user_id % 7) || '/N' || user_id || '.sql' as path
    from events"""


def feed(spark, sf):
    return feed_of(table(spark, sf, "events"))


def feed_of(events):
    rows = events.select(
        _db("user_id").alias("source_db"),
        F.lit("VIEW").alias("type"),
        F.concat(F.lit("C"), F.col("user_id") % 7).alias("class_id"),
        F.concat(F.lit("N"), "user_id").alias("short_name"),
        F.col("ts").alias("modified"),
        F.nullif("event_type", F.lit("error")).alias("user_modified"),
        F.lit(None).cast("string").alias("extention"),
        F.col("event_type").alias("text"),
    )
    path = object_path(F.col("class_id"), F.col("short_name"), F.col("extention"))
    return rows.withColumn("path", path)


FIXTURE_SQL["fx_baseline"] = """
    select source_db, path, arg_max(text, modified) as text,
           sha256(arg_max(text, modified)) as text_sha
    from fx_feed where modified < timestamp '2024-01-20' group by 1, 2"""


def baseline(spark, sf):
    old = feed(spark, sf).where(F.col("modified") < _at("2024-01-20"))
    last = old.groupBy("source_db", "path").agg(F.max_by("text", "modified").alias("text"))
    return last.withColumn("text_sha", text_sha(F.col("text")))


FIXTURE_SQL["fx_recent_feed"] = """
    select * from fx_feed where modified >= timestamp '2024-01-20'"""


def recent_feed(spark, sf):
    return feed(spark, sf).where(F.col("modified") >= _at("2024-01-20"))


FIXTURE_SQL["fx_control"] = """
    select source_db, case when source_db <> 'db2' then source_db || '_2024.01.02_03.04' end as epoch,
           max(modified) as high_water
    from fx_feed where modified < timestamp '2024-01-20' and source_db <> 'db3' group by 1"""


def control(spark, sf):
    """db3 was never visited, db2 has a mark but no epoch."""
    old = feed(spark, sf).where(
        (F.col("modified") < _at("2024-01-20")) & (F.col("source_db") != "db3")
    )
    epoch = F.when(
        F.col("source_db") != "db2", F.concat("source_db", F.lit("_2024.01.02_03.04"))
    )
    return old.groupBy("source_db").agg(F.max("modified").alias("high_water")).select(
        "source_db", epoch.alias("epoch"), "high_water"
    )


FIXTURE_SQL["fx_versions"] = """
    select source_db, path, modified, text, day(modified)::bigint as poll_no,
           case when day(modified) < 10 then 'master' when day(modified) < 20 then 'old'
           else source_db || '_2024.01.02_03.04' end as epoch,
           text = 'view' as removed
    from fx_feed"""


def versions(spark, sf):
    day = F.dayofmonth("modified")
    epoch = (
        F.when(day < 10, "master")
        .when(day < 20, "old")
        .otherwise(F.concat("source_db", F.lit("_2024.01.02_03.04")))
    )
    return feed(spark, sf).select(
        "source_db",
        "path",
        "modified",
        "text",
        day.cast("bigint").alias("poll_no"),
        epoch.alias("epoch"),
        (F.col("text") == "view").alias("removed"),
    )
