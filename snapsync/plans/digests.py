"""Digest trees of catalogues and snapshots, and the full pull that reads only what they tell apart.

A row's digest is 64 bits of a hash of its values, as two numbers; the digest of an object, a class or a
source is the number of its rows and the sums of theirs. Sums don't depend on the order of rows, add up
from level to level and over parts, and can be taken inside a database as well.
"""

from dataclasses import replace

from pyspark.sql import Column, DataFrame, functions as F

from snapsync.functions.names import class_after_prefix
from snapsync.functions.text import text_sha
from snapsync.operators.joins import join_null_safe
from snapsync.operators.sizing import written
from snapsync.plans.pull import SNAPSHOT, pull_all
from snapsync.sources.catalog import Tables, catalog_objects

LEVELS = {
    "source": ["source_db"],
    "class": ["source_db", "class_id"],
    "object": ["source_db", "class_id", "type", "short_name"],
}
KEY = LEVELS["object"]
DIGEST = ["n", "low", "high"]
CLASS = LEVELS["class"]
# Classes named in the filters of scans; more are only joined.
NAMED_CLASSES = 1000


def row_digest(*columns) -> tuple[Column, Column]:
    """Two numbers of 32 bits from a row's values; null differs from every value."""
    marked = [F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("")) for c in columns]
    code = F.md5(F.concat_ws("\x1f", *marked))
    return tuple(
        F.conv(F.substring(code, place, 8), 16, 10).cast("bigint") for place in (1, 9)
    )


def digest_tree(rows: DataFrame, *values, lowest: str = "object") -> DataFrame:
    """(level, source_db, class_id, type, short_name, n, low, high): digests of the rows' values for each
    object, class and source, or down to another level. Keys below a level are null. Rows are summed up
    for all levels before they are moved, and moved once."""
    low, high = row_digest(*KEY, *values)
    hashed = rows.select(*KEY, low.alias("low"), high.alias("high"))
    levels = list(LEVELS)[: list(LEVELS).index(lowest) + 1]
    sets = [[F.col(c) for c in LEVELS[name]] for name in levels]
    depth = F.grouping_id(*KEY)
    level = F.when(depth == 0, "object").when(depth == 3, "class").otherwise("source")
    return hashed.groupingSets(sets, *KEY).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("low").alias("low"),
        F.sum("high").alias("high"),
        level.alias("level"),
    ).select("level", *KEY, *DIGEST)


def differing(one: DataFrame, other: DataFrame, level: str = "class") -> DataFrame:
    """Keys of a level whose digests differ, or that one tree lacks. The trees are gone down from the
    sources: what lies below equal digests is neither moved nor compared."""
    found = None
    for name, keys in LEVELS.items():
        sides = [tree.where(F.col("level") == name).select(*keys, *DIGEST) for tree in (one, other)]
        if found is not None:
            above = [c for c in found.columns]
            sides = [join_null_safe(side, found, above, "left_semi") for side in sides]
        sums = F.struct(*DIGEST)
        both = sides[0].select(*keys, sums.alias("_one"), F.lit(None).cast(sums_type()).alias("_two"))
        both = both.unionByName(
            sides[1].select(*keys, F.lit(None).cast(sums_type()).alias("_one"), sums.alias("_two"))
        )
        merged = both.groupBy(*keys).agg(
            F.any_value("_one", True).alias("_one"), F.any_value("_two", True).alias("_two")
        )
        found = merged.where(~F.col("_one").eqNullSafe(F.col("_two"))).select(*keys)
        if name == level:
            return found
    raise ValueError(f"unknown level: {level}")


def sums_type() -> str:
    return "struct<n:bigint,low:bigint,high:bigint>"


def pull_digests(
    t: Tables, snapshot: DataFrame, package_name: str | None = None, lowest: str = "object"
) -> DataFrame:
    """Digest trees to keep after a full pull: `side` is `catalog` (names and times of the source's
    objects) or `files` (paths and text hashes of the snapshot). No text of the source is read."""
    files = snapshot
    if "text_sha" not in snapshot.columns:
        files = snapshot.withColumn("text_sha", text_sha(F.col("text")))
    catalog = digest_tree(catalog_objects(t, package_name), "modified", lowest=lowest)
    tree = digest_tree(files, "path", "text_sha", lowest=lowest)
    return catalog.withColumn("side", F.lit("catalog")).unionByName(
        tree.withColumn("side", F.lit("files"))
    )


def changed_classes(now: DataFrame, kept: DataFrame) -> DataFrame:
    """(source_db, class_id) whose catalogue or files differ from those of the kept digests."""
    found = [
        differing(*[trees.where(F.col("side") == side) for trees in (now, kept)])
        for side in ("catalog", "files")
    ]
    return found[0].unionByName(found[1]).distinct()


def of_classes(t: Tables, classes: DataFrame) -> Tables:
    """The tables cut down to some classes, (source_db, class_id). Sources are named in the filters, so
    that a source without such a class is not read, and so are classes while they are few; lines are cut
    to the ids of the methods that are left."""
    few = classes.limit(NAMED_CLASSES + 1).collect()
    sources = classes.select("source_db").distinct().collect()  # one row per source

    def of_sources(df):
        return df.where(F.col("source_db").isin([r.source_db for r in sources]))

    def in_classes(df, class_id):
        near = of_sources(df)
        if len(few) <= NAMED_CLASSES and all(r.class_id is not None for r in few):
            near = near.where(class_id.isin(sorted({r.class_id for r in few})))
        keyed = near.withColumn("_class", class_id)
        chosen = classes.withColumnRenamed("class_id", "_class")
        return join_null_safe(keyed, chosen, ["source_db", "_class"], "left_semi").drop("_class")

    if any(r.source_db is None for r in sources):
        return t
    methods = in_classes(t.methods, F.col("class_id"))
    ids = methods.agg(F.min("id").alias("low"), F.max("id").alias("high"))
    low, high = (ids.select(c).scalar() for c in ("low", "high"))
    return replace(
        t,
        methods=methods,
        lines=of_sources(t.lines).where((F.col("id") >= low) & (F.col("id") <= high)),
        criteria=in_classes(t.criteria, F.col("class_id")),
        triggers=in_classes(t.triggers, class_after_prefix(F.col("table_name"))),
        user_objects=of_sources(t.user_objects),
        all_objects=None if t.all_objects is None else of_sources(t.all_objects),
    )


def pull_changed_classes(
    t: Tables, snapshot: DataFrame, kept: DataFrame, package_name: str | None = None
) -> DataFrame:
    """`pull_all`, of the classes alone whose objects or files are not as they were after the last pull;
    `kept` are its `pull_digests`. The files of the other classes stay and their texts are not read.

    That an object changed is told by its time, as everywhere: a source that changes texts without it
    needs `pull_all`. Without kept digests (an empty table) every class is pulled.
    """
    files = snapshot.select(*SNAPSHOT)
    # Compared level by level: written, so that rows are hashed once, and without objects.
    now = written(pull_digests(t, snapshot, package_name, lowest="class"), "digests")
    changed = written(changed_classes(now, kept), "classes")
    stay = join_null_safe(files, changed, CLASS, "left_anti")
    give_way = join_null_safe(files, changed, CLASS, "left_semi")
    return pull_all(of_classes(t, changed), give_way, package_name).unionByName(stay)
