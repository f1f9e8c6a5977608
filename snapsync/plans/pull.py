"""Pulls: bring a snapshot of file rows in step with the sources.

A snapshot has (source_db, type, class_id, short_name, path, text), one row per file.
"""

from pyspark.sql import Column, DataFrame, functions as F

from snapsync.functions.names import KIND_SUFFIXES, object_path, part_of_file
from snapsync.functions.text import nonempty, normalized_text
from snapsync.operators import diff, predicates
from snapsync.operators.predicates import OBJECT_KEY
from snapsync.operators.sizing import written
from snapsync.settings import Settings
from snapsync.sources import catalog
from snapsync.sources.catalog import Tables
from snapsync.sources.tree import folder_name_sets, parts_wide, typed_files

FILE_KEY = ("source_db", "path")
WRITTEN_KINDS = ("METHOD", "VIEW", "TRIGGER")
SNAPSHOT = (*OBJECT_KEY, "path", "text")


def snapshot_of_files(files: DataFrame, settings=Settings()) -> DataFrame:
    """Snapshot rows of a tree listing with texts."""
    return typed_files(files, settings).select(
        "source_db",
        "type",
        F.col("folder").alias("class_id"),
        F.substring_index("file", ".", 1).alias("short_name"),
        F.concat_ws("/", "folder", "file").alias("path"),
        "text",
    )


def export_parts(t: Tables, keys: DataFrame) -> DataFrame:
    """Every file of the objects with the given keys, packages excepted. One scan per kind for
    all objects; an absent part has a null text, which removes its file."""

    def wanted(kind):
        return keys.where(F.col("type") == kind)

    def rows(df, kind, extention):
        return df.select(
            "source_db",
            F.lit(kind).alias("type"),
            "class_id",
            "short_name",
            object_path(F.col("class_id"), F.col("short_name"), extention).alias("path"),
            "text",
        )

    methods = rows(catalog.method_texts(t, wanted("METHOD")), "METHOD", F.col("extention"))
    views = rows(catalog.view_texts(t, wanted("VIEW")), "VIEW", F.lit(None).cast("string"))
    triggers = rows(catalog.trigger_texts(t, wanted("TRIGGER")), "TRIGGER", F.lit("trg"))
    return methods.unionByName(views).unionByName(triggers)


def file_paths(keys: DataFrame) -> DataFrame:
    """(source_db, path) of every file that objects of the given keys can have, packages excepted.
    They follow from the names, so no text is read for them."""
    dotted = {kind: [s.removeprefix(".") for s in KIND_SUFFIXES[kind]] for kind in WRITTEN_KINDS}
    suffixes = F.create_map(
        *[x for kind, ends in dotted.items() for x in (F.lit(kind), F.array(*map(F.lit, ends)))]
    )
    return keys.select(
        "source_db",
        "class_id",
        "short_name",
        F.explode(F.try_element_at(suffixes, F.col("type"))).alias("_suffix"),
    ).select(
        "source_db",
        F.concat("class_id", F.lit("/"), "short_name", F.lit("."), "_suffix").alias("path"),
    )


def pull_all(t: Tables, snapshot: DataFrame, package_name: str | None = None) -> DataFrame:
    """The snapshot after a full pull: files of unknown kind and objects the source no longer has
    are gone, the others hold the source's texts. Packages have no texts to pull and stay."""
    known = diff.drop_unknown(snapshot.select(*SNAPSHOT))
    # Keys are narrow and used once per kind: written, so that catalogue and tree are read once. They
    # are met by an aggregate, as a semi join would go below the union of the catalogue's kinds and
    # read and type the tree once for each of them. As in a join, null is no key.
    sides = diff.diff_indicator(catalog.catalog_objects(t, package_name), known, OBJECT_KEY)
    found = written(sides.where("side = 'both'").select(*OBJECT_KEY).dropna(), "keys")
    packages = predicates.by_keys(known.where("type = 'PACKAGE'"), found)
    return _with_text(export_parts(t, found)).unionByName(packages)


def _with_text(rows: DataFrame) -> DataFrame:
    return rows.where(nonempty(F.col("text")))


def _pulled(t: Tables, snapshot: DataFrame, objects: DataFrame) -> DataFrame:
    """Files of the objects give way to their current texts; the rest of the snapshot stays."""
    keys = written(objects.select(*OBJECT_KEY).distinct(), "keys")
    others = diff.remove_objects(snapshot.select(*SNAPSHOT), file_paths(keys), FILE_KEY)
    return others.unionByName(_with_text(export_parts(t, keys)))


def changed_objects(t: Tables, as_of: Column, last=None, interval=None, package_name=None):
    """Catalogue rows changed since `last` (closed window) or within `interval` (look-back)."""
    objects = catalog.catalog_objects(t, package_name)
    if last is not None:
        return objects.where(predicates.in_window(F.col("modified"), last, as_of))
    return objects.where(predicates.in_lookback(F.col("modified"), as_of, interval))


def pull_last(t: Tables, snapshot, as_of: Column, interval: Column, package_name=None):
    return _pulled(t, snapshot, changed_objects(t, as_of, None, interval, package_name))


def pull_since(t: Tables, snapshot, as_of: Column, last: Column, package_name=None):
    return _pulled(t, snapshot, changed_objects(t, as_of, last, None, package_name))


def pull(t, snapshot, as_of=None, interval=None, last=None, listed=None, package_name=None):
    """Everything in the snapshot, or what the arguments choose: an interval, a start time or a
    DataFrame of (class_id, short_name)."""
    if interval is not None:
        return pull_last(t, snapshot, as_of, interval, package_name)
    if last is not None:
        return pull_since(t, snapshot, as_of, last, package_name)
    if listed is not None:
        objects = catalog.catalog_objects(t, package_name)
        return _pulled(t, snapshot, predicates.by_keys(objects, listed, ("class_id", "short_name")))
    return pull_all(t, snapshot, package_name)


def refresh_classes(t: Tables, files: DataFrame, settings=Settings()) -> DataFrame:
    """Normalised part texts of the methods that the folders name, per class folder."""
    names = folder_name_sets(files, settings)
    rows = catalog.method_texts(t, names).where("text is not null")
    return rows.select(
        "source_db",
        "class_id",
        "short_name",
        "extention",
        normalized_text(F.col("text")).alias("text"),
    )


def publish_tree(
    tree: DataFrame, listed: DataFrame, text: str, write, settings=Settings()
) -> None:
    """Hand the staging rows of the listed methods of a tree listing to `write`, which appends a
    DataFrame to the staging table (`append_jdbc`, say). Compiling them stays with the database."""
    files = snapshot_of_files(tree, settings)
    write(publish_rows(with_parts(files), listed, text))


def with_parts(files: DataFrame) -> DataFrame:
    """Snapshot rows with the method part that each file holds; null for other files."""
    name = F.substring_index("path", "/", -1)
    return files.withColumn("part", part_of_file(name))


def publish_rows(files: DataFrame, listed: DataFrame, text: str) -> DataFrame:
    """Staging rows of the listed methods: upper-case key and one nullable column per part."""
    names = predicates.parse_object_list(listed, text)
    methods = files.where("type = 'METHOD'")
    chosen = predicates.by_keys(methods, names, ("class_id", "short_name"))
    wide = parts_wide(chosen, ("source_db", "class_id", "short_name"))
    return wide.withColumns({"class_id": F.upper("class_id"), "short_name": F.upper("short_name")})
