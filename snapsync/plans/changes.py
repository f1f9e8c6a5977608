"""Changes of each kind and of all kinds, in one schema."""

from pyspark.sql import DataFrame, functions as F

from snapsync.functions.text import nonblank, or_empty, view_text
from snapsync.operators.predicates import OBJECT_KEY
from snapsync.operators.sizing import written
from snapsync.settings import Settings
from snapsync.sources import catalog
from snapsync.sources.catalog import Tables

KINDS = ("METHOD", "VIEW", "TRIGGER")


def normalized_rows(rows: DataFrame, kind: str) -> DataFrame:
    """Build `text`, drop the columns it came from and the rows without a text."""
    if kind == "VIEW":
        text = view_text(F.col("condition"), F.col("order_by"), F.col("group_by"))
        rows = rows.withColumn("text", text).drop("condition", "order_by", "group_by")
    elif kind == "TRIGGER":
        text = F.concat(or_empty(F.col("header")), or_empty(F.col("text")))
        rows = rows.withColumn("text", text).drop("header")
    return rows.where(nonblank(F.col("text"))).withColumn("type", F.lit(kind))


def concat_kinds(frames) -> DataFrame:
    """Union by name; a column that one kind lacks is null there."""
    first, *rest = frames
    for frame in rest:
        first = first.unionByName(frame, allowMissingColumns=True)
    return first


def changes_of_kind(t: Tables, kind, bounds, allowed, settings=Settings()) -> DataFrame:
    if kind == "METHOD":
        rows = catalog.method_rows(t, bounds, allowed, settings)
    elif kind == "VIEW":
        rows = catalog.view_rows(t, bounds, allowed, settings)
    else:
        rows = catalog.trigger_rows(t, bounds)
    return normalized_rows(rows, kind)


def changes_all(t: Tables, bounds, allowed, settings=Settings()) -> DataFrame:
    return concat_kinds([changes_of_kind(t, kind, bounds, allowed, settings) for kind in KINDS])


def window_or_folder(
    t: Tables, kind, bounds, allowed, tree, settings=Settings(), strict=False
) -> DataFrame:
    """Rows of the window or of the tree. How the two combine differs per kind; `strict` makes it
    (all filters) or folder for every kind."""
    if kind == "METHOD":
        return catalog.method_rows_or_folder(t, bounds, allowed, tree, settings)
    if kind == "VIEW":
        return catalog.view_rows_or_folder(t, bounds, allowed, tree, settings, strict)
    return catalog.trigger_rows(t, bounds, tree, strict)


def changes_or_folder(t, bounds, allowed, tree, settings=Settings(), strict=False) -> DataFrame:
    # Each kind needs its own names of the tree: written, so that the tree is listed once.
    tree = written(tree.select(*OBJECT_KEY).distinct(), "tree")
    return concat_kinds(
        [
            normalized_rows(
                window_or_folder(t, kind, bounds, allowed, tree, settings, strict), kind
            )
            for kind in KINDS
        ]
    )
