"""File trees of the form folder/name.ext: listing, reading, writing."""

import os
import re
import tempfile

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from snapsync.functions.names import METHOD_PARTS, kind_by_pieces, kind_by_suffix, object_name
from snapsync.functions.text import nonempty
from snapsync.operators.predicates import outside_folders
from snapsync.settings import Settings


def _files(spark: SparkSession, root: str) -> DataFrame:
    """Files exactly two levels below root, with folder and file name. Spark does not list files
    whose names start with a dot or an underscore."""
    pieces = F.split("path", "/")
    folder, file = F.element_at(pieces, -2), F.element_at(pieces, -1)
    inside = re.sub(r"^\w+:/+", "/", root.rstrip("/"))
    return (
        spark.read.format("binaryFile")
        .load(f"{root.rstrip('/')}/*/*")
        .withColumns({"folder": folder, "file": file})
        .where(F.col("path").endswith(F.concat_ws("/", F.lit(inside), "folder", "file")))
    )


def list_tree(spark: SparkSession, root: str) -> DataFrame:
    """(folder, file) of a tree. Only names are read, no contents."""
    return _files(spark, root).select("folder", "file")


def read_tree(spark: SparkSession, root: str, encoding="utf8") -> DataFrame:
    """(folder, file, text) with whole texts."""
    text = decoded(F.col("content"), encoding).alias("text")
    return _files(spark, root).select("folder", "file", text)


def decoded(content: Column, encoding: str) -> Column:
    """Decode UTF-8 or any single-byte encoding; the latter as Latin-1 with its upper half mapped."""
    if encoding.lower().replace("-", "") == "utf8":
        return F.decode(content, "UTF-8")
    upper = [bytes([b]).decode(encoding, "replace") for b in range(128, 256)]
    latin = "".join(chr(b) for b in range(128, 256))
    return F.translate(F.decode(content, "ISO-8859-1"), latin, "".join(upper))


def _wanted(files: DataFrame, settings: Settings) -> DataFrame:
    return files.where(outside_folders(F.col("folder"), settings.excluded_folders))


def _labels(files: DataFrame) -> list:
    """A listing of several trees carries source_db."""
    return [c for c in files.columns if c == "source_db"]


def objects_in_folder(files: DataFrame, settings=Settings()) -> DataFrame:
    """Distinct objects by the dot-piece rule."""
    return (
        _wanted(files, settings)
        .select(
            *_labels(files),
            F.col("folder").alias("class_id"),
            object_name(F.col("file")).alias("short_name"),
            kind_by_pieces(F.col("file")).alias("type"),
        )
        .dropDuplicates()
    )


def typed_files(files: DataFrame, settings=Settings()) -> DataFrame:
    """Files with their kind by the suffix rule."""
    return _wanted(files, settings).withColumn("type", kind_by_suffix(F.col("file")))


def tree_elements(files: DataFrame, settings=Settings()) -> DataFrame:
    """One element per file."""
    return typed_files(files, settings).select(
        *_labels(files),
        "type",
        F.col("folder").alias("class_id"),
        object_name(F.col("file")).alias("short_name"),
    )


def tree_schema(files: DataFrame, settings=Settings()) -> DataFrame:
    return tree_elements(files, settings).dropDuplicates()


def folder_name_sets(files: DataFrame, settings=Settings()) -> DataFrame:
    """Distinct (folder, name); a folder without files does not occur."""
    return (
        _wanted(files, settings)
        .select(
            *_labels(files),
            F.col("folder").alias("class_id"),
            object_name(F.col("file")).alias("short_name"),
        )
        .dropDuplicates()
    )


def parts_wide(parts: DataFrame, keys=("class_id", "short_name")) -> DataFrame:
    """One row per object with one column per method part; a missing part is null."""
    return parts.groupBy(*keys).pivot("part", list(METHOD_PARTS)).agg(F.max("text"))


def parts_long(wide: DataFrame, keys=("class_id", "short_name")) -> DataFrame:
    """One row per object and part that has a text."""
    return wide.unpivot(list(keys), list(METHOD_PARTS), "part", "text").where(
        nonempty(F.col("text"))
    )


def write_tree(rows: DataFrame, root: str) -> None:
    """Write `text` of each row to root/path; a null or empty text removes the file.

    `root` is a local path of a folder that all executors share (a mounted file system); another
    scheme is refused, as each executor would make a folder of that name on its own disk. So are paths
    that lead out of the root. Each file is replaced in one step, so that a task that is run again
    leaves the same tree.
    """
    scheme, found, rest = root.partition("://")
    if found and scheme != "file":
        raise ValueError(f"write_tree writes to a mounted folder, not to {scheme}://")
    root = os.path.abspath(rest if found else root)

    def write(partition):
        for path, text in partition:
            target = os.path.normpath(os.path.join(root, path))
            if os.path.commonpath([root, target]) != root or target == root:
                raise ValueError(f"path leads out of the tree: {path}")
            if not text:
                if os.path.exists(target):
                    os.remove(target)
                continue
            folder = os.path.dirname(target)
            os.makedirs(folder, exist_ok=True)
            with tempfile.NamedTemporaryFile(dir=folder, prefix=".", delete=False) as part:
                part.write(text.encode())
            os.replace(part.name, target)

    rows.select("path", "text").foreachPartition(write)
