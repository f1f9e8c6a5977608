"""Trees that are written as a whole.

Each write puts its files and lists of them into folders of its own; one record, created last, makes them
part of the tree. A reader follows the records, so it sees all of a write or nothing.

    root/files/<write>/<attempt of a task>/<folder>/<name>   one file per text
    root/parts/<write>/<attempt of a task>.parquet           path, size and hash of each; no hash: removed
    root/commits/<number>.json                               write, attempts that count, number of files
"""

import hashlib
import json
import os
import time
import uuid
from dataclasses import asdict, dataclass

import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

from snapsync.operators.ordering import latest_row
from snapsync.sources.tree import decoded

FORMAT = "committed_tree"
PART = pa.schema([("path", pa.string()), ("size", pa.int64()), ("text_sha", pa.string())])
PART_DDL = "path string, size long, text_sha string"
PART_ROWS = 10_000


class Conflict(Exception):
    """The tree isn't in the state that the writer started from."""


def _place(root: str) -> tuple[pafs.FileSystem, str]:
    if "://" in root:
        return pafs.FileSystem.from_uri(root.rstrip("/"))
    return pafs.LocalFileSystem(), os.path.abspath(root)


def _checked(path: str) -> str:
    """A path of folder and name. Spark doesn't list names that start with a dot or an underscore."""
    pieces = path.split("/")
    if len(pieces) != 2 or any(not p or p[0] in "._" for p in pieces):
        raise ValueError(f"not a path of the form folder/name: {path}")
    return path


@dataclass
class Attempt(WriterCommitMessage):
    name: str
    files: int
    removed: int


class TreeWriter(DataSourceWriter):
    def __init__(self, root: str, overwrite: bool, after: int | None):
        self.root, self.overwrite, self.after = root, overwrite, after
        self.name = uuid.uuid4().hex

    def write(self, rows) -> Attempt:
        """Files of one attempt of a task; another attempt of the task writes beside it."""
        system, root = _place(self.root)
        done = Attempt(uuid.uuid4().hex, 0, 0)
        parts, files = f"{root}/parts/{self.name}", f"{root}/files/{self.name}/{done.name}"
        system.create_dir(parts, recursive=True)
        made, listed = set(), []
        with pq.ParquetWriter(f"{parts}/{done.name}.parquet", PART, filesystem=system) as part:
            for path, text in rows:
                raw = (text or "").encode()
                target = f"{files}/{_checked(path)}"
                if raw:
                    folder = target.rpartition("/")[0]
                    if folder not in made:
                        system.create_dir(folder, recursive=True)
                        made.add(folder)
                    with system.open_output_stream(target) as out:
                        out.write(raw)
                done.files, done.removed = done.files + bool(raw), done.removed + (not raw)
                sha = hashlib.sha256(raw).hexdigest() if raw else None
                listed.append({"path": path, "size": len(raw), "text_sha": sha})
                if len(listed) == PART_ROWS:
                    part.write_table(pa.Table.from_pylist(listed, PART))
                    listed.clear()
            part.write_table(pa.Table.from_pylist(listed, PART))
        return done

    def commit(self, messages) -> None:
        done = [m for m in messages if m is not None]
        system, root = _place(self.root)
        number = max(_numbers(system, root), default=0)
        if self.after is not None and number != self.after:
            raise Conflict(f"the tree is at commit {number}, not at {self.after}")
        record = {
            "write": self.name,
            "overwrite": self.overwrite,
            "attempts": [asdict(m)["name"] for m in done],
            "files": sum(m.files for m in done),
            "removed": sum(m.removed for m in done),
        }
        while not _create(system, root, number + 1, json.dumps(record).encode()):
            if self.after is not None:
                raise Conflict(f"another write was committed after {self.after}")
            number += 1

    def abort(self, messages) -> None:
        system, root = _place(self.root)
        for kind in ("files", "parts"):
            if system.get_file_info(f"{root}/{kind}/{self.name}").type != pafs.FileType.NotFound:
                system.delete_dir(f"{root}/{kind}/{self.name}")


class CommittedTree(DataSource):
    """`df.write.format("committed_tree").mode("append").save(root)` for rows of (path, text).

    A null or empty text removes the path. `overwrite` makes the rows the whole tree. Of rows with the
    same path in one write the one with the greatest hash stands, a removal last. The option `after`
    names the commit (0: none) that must be the newest one still; else the write is taken back.
    """

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return "path string, text string"

    def writer(self, schema, overwrite: bool) -> TreeWriter:
        if schema.fieldNames() != ["path", "text"]:
            raise ValueError(f"a tree takes (path, text), not {schema.fieldNames()}")
        after = self.options.get("after")
        return TreeWriter(self.options["path"], overwrite, None if after is None else int(after))


def _numbers(system, root: str) -> list[int]:
    chosen = pafs.FileSelector(f"{root}/commits", allow_not_found=True)
    names = [info.base_name for info in system.get_file_info(chosen)]
    return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json"))


def _create(system, root: str, number: int, content: bytes) -> bool:
    """Create a commit record unless there is one of that number. On mounted folders that is one step;
    other file systems have none that Arrow offers, so there one writer at a time may commit."""
    target = f"{root}/commits/{number:010d}.json"
    system.create_dir(f"{root}/commits", recursive=True)
    if not isinstance(system, pafs.LocalFileSystem):
        if system.get_file_info(target).type != pafs.FileType.NotFound:
            return False
        with system.open_output_stream(target) as out:
            out.write(content)
        return True
    part = f"{root}/commits/{uuid.uuid4().hex}.part"
    with open(part, "wb") as out:
        out.write(content)
    try:
        os.link(part, target)
    except FileExistsError:
        return False
    finally:
        os.remove(part)
    return True


def write_committed(rows: DataFrame, root: str, overwrite=False, after: int | None = None) -> None:
    """Write (path, text) rows as one commit."""
    rows.sparkSession.dataSource.register(CommittedTree)
    writer = rows.select("path", "text").write.format(FORMAT)
    if after is not None:
        writer = writer.option("after", str(after))
    writer.mode("overwrite" if overwrite else "append").save(root)


def sweep(root: str, keep_hours: float = 24.0) -> int:
    """Remove the folders of writes that no record names and that are older than `keep_hours`; a write
    must not take longer than that. An abort removes what its tasks have written by then; a task that
    is stopped later, or a lost driver, leaves files. Returns the number of writes removed."""
    system, place = _place(root)
    named = {_record(system, place, n)["write"] for n in _numbers(system, place)}
    before, gone = time.time() - keep_hours * 3600, set()
    for kind in ("files", "parts"):
        chosen = pafs.FileSelector(f"{place}/{kind}", allow_not_found=True)
        for info in system.get_file_info(chosen):
            if info.base_name not in named and _older(system, info, before):
                system.delete_dir(info.path)
                gone.add(info.base_name)
    return len(gone)


def _older(system, info, before: float) -> bool:
    """Is all that a folder holds from before a time? Object stores give folders no time."""
    held = system.get_file_info(pafs.FileSelector(info.path, recursive=True))
    times = [i.mtime.timestamp() for i in [info, *held] if i.mtime is not None]
    return all(t <= before for t in times)


def _record(system, place: str, number: int) -> dict:
    with system.open_input_stream(f"{place}/commits/{number:010d}.json") as source:
        return json.loads(source.read())


def last_commit(root: str) -> int:
    """Number of the newest commit, 0 for none."""
    system, place = _place(root)
    return max(_numbers(system, place), default=0)


def tree_files(spark: SparkSession, root: str, at: int | None = None) -> DataFrame:
    """(path, size, text_sha, commit, location) of each file of the tree as of a commit (the newest if
    None). Only lists are read, no files. One record per commit reaches the driver."""
    system, place = _place(root)
    parts, numbers = [], []
    for number in _numbers(system, place):
        if at is not None and number > at:
            break
        record = _record(system, place, number)
        if record["overwrite"]:
            parts, numbers = [], []
        numbers.append((record["write"], number))
        parts += [f"{root}/parts/{record['write']}/{name}.parquet" for name in record["attempts"]]
    rows = spark.read.schema(PART_DDL).parquet(*parts) if parts else None
    if rows is None:
        return spark.createDataFrame([], f"{PART_DDL}, commit long, location string")
    known = spark.createDataFrame(numbers, "_write string, commit long")
    pieces = F.split(F.col("_metadata.file_path"), "/")
    attempt = F.regexp_replace(F.element_at(pieces, -1), r"\.parquet$", "")
    placed = rows.select(
        "path",
        "size",
        "text_sha",
        F.element_at(pieces, -2).alias("_write"),
        F.concat_ws("/", F.element_at(pieces, -2), attempt, "path").alias("location"),
    ).join(F.broadcast(known), "_write")  # one row per commit
    newest = latest_row(placed, ["path"], [F.desc("commit"), F.desc_nulls_last("text_sha"), "location"])
    live = newest.where("text_sha is not null")
    return live.select("path", "size", "text_sha", "commit", "location")


def read_committed(
    spark: SparkSession, root: str, at: int | None = None, encoding="utf8"
) -> DataFrame:
    """(folder, file, text) of the tree as of a commit, with whole texts."""
    state = tree_files(spark, root, at)
    writes = state.select(F.split("location", "/")[0].alias("w")).distinct().collect()
    if not writes:
        return spark.createDataFrame([], "folder string, file string, text string")
    pieces = F.split("path", "/")
    files = (
        spark.read.format("binaryFile")
        .load([f"{root.rstrip('/')}/files/{r.w}/*/*/*" for r in writes])
        .select(F.concat_ws("/", F.slice(pieces, -4, 4)).alias("location"), "content")
    )
    place = F.split("path", "/")
    found = files.join(state.select("path", "location"), "location")
    return found.select(
        place[0].alias("folder"), place[1].alias("file"), decoded(F.col("content"), encoding).alias("text")
    )
