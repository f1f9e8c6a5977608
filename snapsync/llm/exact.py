"""Exact duplicates by an exchange of Golomb-coded fingerprints.

Each task packs the hashes of its texts into blocks. A block sends every owner (a range of the hash
space) its sorted distinct fingerprints as Golomb-Rice coded gaps and gets back one bit for each:
does it occur again, in this block or another one? Only texts with a set bit are suspects; only they
are grouped by their bytes.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LAST, id_and_text, partitions, salted_left_join, written

BLOCK_ROWS = 1 << 16
SPACE = r"[\x20\x09-\x0D]+"


def golomb_encode(values: np.ndarray) -> bytes:
    """Sorted distinct uint64 values: count, Rice parameter, low bits of the gaps, high bits in
    unary."""
    gaps = np.diff(values, prepend=np.uint64(0))
    n = len(gaps)
    mean = int(values[-1] // np.uint64(n)) if n else 0
    k = max(0, mean.bit_length() - 1)
    low = ((gaps[:, None] >> np.arange(k, dtype=np.uint64)) & np.uint64(1)).astype(np.uint8)
    high = (gaps >> np.uint64(k)).astype(np.int64)
    unary = np.ones(int(high.sum()) + n, np.uint8)
    unary[np.cumsum(high + 1) - 1] = 0
    head = np.array([n, k, len(unary)], "<u4").tobytes()
    return head + np.packbits(low.ravel()).tobytes() + np.packbits(unary).tobytes()


def golomb_decode(raw: bytes) -> np.ndarray:
    n, k, ones = (int(x) for x in np.frombuffer(raw, "<u4", 3))
    middle = 12 + (n * k + 7) // 8
    low = np.unpackbits(np.frombuffer(raw, np.uint8)[12:middle], count=n * k).reshape(n, k)
    unary = np.unpackbits(np.frombuffer(raw, np.uint8)[middle:], count=ones)
    high = np.diff(np.flatnonzero(unary == 0), prepend=-1) - 1
    gaps = (low.astype(np.uint64) << np.arange(k, dtype=np.uint64)).sum(1, dtype=np.uint64)
    return np.cumsum(gaps + (high.astype(np.uint64) << np.uint64(k)), dtype=np.uint64)


def _fingerprints(shas: bytes) -> np.ndarray:
    return np.frombuffer(shas, ">u8").reshape(-1, 4)[:, 0].astype(np.uint64)


def _owners(prints: np.ndarray, owners: int) -> np.ndarray:
    return ((prints >> np.uint64(32)) * np.uint64(owners)) >> np.uint64(32)


BLOCK = "block long, ids binary, missing binary, shas binary"


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a task as blocks; the first row's number names the block."""

    def block():
        return pa.RecordBatch.from_arrays(
            [
                pa.array([name], pa.int64()),
                pa.array([b"".join(ids)], pa.binary()),
                pa.array([b"".join(missing)], pa.binary()),
                pa.array([b"".join(shas)], pa.binary()),
            ],
            ["block", "ids", "missing", "shas"],
        )

    ids, missing, shas, rows, name = [], [], [], 0, None
    for batch in batches:
        name = batch.column(2)[0].as_py() if name is None and batch.num_rows else name
        ids.append(batch.column(0).fill_null(0).to_numpy(zero_copy_only=False).astype("<i8").tobytes())
        missing.append(batch.column(0).is_null().to_numpy(zero_copy_only=False).tobytes())
        shas.append(b"".join(batch.column(1).to_pylist()))
        rows += batch.num_rows
        if rows >= BLOCK_ROWS:
            yield block()
            ids, missing, shas, rows, name = [], [], [], 0, None
    if rows:
        yield block()


def _send(owners: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, shas in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                prints, counts = np.unique(_fingerprints(shas), return_counts=True)
                owner = _owners(prints, owners)
                edges = np.searchsorted(owner, np.arange(owners + 1, dtype=np.uint64))
                sent = [o for o in range(owners) if edges[o] < edges[o + 1]]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(sent, pa.int32()),
                        pa.array([name] * len(sent), pa.int64()),
                        pa.array([golomb_encode(prints[edges[o] : edges[o + 1]]) for o in sent]),
                        pa.array(
                            [np.packbits(counts[edges[o] : edges[o + 1]] > 1).tobytes() for o in sent]
                        ),
                    ],
                    ["owner", "block", "prints", "again"],
                )

    return work


def _answer(messages: pa.Table) -> pa.Table:
    """One owner: which fingerprints of each block occur again."""
    blocks = messages.column("block").to_pylist()
    prints = [golomb_decode(raw) for raw in messages.column("prints").to_pylist()]
    again = [
        np.unpackbits(np.frombuffer(raw, np.uint8), count=len(p)).astype(bool)
        for raw, p in zip(messages.column("again").to_pylist(), prints)
    ]
    found, counts = np.unique(np.concatenate(prints), return_counts=True)
    twice = found[counts > 1]
    bits = [np.packbits(a | np.isin(p, twice)).tobytes() for a, p in zip(again, prints)]
    return pa.table(
        {"block": pa.array(blocks, pa.int64()), "owner": messages.column("owner"), "bits": pa.array(bits, pa.binary())}
    )


ROWS = "row long, id long, sha string, suspect boolean"


def _suspects(owners: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in batch.to_pylist():
                prints = _fingerprints(block["shas"])
                own, back = np.unique(prints, return_inverse=True)
                owner = _owners(own, owners)
                bits = np.zeros(len(own), bool)
                for answer in block["answers"]:
                    low, high = np.searchsorted(owner, [answer["owner"], answer["owner"] + 1])
                    bits[low:high] = np.unpackbits(
                        np.frombuffer(answer["bits"], np.uint8), count=high - low
                    )
                ids = np.frombuffer(block["ids"], "<i8")
                raw = block["shas"]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(block["block"] + np.arange(len(ids))),
                        pa.array(ids, mask=np.frombuffer(block["missing"], bool)),
                        pa.array([raw[i : i + 32].hex() for i in range(0, len(raw), 32)]),
                        pa.array(bits[back]),
                    ],
                    ["row", "id", "sha", "suspect"],
                )

    return work


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: `id`, `sha` (SHA-256 of its normalised text, hexadecimal), `keep_id`
    (smallest id with an equal text), `group_size` (rows with an equal text) and `kept`.

    Texts are equal if their bytes are, after each run of white space became one space; null counts
    as empty. A null id comes after all others. Rows with equal ids and equal texts are one group
    too: exactly one of them is kept.
    """
    spark = docs.sparkSession
    owners = partitions(spark)
    text = F.regexp_replace("text", SPACE, " ")
    source = id_and_text(docs, id_col, text_col).select("id", text.alias("text"))
    hashed = source.select(
        "id", F.unhex(F.sha2("text", 256)).alias("sha"), F.monotonically_increasing_id().alias("row")
    )
    blocks = written(hashed.mapInArrow(_pack, BLOCK))
    messages = blocks.select("block", "shas").mapInArrow(
        _send(owners), "owner int, block long, prints binary, again binary"
    )
    answers = (
        messages.groupBy("owner")
        .applyInArrow(_answer, "block long, owner int, bits binary")
        .groupBy("block")
        .agg(F.collect_list(F.struct("owner", "bits")).alias("answers"))  # one per owner
    )
    rows = written(blocks.join(answers, "block").mapInArrow(_suspects(owners), ROWS))

    # Suspects: rows of the same id and hash are one unit, named by its first row.
    last = F.lit(LAST)
    units = rows.where("suspect").groupBy("id", "sha").agg(F.min("row").alias("row"))
    checked = (
        source.alias("d")
        .join(units.alias("u"), F.col("d.id").eqNullSafe(F.col("u.id")))
        .where(F.sha2(F.col("d.text"), 256) == F.col("u.sha"))
    )
    order = F.coalesce(F.col("d.id"), last)
    groups = (
        checked.groupBy(F.col("d.text").alias("text"))
        .agg(
            F.min(order).alias("keep"),
            F.min_by(F.col("u.row"), order).alias("keep_row"),
            F.count("*").alias("group_size"),
        )
        .where("group_size > 1")
        .select(F.sha2("text", 256).alias("sha"), "keep", "keep_row", "group_size")
    )
    joined = salted_left_join(rows, groups, ["sha"])
    single = F.col("keep").isNull()
    return joined.select(
        "id",
        "sha",
        F.when(single, F.col("id")).otherwise(F.nullif("keep", last)).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        (single | (F.col("row") == F.col("keep_row"))).alias("kept"),
    )
