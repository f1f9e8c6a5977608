"""Helpers of the corpus operators: tables, shared folders, Arrow columns, words of a batch of texts."""

import os
import uuid
from functools import lru_cache
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Texts of one batch that are worked on together, in bytes; a longer text is a chunk of its own.
CHUNK_BYTES = 1 << 20
SALTS = 16
LAST = (1 << 63) - 1


def importable(spark: SparkSession) -> None:
    """Let Python workers find this package where the driver was started from elsewhere; on a
    cluster the package is installed on the executors, and the extra path does no harm."""
    root, paths = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
    if root not in paths.get("PYTHONPATH", "").split(os.pathsep):
        paths["PYTHONPATH"] = os.pathsep.join(filter(None, [root, paths.get("PYTHONPATH")]))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    importable(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """A new folder below the one in spark.checkpoint.dir, which every executor can reach."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = "/tmp/snapsync-checkpoints"
    return f"{folder.rstrip('/')}/llm/{uuid.uuid4().hex}"


def written(df: DataFrame) -> DataFrame:
    """Write df to the shared folder and read it back: the lineage ends there."""
    folder = shared_folder(df.sparkSession)
    df.write.option("compression", "zstd").parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def id_and_text(df: DataFrame, id_col: str, text_col: str, carry: bool = False) -> DataFrame:
    """Only the two columns that an operator reads, as `id` and `text` (null text: empty), so that
    other columns may have any name. With `carry`, all columns but the text are in `rest`."""
    found = [
        F.col(f"`{id_col}`").cast("long").alias("id"),
        F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"),
    ]
    if carry:
        others = [F.col(f"`{c}`") for c in df.columns if c != text_col]
        found.append(F.struct(*others).alias("rest"))
    return df.select(*found)


def extended(ddl: str, df: DataFrame, names: list[str]) -> T.StructType:
    """The schema of some DDL with further columns of df."""
    kind = T.StructType.fromDDL(ddl)
    for name in names:
        kind = kind.add(name, df.schema[name].dataType)
    return kind


def restored(df: DataFrame, like: DataFrame, text_col: str) -> DataFrame:
    """The columns of `like` out of `text` and `rest`."""
    return df.select(
        *[
            (F.col("text") if c == text_col else F.col("rest").getField(c)).alias(c)
            for c in like.columns
        ]
    )


def salted_left_join(rows: DataFrame, groups: DataFrame, keys: list[str], salts: int = SALTS):
    """Left join of rows, numbered by `row`, to one small row per group: a large group's rows are
    dealt out to `salts` tasks, each of which gets a copy of the group's row."""
    dealt = rows.withColumn("salt", F.pmod(F.xxhash64("row"), F.lit(salts)).cast("int"))
    copied = groups.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return dealt.join(copied, [*keys, "salt"], "left").drop("salt")


def text_buffer(column) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and n + 1 offsets of an Arrow string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, places, data = column.buffers()
    kind = np.int64 if wide else np.int32
    offsets = np.frombuffer(places, kind)[column.offset : column.offset + len(column) + 1]
    offsets = offsets.astype(np.int64)
    if data is None:
        return np.zeros(0, np.uint8), offsets - offsets[0]
    data = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def chunks(offsets: np.ndarray, limit: int = CHUNK_BYTES):
    """Ranges of rows whose texts have about `limit` bytes together."""
    first, n = 0, len(offsets) - 1
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
        last = min(max(last, first + 1), n)
        yield first, last
        first = last


def _fold() -> np.ndarray:
    """A-Z to a-z; every other ASCII byte but digits and a-z to a space; the rest as it is."""
    fold = np.full(256, 32, np.uint8)
    for low, high, shift in ((48, 58, 0), (65, 91, 32), (97, 123, 0), (128, 256, 0)):
        fold[low:high] = np.arange(low, high) + shift
    return fold


FOLD = _fold()
FOLD_BYTES = FOLD.tobytes()
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit hashes."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


_BYTE_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * _BASE)


@lru_cache(maxsize=2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = np.full(n, _BASE), np.full(n, _BASE_INVERSE)
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


def _powers_for(n: int):
    return _powers(max(1 << 21, 1 << int(n + 1).bit_length()))


def prefix_hashes(buffer: np.ndarray) -> np.ndarray:
    """Prefix sums from which `span_hashes` takes the hash of any byte span."""
    up, _ = _powers_for(len(buffer))
    sums = np.zeros(len(buffer) + 1, np.uint64)
    np.cumsum(_BYTE_VALUES[buffer] * up[: len(buffer)], out=sums[1:])
    return sums


def span_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte spans; equal bytes have equal hashes wherever they stand."""
    _, down = _powers_for(len(sums))
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def words_of(buffer: np.ndarray, offsets: np.ndarray):
    """Word starts and ends in the folded buffer, the first word of each row (n + 1 places)."""
    folded = FOLD[buffer]
    inside = np.zeros(len(folded) + 2, bool)
    inside[1:-1] = folded != 32
    begins = inside[1:-1] & ~inside[:-2]
    ends = inside[1:-1] & ~inside[2:]
    edges = offsets[(offsets > 0) & (offsets < len(folded))]
    begins[edges] |= inside[1:-1][edges]
    ends[edges - 1] |= inside[1:-1][edges - 1]
    starts = np.flatnonzero(begins)
    return folded, starts, np.flatnonzero(ends) + 1, np.searchsorted(starts, offsets)


def word_hashes(buffer: np.ndarray, offsets: np.ndarray):
    """Hash of each word and the first word of each row (n + 1 places), words as in `words_of`."""
    folded, starts, ends, first = words_of(buffer, offsets)
    return span_hashes(prefix_hashes(folded), starts, ends), first


def shingles(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hash of each run of `width` words, by the place of its first word; runs over the end of the
    array are left out, runs over the end of a row are the caller's to mask."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for i in range(width):
        out = mix(out * _BASE + hashes[i : i + n] + np.uint64(i))
    return out


def python_words(text: str | None) -> list[bytes]:
    """The words of one text; the plain form of `words_of`."""
    return (text or "").encode("utf-8", "surrogatepass").translate(FOLD_BYTES).split()
