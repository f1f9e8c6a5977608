"""Line dedup: repeated runs of lines, found by ranks over sequences of line ids.

Lines that occur once cut the documents into segments of repeated lines; equal segments become one.
A run that counts is covered by its shortest parts that count: from each of its lines on, or from its
first line, and up to its last one (of two lines at least, so that neighbours share a part). So only
these windows are compared, forward and backward from each place. Prefix doubling ranks the places of the segments: each round sorts the distinct pairs of
(rank of the first k lines, rank of the next k) in Spark and numbers them in order, until the ranks
reach as far as the longest window. Two ranks name a window, and all but its first copy go.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import (
    LAST,
    SALTS,
    extended,
    id_and_text,
    restored,
    salted_left_join,
    written,
)
from .repeats import merged

MIN_WORDS = 50
BLANK = " \t\r\x0b\x0c"
# Between white space of any kind, no-break spaces among them.
WORD = r"(?U)\S+"
PLACES = "seg long, place long, at long, high long, low long, need long, back long"
LEFT = "row long, id long, text string, n_lines long, n_removed long"


def _places(min_words: int):
    """Places of a segment, and how many lines from each on (`need`) and up to each (`back`) have
    enough words; 0 where the segment has too few."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for segment in batch.to_pylist():
                lines = segment["lines"]
                places = np.arange(len(lines))
                words = np.cumsum([0] + [line["words"] for line in lines])
                stop = np.searchsorted(words, words[:-1] + min_words, "left")
                need = np.where(stop < len(words), stop - places, 0)
                start = np.searchsorted(words, words[1:] - min_words, "right") - 1
                back = np.where(start >= 0, places + 1 - start, 0)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([segment["seg"]] * len(lines), pa.int64()),
                        pa.array(places),
                        pa.array([line["at"] for line in lines], pa.int64()),
                        pa.array([line["high"] for line in lines], pa.int64()),
                        pa.array([line["low"] for line in lines], pa.int64()),
                        pa.array(need),
                        pa.array(back),
                    ],
                    [c.split()[0] for c in PLACES.split(", ")],
                )

    return work


def numbered(pairs: DataFrame, *columns: str) -> DataFrame:
    """Distinct rows in global order, numbered in that order (with gaps)."""
    ordered = pairs.select(*columns).distinct().orderBy(*columns)
    return written(ordered.withColumn("rank", F.monotonically_increasing_id()))


def doubled(places: DataFrame, depth: int) -> tuple[DataFrame, int]:
    """Columns r0, r1, ... with the rank of the first 1, 2, 4, ... lines from each place on, as long
    as these are at most `depth` lines; a run that the segment's end cuts ranks before longer ones."""
    first = numbered(places, "high", "low")
    ranked = written(
        places.join(first, ["high", "low"])
        .withColumnRenamed("rank", "r0")
        .drop("high", "low")
    )
    levels, step = 1, 1
    along = Window.partitionBy("seg").orderBy("place")
    while 2 * step <= depth:
        old = f"r{levels - 1}"
        paired = ranked.withColumn("next", F.coalesce(F.lead(old, step).over(along), F.lit(-1)))
        order = numbered(paired, old, "next").withColumnRenamed("rank", f"r{levels}")
        ranked = written(paired.join(order, [old, "next"]).drop("next"))
        levels, step = levels + 1, step * 2
    return ranked, levels


def _delete(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts, counts, gone = [], [], []
        for text, spans in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
            lines = text.split("\n")
            keep = np.ones(len(lines), bool)
            if spans:
                starts, stops = (np.array([s[k] for s in spans]) for k in ("start", "stop"))
                for a, b in zip(*merged(starts, stops)):
                    keep[a:b] = False
            texts.append("\n".join(line for line, k in zip(lines, keep) if k))
            counts.append(len(lines))
            gone.append(int((~keep).sum()))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                batch.column(1),
                pa.array(texts, pa.string()),
                pa.array(counts, pa.int64()),
                pa.array(gone, pa.int64()),
                *batch.columns[4:],
            ],
            ["row", "id", "text", "n_lines", "n_removed", *batch.schema.names[4:]],
        )


def repeated_lines(
    docs: DataFrame, min_words: int = MIN_WORDS, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per document: `row`, `id`, `text` (what is left), `n_lines` and `n_removed`.

    A run of lines with at least `min_words` words (parted by white space of any kind; a line has at
    least one) that also stands earlier goes:
    in a smaller id, the same id in a smaller row, or further up. Lines are equal if they are after
    white space at their ends is cut off; lines without words neither part nor lengthen a run and go
    if they stand inside one. Null ids come last, null texts count as empty. An empty table gives no
    rows.
    """
    rows = _numbered(id_and_text(docs, id_col, text_col))
    return rows.join(_spans(rows, min_words), "row", "left").select("row", "id", "text", "spans").mapInArrow(
        _delete, LEFT
    )


def drop_repeated_lines(
    docs: DataFrame,
    min_words: int = MIN_WORDS,
    id_col: str = "doc_id",
    text_col: str = "text",
    size_col: str = "n_chars",
) -> DataFrame:
    """The documents without the lines that `repeated_lines` deletes. A document that had words and
    has none left is a copy of others, and goes. Where there is a column `size_col`, it gets the new
    number of characters of the documents that changed."""
    rows = _numbered(id_and_text(docs, id_col, text_col, carry=True))
    found = (
        rows.join(_spans(rows, min_words), "row", "left")
        .select("row", "id", "text", "spans", "rest")
        .mapInArrow(_delete, extended(LEFT, rows, ["rest"]))
        .where((F.col("n_removed") == 0) | (F.btrim("text", F.lit(BLANK + "\n")) != ""))
    )
    if size_col in docs.columns:
        size = F.char_length("text").cast(docs.schema[size_col].dataType)
        changed = F.when(F.col("n_removed") > 0, size).otherwise(F.col("rest").getField(size_col))
        found = found.withColumn("rest", F.col("rest").withField(f"`{size_col}`", changed))
    return restored(found, docs, text_col)


def _numbered(texts: DataFrame) -> DataFrame:
    return written(
        texts.select(
            F.monotonically_increasing_id().alias("row"),
            F.coalesce("id", F.lit(LAST)).alias("id_order"),
            *texts.columns,
        )
    )


def _spans(rows: DataFrame, min_words: int) -> DataFrame:
    """`row` and `spans` (start, stop) of the lines to delete."""
    spark = rows.sparkSession
    cut = F.transform(
        F.split("text", "\n"),
        lambda line, i: F.struct(i.alias("at"), F.btrim(line, F.lit(BLANK)).alias("line")),
    )
    cut = F.posexplode(F.filter(cut, lambda s: s["line"] != "")).alias("place", "s")
    line = F.col("s.line")
    lines = written(
        rows.select("row", "id_order", cut).select(
            "row",
            "id_order",
            "place",
            F.col("s.at").alias("at"),
            F.xxhash64(F.lit(1), line).alias("high"),
            F.xxhash64(F.lit(2), line).alias("low"),
            F.greatest(F.regexp_count(line, F.lit(WORD)), F.lit(1)).alias("words"),
        )
    )
    twice = lines.groupBy("high", "low").agg(F.count("*").alias("n")).where("n > 1")
    shared = salted_left_join(lines, twice, ["high", "low"]).where("n is not null")

    # Segments: repeated lines that follow each other.
    within = Window.partitionBy("row").orderBy("place")
    segments = (
        shared.withColumn("island", F.col("place") - F.row_number().over(within))
        .groupBy("row", "island")
        .agg(
            F.first("id_order").alias("id_order"),
            F.sum("words").alias("words"),
            F.array_sort(F.collect_list(F.struct("place", "at", "high", "low", "words"))).alias("lines"),
        )
        .where(F.col("words") >= min_words)
        .withColumn("start", F.col("lines")[0]["at"])
    )
    ids = F.transform("lines", lambda s: F.struct(s["high"].alias("high"), s["low"].alias("low")))
    segments = written(
        segments.select(
            "*",
            F.monotonically_increasing_id().alias("seg"),
            F.xxhash64(F.lit(1), ids).alias("sign_high"),
            F.xxhash64(F.lit(2), ids).alias("sign_low"),
        )
    )
    firsts = segments.groupBy("sign_high", "sign_low").agg(
        F.min(F.struct("id_order", "row", "start", "seg")).alias("first")
    )
    firsts = firsts.select("sign_high", "sign_low", F.col("first.seg").alias("first_seg"))
    marked = salted_left_join(
        segments.select("row", "seg", "sign_high", "sign_low", "start", (F.element_at("lines", -1)["at"] + 1).alias("stop")),
        firsts,
        ["sign_high", "sign_low"],
    )
    marked = written(marked)
    copies = marked.where("seg != first_seg").select(
        "row", F.col("start").cast("long").alias("start"), F.col("stop").cast("long").alias("stop")
    )
    distinct = written(
        segments.join(marked.where("seg = first_seg").select("seg"), "seg").select(
            "seg", "row", "id_order", "lines"
        )
    )

    places = written(distinct.select("seg", "lines").mapInArrow(_places(min_words), PLACES))
    ranked, levels = doubled(places, max(min_words, 2))
    owners = distinct.select("seg", "row", "id_order")
    found = _again(written(_windows(ranked, levels).join(owners, "seg")))
    return (
        copies.unionByName(found)
        .groupBy("row")
        .agg(F.collect_list(F.struct("start", "stop")).alias("spans"))
    )


def _windows(ranked: DataFrame, levels: int) -> DataFrame:
    """The windows of each segment (first and last line's `at`) with their names.

    A window of `size` lines is named by the ranks of the first and the last 2^l lines of it, where
    2^l is at most `size`: equal names, equal windows.
    """
    ranks = ranked.select(
        "seg", "place", "at", F.array(*[F.col(f"r{i}") for i in range(levels)]).alias("ranks")
    )
    forward = ranked.where("need > 0").select("seg", "place", F.col("need").alias("size"))
    backward = ranked.where("back > 0").select(
        "seg", (F.col("place") - F.col("back") + 1).alias("place"), F.col("back").alias("size")
    )
    level = F.floor(F.log2("size")).cast("int")
    # A line that counts alone also counts with its neighbours: lines without words between them go.
    after = forward.where("size = 1").select("seg", "place", F.lit(2).cast("long").alias("size"))
    to_it = after.where("place > 0").withColumn("place", F.col("place") - 1)
    sized = forward.unionByName(backward).unionByName(after).unionByName(to_it).distinct()
    sized = sized.withColumn("level", level)
    heads = sized.join(ranks, ["seg", "place"]).select(
        "seg",
        "size",
        "level",
        F.col("at").alias("start"),
        F.get("ranks", "level").alias("head"),
        (F.col("place") + F.col("size") - 1).alias("last"),
        (F.col("place") + F.col("size") - F.pow(F.lit(2), F.col("level")).cast("long")).alias("tail_place"),
    )
    tails = ranks.select("seg", F.col("place").alias("tail_place"), "ranks")
    lasts = ranks.select("seg", F.col("place").alias("last"), (F.col("at") + 1).alias("stop"))
    named = heads.join(tails, ["seg", "tail_place"]).withColumn("tail", F.get("ranks", "level"))
    return named.join(lasts, ["seg", "last"]).select("seg", "size", "head", "tail", "start", "stop")


def _again(windows: DataFrame) -> DataFrame:
    """`row`, `start` and `stop` of all windows that also stand earlier."""
    key = ["size", "head", "tail"]
    firsts = (
        windows.groupBy(*key)
        .agg(F.count("*").alias("n"), F.min(F.struct("id_order", "row", "start")).alias("first"))
        .where("n > 1")
        .select(*key, "first.row", "first.start")
        .withColumnsRenamed({"row": "first_row", "start": "first_start"})
    )
    dealt = windows.withColumn("salt", F.pmod(F.xxhash64("row", "start"), F.lit(SALTS)).cast("int"))
    copied = firsts.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    again = (F.col("row") != F.col("first_row")) | (F.col("start") != F.col("first_start"))
    return dealt.join(copied, [*key, "salt"]).where(again).select("row", "start", "stop")
