"""Quality by compression: texts that a dictionary of good texts compresses better than one of bad
texts score high.

Two zstandard dictionaries hold blocks of good and of bad labelled texts. Every text is compressed
whole, block by block, with each; the difference of the sizes, divided by the text's size, and the
sizes themselves go into a logistic function that is fitted on labelled texts which are in neither
dictionary.
"""

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import id_and_text

BLOCK = 4096
LEVEL = 1
FEATURES = 7
# Bounds of the fit: labelled rows of each class, blocks of a text, bytes of a dictionary and, at least, of
# a piece of a block in it.
ROWS_PER_CLASS, BLOCKS_PER_TEXT, DICTIONARY_BYTES, PIECE = 2500, 4, 110_000, 64


def _shapes() -> bytes:
    """Lower-case letters to a, upper-case ones to A, digits to 0, bytes beyond ASCII to a."""
    shapes = bytearray(range(256))
    for low, high, letter in ((48, 58, b"0"), (65, 91, b"A"), (97, 123, b"a"), (128, 256, b"a")):
        shapes[low:high] = letter * (high - low)
    return bytes(shapes)


SHAPES = _shapes()
# Bytes that an empty frame takes: they say nothing about the text.
FRAME = 9


def shape_of(raw: bytes) -> bytes:
    """The text with each run of letters of a kind, or of digits, as one."""
    return re.sub(rb"([aA0])\1+", rb"\1", raw.translate(SHAPES))


class Compressors:
    """Compresses a text, and its shape, with the good and the bad dictionary and with none."""

    def __init__(self, good: bytes, bad: bytes):
        views = [(good, bad), (shape_of(good), shape_of(bad))]
        self.views = [
            [*(_compressor(d) for d in both), zstandard.ZstdCompressor(level=LEVEL, write_content_size=False)]
            for both in views
        ]

    def features(self, raw: bytes) -> tuple[float, ...]:
        """Length, and by view: size per byte good minus bad, the smaller of the two, without a
        dictionary. Sizes per byte of short texts differ from those of long ones."""
        if not raw:
            return (0.0,) * FEATURES
        out = [float(np.log(len(raw)))]
        for view, compressors in zip((raw, shape_of(raw)), self.views):
            sizes = [0, 0, 0]
            for at in range(0, len(view), BLOCK):
                block = view[at : at + BLOCK]
                for i, one in enumerate(compressors):
                    sizes[i] += max(1, len(one.compress(block)) - FRAME)
            good, bad, alone = sizes
            n = len(view)
            out += [(good - bad) / n, min(good, bad) / n, alone / n]
        return tuple(out)


def _compressor(raw: bytes) -> zstandard.ZstdCompressor:
    return zstandard.ZstdCompressor(
        level=LEVEL, dict_data=_dictionary(raw), write_content_size=False, write_checksum=False,
        write_dict_id=False,
    )


def _dictionary(raw: bytes) -> zstandard.ZstdCompressionDict:
    found = zstandard.ZstdCompressionDict(raw or b" ", zstandard.DICT_TYPE_RAWCONTENT)
    found.precompute_compress(level=LEVEL)
    return found


def clipped(x: np.ndarray) -> np.ndarray:
    """Standardised features of odd texts (a few bytes, say) stay near those of the fit."""
    return np.clip(x, -3, 3)


def expanded(x: np.ndarray) -> np.ndarray:
    """Features with squares and products, and a constant."""
    i, j = np.triu_indices(x.shape[1])
    return np.hstack([np.ones((len(x), 1)), x, x[:, i] * x[:, j]])


@dataclass(frozen=True)
class Model:
    good: bytes
    bad: bytes
    middle: np.ndarray
    scale: np.ndarray
    weights: np.ndarray

    def scores(self, features: np.ndarray) -> np.ndarray:
        z = expanded(clipped((features - self.middle) / self.scale)) @ self.weights
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.3, rounds: int = 60) -> np.ndarray:
    """Weights by Newton's method; a step that doesn't lower the loss is halved."""
    penalty = np.full(x.shape[1], ridge)
    penalty[0] = 1e-3

    def loss(w):
        z = x @ w
        return np.logaddexp(0, z).sum() - y @ z + penalty @ w**2 / 2

    w = np.zeros(x.shape[1])
    now = loss(w)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        curve = (x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty)
        step = np.linalg.solve(curve, x.T @ (y - p) - penalty * w)
        size = 1.0
        while size > 1e-4 and loss(w + size * step) > now:
            size /= 2
        w, before, now = w + size * step, now, loss(w + size * step)
        if before - now < 1e-9:
            break
    return w


def dictionary_of(blocks: list[bytes], limit: int) -> bytes:
    """A dictionary of about `limit` bytes: zstandard's trained one where it can be trained and,
    before it, pieces of the blocks, of all of them or, where they are too many, of every so-manieth."""
    blocks = [b for b in blocks if b]
    if not blocks:
        return b""
    try:
        trained = zstandard.train_dictionary(limit // 2, blocks).as_bytes()
    except zstandard.ZstdError:
        trained = b""
    room = limit - len(trained)
    each = max(PIECE, room // len(blocks))
    n = min(len(blocks), room // each)
    chosen = [blocks[i * len(blocks) // n] for i in range(n)]
    return b"".join(c[max(0, len(c) - each) // 2 :][:each] for c in chosen) + trained


def labelled(labels: DataFrame, rows: int, id_col: str, label_col: str) -> list[tuple[int, int]]:
    """(id, label) of up to `rows` ids of each class, by the order of a hash of the id; null labels or
    ids and ids with two labels are left out. Sorted by label and id."""
    marked = (
        labels.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{label_col}`").alias("y"))
        .where("id is not null and y in (0, 1)")
        .groupBy("id").agg(F.min("y").alias("y"), F.max("y").alias("top")).where("y = top")
    )
    order = F.xxhash64("id", F.lit(17))
    chosen = [
        marked.where(F.col("y") == y).orderBy(order, "id").limit(rows).select("id", "y")
        for y in (0, 1)
    ]
    return sorted(((r.id, r.y) for r in chosen[0].unionByName(chosen[1]).collect()), key=lambda k: k[::-1])


def texts_of(docs: DataFrame, keys: list[tuple[int, int]], id_col: str, text_col: str) -> DataFrame:
    """(id, y, text) of at most 2 * rows ids; of an id's different texts, the first in order."""
    spark = docs.sparkSession
    known = spark.createDataFrame(keys, "id long, y int")
    chosen = id_and_text(docs, id_col, text_col).join(F.broadcast(known), "id")
    return chosen.groupBy("id", "y").agg(F.min("text").alias("text"))


def blocks_of(text: Column) -> Column:
    """`BLOCKS_PER_TEXT` blocks, evenly over the whole text."""
    raw = text.cast("binary")
    step = F.greatest(F.lit(1), F.ceil(F.length(raw) / F.lit(BLOCK * BLOCKS_PER_TEXT))) * BLOCK
    return F.transform(
        F.sequence(F.lit(0), F.lit(BLOCKS_PER_TEXT - 1)),
        lambda i: F.substring(raw, (i * step + 1).cast("int"), F.lit(BLOCK)),
    )


def fit(
    docs: DataFrame,
    labels: DataFrame,
    rows: int = ROWS_PER_CLASS,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
) -> Model:
    """Fit on at most `rows` labelled texts of each class. Every other one (by id order) goes into the
    dictionaries, with `BLOCKS_PER_TEXT` blocks; the rest calibrates, with the features of whole texts,
    which tasks work out. Without labels of both classes every score is the share of the one there is, or
    one half."""
    keys = labelled(labels, rows, id_col, label_col)
    sides: list[list] = [[], []]
    for y in (0, 1):
        for i, key in enumerate(k for k in keys if k[1] == y):
            sides[i % 2].append(key)
    blocks = texts_of(docs, sides[0], id_col, text_col).select("id", "y", blocks_of(F.col("text")).alias("blocks"))
    found = sorted(blocks.collect(), key=lambda r: (r.y, r.id))
    good, bad = (
        dictionary_of([bytes(b) for r in found if r.y == y for b in r.blocks], DICTIONARY_BYTES) for y in (1, 0)
    )
    measured = texts_of(docs, sides[1], id_col, text_col)
    measured = measured.select("id", "y", features_of(good, bad, F.col("text")).alias("x"))
    rest = sorted(measured.collect(), key=lambda r: (r.y, r.id))
    y = np.array([r.y for r in rest], float)
    if len(set(y)) < 2:
        constant = np.zeros(1 + FEATURES + FEATURES * (FEATURES + 1) // 2)
        seen = [r.y for r in found + rest]
        constant[0] = 0.0 if not seen else 3.0 * (2 * max(seen) - 1)
        return Model(good, bad, np.zeros(FEATURES), np.ones(FEATURES), constant)
    x = np.array([r.x for r in rest])
    middle, scale = x.mean(0), x.std(0) + 1e-9
    return Model(good, bad, middle, scale, logistic(expanded(clipped((x - middle) / scale)), y))


def features_of(good: bytes, bad: bytes, text: Column) -> Column:
    """The features of whole texts; null counts as empty."""
    compressors: list[Compressors] = []

    @F.arrow_udf("array<double>")
    def measured(texts: pa.Array) -> pa.Array:
        if not compressors:
            compressors.append(Compressors(good, bad))
        raw = texts.cast(pa.binary()).to_pylist()
        return pa.array([compressors[0].features(t or b"") for t in raw], pa.list_(pa.float64()))

    return measured(text)


def score_of(model: Model, text: Column) -> Column:
    """The score of a text; null counts as empty."""
    compressors: list[Compressors] = []

    @F.arrow_udf("double")
    def scored(texts: pa.Array) -> pa.Array:
        if not compressors:
            compressors.append(Compressors(model.good, model.bad))
        raw = texts.cast(pa.binary()).to_pylist()
        features = np.array([compressors[0].features(t or b"") for t in raw]).reshape(-1, FEATURES)
        return pa.array(model.scores(features), pa.float64())

    return scored(text)


def score(
    docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """`id` and `score` (0 to 1, higher: good likelier) of each row, in the table's own order.

    The whole text counts. A null or empty text has the score of sizes 0. Ids may be null or repeat;
    every row is scored on its own.
    """
    texts = id_and_text(docs, id_col, text_col)
    return texts.select("id", score_of(model, F.col("text")).alias("score"))


def keep_good(docs: DataFrame, model: Model, least: float = 0.5, text_col: str = "text") -> DataFrame:
    """The documents whose score is at least `least`."""
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    return docs.where(score_of(model, text) >= least)
