"""Near duplicates by Order MinHash.

Each k-mer of words is labelled with how often it occurred before in its text. Each of several hash
functions picks the few smallest labelled k-mers and keeps them in text order; texts with an equal
pick are candidates. Within a bucket of equal picks a text is compared with the bucket's first text
and with its neighbour in the order of the next picks, which puts the most alike side by side; the
texts that are not connected with the bucket's first one are then compared in the same way among
themselves. These two passes cost up to 4 n comparisons in a bucket of n texts.

What they leave in several components of one bucket is joined exactly: two texts that are similar
enough share one of their rarest labelled k-mers (`overlapping`), so every pair of a bucket is
compared, known to be connected, or ruled out by its k-mers.

A comparison aligns the two k-mer sequences in a band that is as wide as the threshold allows; the
similarity is the share of aligned k-mers among all of both.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapsync.operators.ordering import with_previous

from .common import (
    LAST,
    chunks,
    extended,
    id_and_text,
    mix,
    prefix_hashes,
    restored,
    salted_left_join,
    shingles,
    span_hashes,
    text_buffer,
    words_of,
    written,
)
from .components import components

K, SIMILARITY = 5, 0.8
FUNCTIONS, PICKED = 16, 3
PIECE = 256  # texts of one k-mer that meet all others of it in one task
TOKENS = "node long, component long, n long, token long"
SKETCHED = "row long, id long, high long, low long, n long, picks array<long>, text string"
_SEEDS = mix(np.arange(1, 2 * FUNCTIONS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_FULL = np.uint64(0xFFFFFFFFFFFFFFFF)


def kmers_of(hashes: np.ndarray, first: np.ndarray, k: int = K):
    """k-mer hashes of each row in text order and the first of each row (n + 1 places); a row of
    fewer than k words has one k-mer of all its words."""
    sizes = np.diff(first)
    counts = np.where(sizes >= k, sizes - k + 1, np.minimum(sizes, 1))
    out_first = np.concatenate([[0], np.cumsum(counts)])
    rows = np.repeat(np.arange(len(sizes)), counts)
    places = first[rows] + np.arange(len(rows)) - out_first[rows]
    out = np.zeros(len(rows), np.uint64)
    whole = sizes[rows] >= k
    out[whole] = shingles(hashes, k)[places[whole]]
    for width in range(1, k):
        short = sizes[rows] == width
        if short.any():
            out[short] = shingles(hashes, width)[places[short]]
    return out, rows, out_first


def labelled(kmers: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Hashes of (k-mer, number of its earlier occurrences in the row)."""
    keys = mix(kmers + rows.astype(np.uint64) * np.uint64(0xD1B54A32D192ED03))
    order = np.argsort(keys)
    same = keys[order][1:] == keys[order][:-1]
    label = np.zeros(len(keys), np.uint64)
    if same.any():
        part = np.zeros(len(keys), bool)
        part[1:] |= same
        part[:-1] |= same
        own = order[part]
        own = own[np.lexsort((own, keys[own]))]
        starts = np.flatnonzero(np.append(True, keys[own][1:] != keys[own][:-1]))
        nth = np.arange(len(own)) - np.repeat(starts, np.diff(np.append(starts, len(own))))
        label[own] = nth.astype(np.uint64)
    return mix(kmers + label * np.uint64(0xA0761D6478BD642F))


def picks_of(marked: np.ndarray, first: np.ndarray) -> np.ndarray:
    """For each row and hash function the hash of its smallest labelled k-mers in text order."""
    counts = np.diff(first)
    full = np.flatnonzero(counts)
    out = np.zeros((len(counts), FUNCTIONS), np.uint64)
    if not len(full):
        return out
    starts, sizes = first[:-1][full], counts[full]
    for f in range(FUNCTIONS):
        g = mix(marked * (_SEEDS[2 * f] | np.uint64(1)) + _SEEDS[2 * f + 1])
        places = np.full((len(full), PICKED), LAST)
        for i in range(PICKED):
            least = np.minimum.reduceat(g, starts)
            at = np.flatnonzero(g == np.repeat(least, sizes))
            row = np.searchsorted(starts, at, "right") - 1
            keep = (least[row] != _FULL) & np.append(True, row[1:] != row[:-1])
            places[row[keep], i] = at[keep]
            g[at] = _FULL
        places.sort(axis=1)
        pick = np.full(len(full), np.uint64(f))
        for i in range(PICKED):
            there = places[:, i] != LAST
            value = marked[np.where(there, places[:, i], 0)]
            pick = mix(pick * np.uint64(0x9E3779B97F4A7C15) + np.where(there, value, np.uint64(1)))
        out[full, f] = pick
    return out


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        buffer, offsets = text_buffer(batch.column(2))
        for low, high in chunks(offsets):
            part = buffer[offsets[low] : offsets[high]]
            folded, starts, ends, first = words_of(part, offsets[low : high + 1] - offsets[low])
            hashes = span_hashes(prefix_hashes(folded), starts, ends)
            kmers, rows, kfirst = kmers_of(hashes, first)
            picks = picks_of(labelled(kmers, rows), kfirst)
            sums = [_sequence(hashes, first, seed) for seed in (3, 5)]
            some = batch.slice(low, high - low)
            flat = pa.array(picks.ravel().view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [
                    some.column(0),
                    some.column(1),
                    pa.array(sums[0]),
                    pa.array(sums[1]),
                    pa.array(np.diff(kfirst)),
                    pa.ListArray.from_arrays(
                        np.arange(0, picks.size + 1, FUNCTIONS, dtype=np.int32), flat
                    ),
                    *some.columns[2:],
                ],
                [c.split()[0] for c in SKETCHED.split(", ")] + batch.schema.names[3:],
            )


def _sequence(hashes: np.ndarray, first: np.ndarray, seed: int) -> np.ndarray:
    """Half of a 128-bit hash of each row's sequence of words."""
    place = (np.arange(len(hashes)) - np.repeat(first[:-1], np.diff(first))).astype(np.uint64)
    each = mix(hashes * np.uint64(2 * seed + 1) + mix(place + np.uint64(seed)))
    sums = np.zeros(len(hashes) + 1, np.uint64)
    np.cumsum(each, out=sums[1:])
    return mix(sums[first[1:]] - sums[first[:-1]] + np.diff(first).astype(np.uint64)).view(np.int64)


def band_width(n: int, m: int, similarity: float) -> int:
    """How far an alignment of that similarity can leave the diagonal: it has at least
    s (n + m) / (1 + s) matches, so no more than the rest can be unmatched."""
    matches = int(np.ceil(similarity * (n + m) / (1 + similarity) - 1e-9))
    return n + m - 2 * matches


def banded_matches(a: list, b: list, band: int) -> int:
    """Length of the longest common subsequence within `band` of the diagonal, all columns of a row
    at once: a zero bit of `v` stands for a column at which the length grows."""
    where: dict = {}
    for j, y in enumerate(b):
        where[y] = where.get(y, 0) | 1 << j
    width = 2 * band + 1
    mask = (1 << width) - 1
    v, low, passed = mask, 0, 0
    for i, x in enumerate(a):
        if i > band:
            passed += not v & 1
            v = v >> 1 | 1 << width - 1
            low += 1
        u = v & (where.get(x, 0) >> low)
        if u:
            v = ((v + u) | (v - u)) & mask
    columns = min(width, max(0, len(b) - low))
    return passed + columns - (v & ((1 << columns) - 1)).bit_count()


def similarity_of(a: np.ndarray, b: np.ndarray, least: float = SIMILARITY) -> float:
    """Share of aligned k-mers among all of both sequences; 0 where it can't reach `least`."""
    n, m = len(a), len(b)
    if not n or not m or min(n, m) < least * max(n, m):
        return 0.0
    band = band_width(n, m, least)
    short = min(n, m)
    unlike = np.flatnonzero(a[:short] != b[:short])
    head = int(unlike[0]) if len(unlike) else short
    rest = short - head
    unlike = np.flatnonzero(a[n - rest :][::-1] != b[m - rest :][::-1]) if rest else []
    tail = int(unlike[0]) if len(unlike) else rest
    a, b = a[head : n - tail], b[head : m - tail]
    need = least * (n + m) / (1 + least) - head - tail
    if min(len(a), len(b)) < need or (need > 0 and _common(a, b) < need):
        return 0.0
    matches = head + tail + banded_matches(a.tolist(), b.tolist(), band)
    found = matches / (n + m - matches)
    return found if found >= least - 1e-12 else 0.0


def _common(a: np.ndarray, b: np.ndarray) -> int:
    """Number of k-mers that both have, by their counts."""
    keys, counts = np.unique(np.concatenate([a, b]), return_counts=True)
    own, of_a = np.unique(a, return_counts=True)
    in_a = np.zeros(len(keys), np.int64)
    in_a[np.searchsorted(keys, own)] = of_a
    return int(np.minimum(in_a, counts - in_a).sum())


def _verify(least: float):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sides = [text_buffer(batch.column(column)) for column in (2, 3)]
            # Both texts of a pair are in one chunk: the hashes take many times the bytes of the texts.
            for low, high in chunks(sides[0][1] + sides[1][1]):
                pairs = zip(*[_kmer_rows(*side, low, high) for side in sides])
                found = [similarity_of(a, b, least) for a, b in pairs]
                some = batch.slice(low, high - low)
                yield pa.RecordBatch.from_arrays(
                    [some.column(0), some.column(1), pa.array(found, pa.float64())],
                    ["a", "b", "similarity"],
                )

    return work


def _kmer_rows(buffer: np.ndarray, offsets: np.ndarray, low: int, high: int) -> list[np.ndarray]:
    """The k-mers of each of some rows."""
    part = buffer[offsets[low] : offsets[high]]
    folded, starts, ends, first = words_of(part, offsets[low : high + 1] - offsets[low])
    kmers, _, kfirst = kmers_of(span_hashes(prefix_hashes(folded), starts, ends), first)
    return [kmers[kfirst[i] : kfirst[i + 1]] for i in range(len(kfirst) - 1)]


def verified(pairs: DataFrame, bodies: DataFrame, least: float) -> DataFrame:
    """The pairs (a, b) whose texts are similar enough."""
    one = pairs.join(bodies.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a")
    both = one.join(bodies.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b")
    found = both.select("a", "b", "text_a", "text_b").mapInArrow(
        _verify(least), "a long, b long, similarity double"
    )
    return found.where("similarity > 0")


def candidates(buckets: DataFrame) -> DataFrame:
    """Distinct pairs of each bucket's members with its first one and with their neighbours in the
    order of the next picks; `buckets` holds (bucket, node, n, next) and, if known, a component."""
    leaders = buckets.groupBy("bucket").agg(F.min("node").alias("leader"), F.count("*").alias("size"))
    members = buckets.join(leaders.where("size > 1"), "bucket")
    # In ranges of the order, so that a large bucket is not one task.
    chained = with_previous(members, ["bucket"], ["next", "node"], F.col("node"), "before")
    return (
        chained.select("node", F.explode(F.array("leader", "before.value")).alias("other"))
        .where("other is not null and other != node")
        .select(F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b"))
        .distinct()
    )


def _tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        buffer, offsets = text_buffer(batch.column(2))
        for low, high in chunks(offsets):
            part = buffer[offsets[low] : offsets[high]]
            folded, starts, ends, first = words_of(part, offsets[low : high + 1] - offsets[low])
            hashes = span_hashes(prefix_hashes(folded), starts, ends)
            kmers, rows, kfirst = kmers_of(hashes, first)
            some, places = batch.slice(low, high - low), pa.array(rows)
            yield pa.RecordBatch.from_arrays(
                [
                    some.column(0).take(places),
                    some.column(1).take(places),
                    pa.array(np.diff(kfirst)[rows]),
                    pa.array(labelled(kmers, rows).view(np.int64)),
                ],
                [c.split()[0] for c in TOKENS.split(", ")],
            )


def overlapping(texts: DataFrame, similarity: float) -> DataFrame:
    """Distinct pairs (a, b) of different components (ca, cb) that can be similar enough by their
    labelled k-mers; `texts` holds (node, component, text).

    Two texts of n and m k-mers need s (n + m) / (1 + s) in common, at least s n. In the order from
    rare to common k-mers, the first of these is among the first n - s n + 1 of both; no more are
    left after it than that text has. K-mers of a single component come first and need no place.
    """
    tokens = written(texts.select("node", "component", "text").mapInArrow(_tokens, TOKENS))
    across = (
        tokens.groupBy("token")
        .agg(
            F.count("*").alias("texts"),
            F.min("component").alias("low"),
            F.max("component").alias("high"),
        )
        .where("low != high")
        .select("token", "texts")
    )
    size, need = F.size("shared"), F.ceil(F.col("n") * similarity - 1e-9).cast("int")
    prefixes = (
        tokens.join(across, "token")
        .groupBy("node", "component", "n")
        .agg(F.array_sort(F.collect_list(F.struct("texts", "token"))).alias("shared"))
        .where(size >= need)
        .select(
            "node",
            "component",
            "n",
            size.alias("size"),
            F.posexplode(F.slice("shared", F.lit(1), size - need + 1)).alias("at", "k"),
        )
        .select("node", "component", "n", (F.col("size") - F.col("at")).alias("left"), "k.token")
    )
    prefixes = written(prefixes)
    pieces = (
        prefixes.groupBy("token")
        .agg(
            F.ceil(F.count("*") / PIECE).cast("int").alias("pieces"),
            F.min("component").alias("low"),
            F.max("component").alias("high"),
        )
        .where("low != high")
        .select("token", "pieces")
    )
    # A common k-mer's texts are dealt out on one side and copied on the other.
    dealt = written(prefixes.join(pieces, "token"))
    one = dealt.withColumn("piece", F.pmod(F.xxhash64("node"), F.col("pieces")).cast("int"))
    all_ = dealt.withColumn("piece", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)))
    enough = similarity / (1 + similarity) * (F.col("x.n") + F.col("y.n")) - 1e-6
    return (
        one.alias("x")
        .join(
            all_.alias("y"),
            (F.col("x.token") == F.col("y.token"))
            & (F.col("x.piece") == F.col("y.piece"))
            & (F.col("x.node") < F.col("y.node"))
            & (F.col("x.component") != F.col("y.component"))
            & (F.least("x.left", "y.left") >= enough),
        )
        .select(
            F.col("x.node").alias("a"),
            F.col("y.node").alias("b"),
            F.least("x.component", "y.component").alias("ca"),
            F.greatest("x.component", "y.component").alias("cb"),
        )
        .distinct()
    )


def _ends(names: DataFrame) -> list[DataFrame]:
    return [names.select(F.col("node").alias(x), F.col("component").alias(f"c{x}")) for x in "ab"]


def _linked(names: DataFrame, links: DataFrame) -> DataFrame:
    """The components (node, component) after further links (a, b) between any nodes."""
    # The graph of the links has the components so far as its nodes.
    one, other = _ends(names)
    ends = links.join(one, "a", "left").join(other, "b", "left")
    joined = components(
        ends.select(F.coalesce("ca", "a").alias("a"), F.coalesce("cb", "b").alias("b"))
    ).withColumnRenamed("component", "joined")
    names = names.unionByName(
        joined.select("node", F.col("node").alias("component")).join(names, "node", "left_anti")
    )
    return written(
        names.join(joined.withColumnRenamed("node", "component"), "component", "left").select(
            "node", F.coalesce("joined", "component").alias("component")
        )
    )


def _placed(buckets: DataFrame, names: DataFrame) -> DataFrame:
    return buckets.join(names, "node", "left").withColumn(
        "component", F.coalesce("component", "node")
    )


def _finished(
    buckets: DataFrame, names: DataFrame, bodies: DataFrame, similarity: float
) -> DataFrame:
    """The components when all pairs of each bucket are compared, connected or ruled out."""
    placed = _placed(buckets, names)
    mixed = placed.groupBy("bucket").agg(
        F.min("component").alias("low"), F.max("component").alias("high")
    )
    left = placed.join(mixed.where("low != high").select("bucket"), "bucket")
    left = left.select("node", "component").distinct()
    pairs = written(overlapping(left.join(bodies, "node"), similarity))
    if pairs.isEmpty():
        return names
    # One pair of each two components first, as its link settles all the others.
    first = pairs.groupBy("ca", "cb").agg(F.min(F.struct("a", "b")).alias("p")).select("p.a", "p.b")
    first = written(first)
    names = _linked(names, verified(first, bodies, similarity))
    one, other = _ends(names)
    rest = pairs.select("a", "b").join(first, ["a", "b"], "left_anti")
    rest = rest.join(one, "a", "left").join(other, "b", "left")
    rest = written(rest.where(F.coalesce("ca", "a") != F.coalesce("cb", "b")).select("a", "b"))
    if rest.isEmpty():
        return names
    return _linked(names, verified(rest, bodies, similarity))


def near_duplicates(
    docs: DataFrame,
    similarity: float = SIMILARITY,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per document: `row` (its number), `id`, `class_id` (smallest id of its group),
    `group_size` and `kept` (one row of each group).

    Groups are connected by links between texts of similar k-mer sequences; texts with equal word
    sequences are copies and always one group, so all texts without words are one. A null id comes
    after all others. Rows with equal ids are documents of their own. An empty table gives no rows.
    """
    return _classes(_sketched(id_and_text(docs, id_col, text_col)), similarity)


def drop_near_duplicates(
    docs: DataFrame,
    similarity: float = SIMILARITY,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """The documents without those that `near_duplicates` does not keep."""
    rows = _sketched(id_and_text(docs, id_col, text_col, carry=True))
    dropped = _classes(rows, similarity).where(~F.col("kept")).select("row")
    return restored(rows.join(dropped, "row", "left_anti"), docs, text_col)


def _sketched(texts: DataFrame) -> DataFrame:
    numbered = texts.select(F.monotonically_increasing_id().alias("row"), *texts.columns)
    kind = extended(SKETCHED, texts, [c for c in texts.columns if c == "rest"])
    return written(numbered.mapInArrow(_sketch, kind))


def _classes(rows: DataFrame, similarity: float) -> DataFrame:
    # Texts of equal words are one node, named by its first row.
    order = F.coalesce("id", F.lit(LAST))
    copies = rows.groupBy("high", "low").agg(
        F.min("row").alias("node"),
        F.min(order).alias("first_id"),
        F.min_by("row", order).alias("first_row"),
        F.count("*").alias("copies"),
    )
    copies = written(copies)
    nodes = rows.join(copies.select(F.col("node").alias("row")), "row").where("n > 0")
    nodes = nodes.select(F.col("row").alias("node"), "picks")
    # The order within a bucket follows the picks of the next functions.
    picks = F.col("picks")
    after = [F.array(*[picks[(f + i) % FUNCTIONS] for i in (1, 2, 3)]) for f in range(FUNCTIONS)]
    each = F.explode(
        F.array(*[F.struct(picks[f].alias("bucket"), after[f].alias("next")) for f in range(FUNCTIONS)])
    )
    buckets = nodes.select("node", each.alias("b")).select("b.bucket", "node", "b.next")
    shared = buckets.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1")
    buckets = written(buckets.join(shared.select("bucket"), "bucket"))
    wanted = buckets.select(F.col("node").alias("row")).distinct()
    bodies = written(
        rows.select("row", "text").join(wanted, "row").withColumnRenamed("row", "node")
    )

    edges = written(verified(candidates(buckets), bodies, similarity))
    names = components(edges)
    # Members of another component than their bucket's first one are compared among themselves.
    placed = _placed(buckets, names)
    leaders = placed.groupBy("bucket").agg(F.min_by("component", "node").alias("leading"))
    rest = placed.join(leaders, "bucket").where("component != leading")
    more = verified(candidates(written(rest.select("bucket", "node", "next"))), bodies, similarity)
    names = _finished(buckets, _linked(names, more), bodies, similarity)

    named = copies.join(names, "node", "left").withColumn(
        "component", F.coalesce("component", "node")
    )
    groups = named.groupBy("component").agg(
        F.min("first_id").alias("class_id"),
        F.min_by("first_row", "first_id").alias("keep_row"),
        F.sum("copies").alias("group_size"),
    ).where("group_size > 1")
    classes = named.select("high", "low", F.col("node").alias("row"), "component")
    classes = salted_left_join(classes, groups, ["component"]).where("group_size is not null")
    joined = salted_left_join(
        rows.select("row", "id", "high", "low"), classes.drop("row", "component"), ["high", "low"]
    )
    single = F.col("group_size").isNull()
    return joined.select(
        "row",
        "id",
        F.when(single, F.col("id")).otherwise(F.nullif("class_id", F.lit(LAST))).alias("class_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        (single | (F.col("row") == F.col("keep_row"))).alias("kept"),
    )
