"""Repeated byte strings by enhanced suffix arrays over the places that can repeat.

Every string of `length` bytes has an anchor: its k-gram with the smallest hash. Equal strings have
equal anchors at the same place, so anchors that occur once belong to strings that occur once, and
anchors whose whole context (all strings that they anchor) is equal need no closer look: all but the
first one repeat. What is left, the different contexts of one anchor, meets in one task. There
a suffix array is built by prefix doubling, and a stack scan of its common-prefix intervals lists the
maximal repeats: strings whose occurrences differ in the byte before them and in the byte after.
Every occurrence of a maximal repeat but the first is removed. Equal strings never have different
anchors, so that an array holds as many anchors as make up a chunk; an anchor with more contexts than
that is divided by what its strings have in common around it.
"""

import hashlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import (
    CHUNK_BYTES,
    LAST,
    chunks,
    id_and_text,
    mix,
    partitions,
    prefix_hashes,
    salted_left_join,
    span_hashes,
    text_buffer,
    written,
)

LENGTH, K = 100, 24
_KNOWN = 1 << 7  # mark in a packed place: surely a repeat of an earlier one
ANCHORS = "hash long, context long, rank long, row long, place long"
WANTED = "row long, hash long, rank long, place long, again boolean"
CONTEXTS = "hash long, rank long, row long, start long, anchor long, context binary"
REMOVED = "row long, start long, stop long"


def _pack(at, before, after):
    """Anchor's place, bytes from the first string's start to it, from the last string's start."""
    return at << 16 | before << 8 | after


def _spans(places: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    before, after = (places >> 8) & 0x7F, places & 0xFF
    start = (places >> 16) - before
    return start, start + before - after + length


def anchors_of(buffer: np.ndarray, offsets: np.ndarray, length: int, k: int):
    """For each run of strings with the same anchor: row, anchor's hash, hash of the context, packed
    place within the row."""
    nothing = [np.zeros(0, np.int64)] * 4
    n = len(buffer) - length + 1
    if n <= 0:
        return nothing
    sums = prefix_hashes(buffer)
    starts = np.arange(len(buffer) - k + 1)
    hashes = span_hashes(sums, starts, starts + k)
    low = np.uint64(0xFFFFFFFF)
    least = (hashes & ~low) | starts.astype(np.uint64)  # ties: the leftmost
    width, done = length - k + 1, 1
    while 2 * done <= width:
        least = np.minimum(least[:-done], least[done:])
        done *= 2
    least = np.minimum(least[: n], least[width - done : width - done + n])
    row = np.searchsorted(offsets, np.arange(n), "right") - 1
    good = np.arange(n) + length <= offsets[row + 1]
    begin = np.flatnonzero(good)
    if not len(begin):
        return nothing
    at = (least[begin] & low).astype(np.int64)
    change = np.append(True, (at[1:] != at[:-1]) | (row[begin][1:] != row[begin][:-1]))
    first = begin[change]
    last = begin[np.append(np.flatnonzero(change)[1:] - 1, len(begin) - 1)]
    at, own = at[change], row[first]
    before, after = at - first, at - last
    context = mix(span_hashes(sums, first, last + length) + (before << 8 | after).astype(np.uint64))
    return [own, hashes[at].view(np.int64), context.view(np.int64), _pack(at - offsets[own], before, after)]


def _first_of_equal(hash_, context, rank, row, place):
    """Order by (hash, context, rank, row, place) and where a new hash and a new context begin."""
    order = np.lexsort((place, row, rank, context, hash_))
    h, c = hash_[order], context[order]
    new_hash = np.append(True, h[1:] != h[:-1])[: len(h)]
    return order, new_hash, new_hash | np.append(True, c[1:] != c[:-1])[: len(h)]


def _anchor(length: int, k: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[bytes, tuple] = {}
        for batch in batches:
            ranks, rows, shas = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            # Of the equal texts of a task only the first one, as far as is known, goes on.
            go = np.zeros(batch.num_rows, bool)
            for i, (rank, row, sha) in enumerate(zip(ranks.tolist(), rows.tolist(), shas)):
                if seen.get(sha, (LAST + 1,)) > (rank, row):
                    seen[sha] = (rank, row)
                    go[i] = True
            some = batch.filter(pa.array(go))
            ranks, rows = ranks[go], rows[go]
            buffer, offsets = text_buffer(some.column(3))
            for low, high in chunks(offsets):
                part = buffer[offsets[low] : offsets[high]]
                own, hash_, context, place = anchors_of(
                    part, offsets[low : high + 1] - offsets[low], length, k
                )
                rank, row = ranks[low:high][own], rows[low:high][own]
                order, _, new = _first_of_equal(hash_, context, rank, row, place)
                place, hash_ = place.copy(), hash_.copy()
                again = order[~new]
                place[again] |= _KNOWN << 8
                # A known repeat needs no owner: dealt out by its own place.
                spread = row[again].astype(np.uint64) << np.uint64(20) ^ place[again].astype(np.uint64)
                hash_[again] = mix(spread).view(np.int64)
                columns = [hash_, context, rank, row, place]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c.astype(np.int64)) for c in columns],
                    ["hash", "context", "rank", "row", "place"],
                )

    return work


def _columns(batches: Iterator[pa.RecordBatch], n: int) -> list[np.ndarray]:
    """Whole partition: its size follows the number of shuffle partitions."""
    parts = [[b.column(i).to_numpy(zero_copy_only=False) for i in range(n)] for b in batches]
    return [np.concatenate(c) for c in zip(*parts)] if parts else [np.zeros(0, np.int64)] * n


def _own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Anchors of one partition of hashes: known repeats, and contexts to be compared."""
    hash_, context, rank, row, place = _columns(batches, 5)
    known = (place >> 8) & _KNOWN != 0
    at = np.flatnonzero(~known)
    by_hash = at[np.argsort(hash_[at])]
    same = hash_[by_hash][1:] == hash_[by_hash][:-1]
    twice = np.zeros(len(hash_), bool)
    twice[by_hash[1:][same]] = twice[by_hash[:-1][same]] = True
    at = np.flatnonzero(twice)
    order, new_hash, new = _first_of_equal(hash_[at], context[at], rank[at], row[at], place[at])
    at = at[order]
    group = np.cumsum(new_hash) - 1
    classes = np.bincount(group, new) if len(at) else np.zeros(0)
    again = np.concatenate([np.flatnonzero(known), at[~new]])
    wanted = at[new & (classes[group] > 1)] if len(at) else at
    for places, mark in ((again, True), (wanted, False)):
        for i in range(0, len(places), 50_000):
            p = places[i : i + 50_000]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c[p]) for c in (row, hash_, rank, place & ~(_KNOWN << 8))]
                + [pa.array(np.full(len(p), mark))],
                ["row", "hash", "rank", "place", "again"],
            )


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows whose texts, in the second column, have about CHUNK_BYTES together."""
    for batch in batches:
        for low, high in chunks(text_buffer(batch.column(1))[1]):
            yield batch.slice(low, high - low)


def _cut(length: int):
    """Contexts out of the texts."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _slices(batches):
            out: list[tuple] = []
            for row, text, wanted in zip(*(part.column(i).to_pylist() for i in range(3))):
                raw = text.encode("utf-8", "surrogatepass")
                places = np.array([w["place"] for w in wanted], np.int64)
                starts, stops = _spans(places, length)
                at = ((places >> 16) - starts).tolist()
                for w, a, b, anchor in zip(wanted, starts.tolist(), stops.tolist(), at):
                    out.append((w["hash"], w["rank"], row, a, anchor, raw[a:b]))
            kinds = [pa.int64()] * 5 + [pa.binary()]
            columns = list(zip(*out)) or [()] * 6
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, kind) for c, kind in zip(columns, kinds)],
                ["hash", "rank", "row", "start", "anchor", "context"],
            )

    return work


def ranks_of(text: np.ndarray, left: np.ndarray, length: int) -> np.ndarray:
    """Rank of each place's first `length` bytes (where `left` bytes are enough) by prefix doubling."""
    n = len(text)
    padded = np.concatenate([text, np.zeros(8, np.uint8)]).astype(np.uint64)
    keys = np.zeros(n, np.uint64)
    depth = min(8, length)
    for i in range(depth):
        keys = keys << np.uint64(8) | padded[i : n + i]
    ranks = np.unique(keys, return_inverse=True)[1].astype(np.uint64)
    while depth < length:
        step = min(depth, length - depth)
        good = left >= depth + step
        keys = ranks[good] << np.uint64(32) | ranks[np.flatnonzero(good) + step]
        ranks = np.zeros(n, np.uint64)
        ranks[good] = np.unique(keys, return_inverse=True)[1].astype(np.uint64)
        depth += step
    return ranks


def common_prefix(a: bytes, b: bytes, least: int) -> int:
    """Length of the common prefix, known to be at least `least`."""
    low, high = least, min(len(a), len(b))
    while low < high:
        middle = (low + high + 1) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle - 1
    return low


def intervals(lcps: list[int], least: int):
    """Stack scan: (length, first, last) of every interval of suffixes (in suffix-array order, lcps[i]
    between i - 1 and i) with a common prefix of at least `least`, inner ones first."""
    stack: list[tuple[int, int]] = []  # length, first suffix
    for i in range(1, len(lcps) + 1):
        here, first = lcps[i] if i < len(lcps) else -1, i - 1
        while stack and stack[-1][0] > here:
            length, first = stack.pop()
            yield length, first, i - 1
        if here >= least and (not stack or stack[-1][0] < here):
            stack.append((here, first))


def maximal_repeats(contexts: list[bytes], length: int):
    """(length, [(context, start), ...]) of the repeats of at least `length` bytes whose occurrences
    differ in the byte before them or reach a context's start, with all their occurrences."""
    sizes = np.fromiter(map(len, contexts), np.int64, len(contexts))
    ends = np.cumsum(sizes)
    text = np.frombuffer(b"".join(contexts), np.uint8)
    owner = np.repeat(np.arange(len(contexts)), sizes)
    place = np.arange(len(text)) - (ends - sizes)[owner]
    left = sizes[owner] - place
    starts = np.flatnonzero(left >= length)
    if not len(starts):
        return
    ranks = ranks_of(text, left, length)[starts]
    array = starts[np.argsort(ranks, kind="stable")]
    ranks = np.sort(ranks)
    edges = np.flatnonzero(np.append(True, ranks[1:] != ranks[:-1]))
    before = np.where(place[array] == 0, -1, text[array - 1].astype(np.int64))
    low, high = np.minimum.reduceat(before, edges), np.maximum.reduceat(before, edges)
    counts = np.diff(np.append(edges, len(array)))
    # If all occurrences have the same byte before them, the repeat one byte longer covers them.
    for edge in np.flatnonzero((counts > 1) & ((low != high) | (low < 0))):
        group = array[edges[edge] : edges[edge] + counts[edge]].tolist()
        tails = [contexts[owner[s]][place[s] :] for s in group]
        order = sorted(range(len(group)), key=tails.__getitem__)
        lcps = [0] + [
            common_prefix(tails[a], tails[b], length) for a, b in zip(order, order[1:])
        ]
        found = [group[i] for i in order]
        bytes_before = [int(text[s - 1]) if place[s] else -1 - i for i, s in enumerate(found)]
        for size, a, b in intervals(lcps, length):
            if len(set(bytes_before[a : b + 1])) > 1:
                yield size, [(int(owner[s]), int(place[s])) for s in found[a : b + 1]]


def _whole_anchors(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[pa.Table]:
    """Rows in the order of their anchors' hashes, cut between anchors: several anchors with `limit`
    bytes of contexts at most, or a single one."""
    held: list[pa.RecordBatch] = []
    for batch in chain(batches, [None]):
        if batch is None:
            whole, held = held, []
        elif batch.num_rows == 0:
            continue
        else:
            hashes = batch.column(0).to_numpy()
            begins = not held or held[-1].column(0)[-1].as_py() != hashes[0]
            edges = np.flatnonzero(np.append(begins, hashes[1:] != hashes[:-1]))
            if not len(edges):
                held.append(batch)
                continue
            whole, held = [*held, batch.slice(0, edges[-1])], [batch.slice(edges[-1])]
        if not whole:
            continue
        table = pa.Table.from_batches(whole).combine_chunks()
        hashes = table.column(0).to_numpy()
        edges = np.flatnonzero(np.append(True, hashes[1:] != hashes[:-1])[: len(hashes)])
        edges = np.append(edges, len(hashes))
        _, offsets = text_buffer(table.column("context"))
        for i, j in chunks(offsets[edges], limit):
            yield table.slice(edges[i], edges[j] - edges[i])


def _hashes(buffer, starts, stops, at, low: int, high: int, length: int):
    """Hashes of pieces and of the bytes that their strings with `low` to `high` bytes before the
    anchor have in common."""
    outer, inner = np.zeros(len(at), np.uint64), np.zeros(len(at), np.uint64)
    edges = np.append(0, np.cumsum(stops - starts))
    for i, j in chunks(edges):
        own = edges[i : j + 1] - edges[i]
        moved = np.repeat(starts[i:j] - own[:-1], np.diff(own))
        sums = prefix_hashes(buffer[np.arange(own[-1]) + moved])
        where = at[i:j] - starts[i:j] + own[:-1]
        outer[i:j] = span_hashes(sums, own[:-1], own[1:])
        inner[i:j] = span_hashes(sums, where - low, where - high + length)
    return outer, inner


def divided(buffer: np.ndarray, offsets: np.ndarray, at: np.ndarray, length: int, k: int, limit: int):
    """The contexts of one anchor, which stands at `at` in the buffer, divided into pieces.

    The strings with the anchor in a range of places hold some bytes around it; pieces that differ
    there have no string in common, and of equal pieces all but the first one repeat. Ranges are
    halved until the pieces with the same bytes have `limit` bytes together at most. A range of one
    place has strings that are equal as a whole, so that this ends. Gives pairs of such repeats and a
    list of pieces to be compared, all as rows of (context, start, stop)."""
    begins, ends = offsets[:-1], offsets[1:]
    width, whole = length - k, np.arange(len(at))
    ranges = [(whole, 0, width // 2), (whole, width // 2 + 1, width)]
    while ranges:
        own, low, high = ranges.pop()
        least = np.maximum(low, at[own] + length - ends[own])
        most = np.minimum(high, at[own] - begins[own])
        some = least <= most
        own, least, most = own[some], least[some], most[some]
        starts, stops = at[own] - most, at[own] - least + length
        outer, inner = _hashes(buffer, starts, stops, at[own], low, high, length)
        outer = mix(outer + (least << 8 | most).astype(np.uint64))
        order = np.lexsort((own, outer, inner))
        pieces, outer, inner = np.stack([own, starts, stops])[:, order], outer[order], inner[order]
        new_group = np.append(True, inner[1:] != inner[:-1])[: len(own)]
        new = new_group | np.append(True, outer[1:] != outer[:-1])[: len(own)]
        group = (np.cumsum(new_group) - 1)[new]
        again, pieces = pieces[:, ~new], pieces[:, new]
        pieces = pieces[:, np.lexsort((pieces[0], group))]  # the first occurrence is the smallest again
        edges = np.append(np.flatnonzero(new_group[new]), pieces.shape[1])
        sizes = np.append(0, np.cumsum(pieces[2] - pieces[1]))[edges]
        several, large = np.diff(edges) > 1, np.diff(sizes) > limit
        for i in np.flatnonzero(several & large).tolist():
            part, middle = pieces[0, edges[i] : edges[i + 1]], (low + high) // 2
            ranges += [(part, low, middle), (part, middle + 1, high)]
        small = np.flatnonzero(several & ~large)
        sizes = np.append(0, np.cumsum(np.diff(sizes)[small]))
        parts = [
            np.concatenate([pieces[:, edges[g] : edges[g + 1]] for g in small[i:j].tolist()], axis=1)
            for i, j in chunks(sizes, limit)
        ]
        yield again, parts


def _repeat(length: int, k: int, limit: int = CHUNK_BYTES):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Rows come in the order of (hash, rank, row, start), so that the first occurrence is the smallest.
        for part in _whole_anchors(batches, limit):
            rows, starts, at = (part.column(c).to_numpy() for c in ("row", "start", "anchor"))
            buffer, offsets = text_buffer(part.column("context"))
            shift = starts - offsets[:-1]
            if len(buffer) <= limit:
                nothing, every = np.zeros((3, 0), np.int64), np.arange(len(rows))
                work_on = iter([(nothing, [np.stack([every, offsets[:-1], offsets[1:]])])])
            else:
                work_on = divided(buffer, offsets, offsets[:-1] + at, length, k, limit)
            for again, parts in work_on:
                found = [again]
                for own, begins, ends in parts:
                    contexts = [
                        buffer[a:b].tobytes() for a, b in zip(begins.tolist(), ends.tolist())
                    ]
                    best: dict[tuple[int, int], int] = {}
                    for size, occurrences in maximal_repeats(contexts, length):
                        first = min(occurrences)
                        for one in occurrences:
                            if one != first and best.get(one, 0) < size:
                                best[one] = size
                    piece, place = np.array([*best], np.int64).reshape(-1, 2).T
                    start = begins[piece] + place
                    stop = start + np.fromiter(best.values(), np.int64, len(best))
                    found.append(np.stack([own[piece], start, stop]))
                own, start, stop = np.concatenate(found, axis=1)
                for i in range(0, len(own), 50_000):
                    o = own[i : i + 50_000]
                    spans = (c[i : i + 50_000] + shift[o] for c in (start, stop))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c) for c in (rows[o], *spans)], ["row", "start", "stop"]
                    )

    return work


def merged(starts: np.ndarray, stops: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(starts, kind="stable")
    starts, reach = starts[order], np.maximum.accumulate(stops[order])
    new = np.append(True, starts[1:] > reach[:-1])
    return starts[new], reach[np.append(np.flatnonzero(new)[1:] - 1, len(reach) - 1)]


KEPT = "row long, removed array<struct<start:long,stop:long>>, n_removed long, kept_sha256 string"


def _keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in _slices(batches):
        spans, counts, shas = [], [], []
        lists = batch.column(2)
        edges = np.append(0, np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False)))
        flat = lists.flatten()
        all_starts, all_stops = (flat.field(i).to_numpy() for i in range(2))
        for i, text in enumerate(batch.column(1).to_pylist()):
            raw = text.encode("utf-8", "surrogatepass")
            starts, stops = merged(
                all_starts[edges[i] : edges[i + 1]], all_stops[edges[i] : edges[i + 1]]
            )
            spans.append([{"start": a, "stop": b} for a, b in zip(starts.tolist(), stops.tolist())])
            counts.append(int((stops - starts).sum()))
            kept, at = hashlib.sha256(), 0
            for a, b in zip(starts.tolist(), stops.tolist()):
                kept.update(raw[at:a])
                at = b
            kept.update(raw[at:])
            shas.append(kept.hexdigest())
        kind = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(spans, kind), pa.array(counts, pa.int64()), pa.array(shas, pa.string())],
            ["row", "removed", "n_removed", "kept_sha256"],
        )


def repeated_bytes(
    docs: DataFrame, length: int = LENGTH, k: int = K, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per document: `row`, `id`, `n_bytes`, `removed` (runs of bytes covered by a string of
    `length` bytes that also starts earlier), `n_removed` and `kept_sha256` (of what is left).

    Earlier is a smaller id, then a smaller row number (rows may share an id), then an earlier start;
    null ids come last. Null texts count as empty. Matches end with their documents. An empty table
    gives no rows. `length` is at most 127 more than `k`, which is smaller.
    """
    if not 0 < k < length <= k + 127:
        raise ValueError("k must be below length, and length at most k + 127")
    spark = docs.sparkSession
    parts = partitions(spark)
    raw = F.col("text").cast("binary")
    rows = written(
        id_and_text(docs, id_col, text_col).select(
            F.monotonically_increasing_id().alias("row"),
            "id",
            F.coalesce("id", F.lit(LAST)).alias("rank"),
            F.octet_length("text").cast("long").alias("n_bytes"),
            F.sha2(raw, 256).alias("sha"),
            "text",
        )
    )
    texts = rows.select("row", "text")
    anchors = rows.where(F.col("n_bytes") >= length).select("rank", "row", "sha", "text")
    owned = written(
        anchors.mapInArrow(_anchor(length, k), ANCHORS)
        .repartition(parts, "hash")
        .mapInArrow(_own, WANTED)
    )
    wanted = owned.where("not again").groupBy("row").agg(
        F.collect_list(F.struct("hash", "rank", "place")).alias("wanted")
    )
    contexts = texts.join(wanted, "row").select("row", "text", "wanted").mapInArrow(
        _cut(length), CONTEXTS
    )
    found = (
        contexts.repartition(parts, "hash")
        .sortWithinPartitions("hash", "rank", "row", "start")
        .mapInArrow(_repeat(length, k), REMOVED)
    )
    before = F.shiftright("place", 8).bitwiseAND(F.lit(0x7F))
    after = F.col("place").bitwiseAND(F.lit(0xFF))
    start = F.shiftright("place", 16) - before
    known = owned.where("again").select(
        "row", start.alias("start"), (start + before - after + length).alias("stop")
    )
    spans = (
        known.unionByName(found)
        .groupBy("row")
        .agg(F.collect_list(F.struct("start", "stop")).alias("spans"))
    )
    kept = texts.join(spans, "row").select("row", "text", "spans").mapInArrow(_keep, KEPT)

    # Copies of a whole text are removed whole.
    plain = rows.select("row", "id", "rank", "n_bytes", "sha")
    copies = (
        plain.where(F.col("n_bytes") >= length)
        .groupBy("sha")
        .agg(
            F.count("*").alias("n"),
            F.min(F.struct("rank", "row")).alias("first"),
        )
        .where("n > 1")
        .select("sha", F.col("first.row").alias("first_row"))
    )
    joined = salted_left_join(plain, copies, ["sha"]).join(kept, "row", "left")
    whole = F.col("first_row").isNotNull() & (F.col("first_row") != F.col("row"))
    empty = F.array().cast("array<struct<start:bigint,stop:bigint>>")
    all_of_it = F.array(F.struct(F.lit(0).cast("long").alias("start"), F.col("n_bytes").alias("stop")))
    return joined.select(
        "row",
        "id",
        "n_bytes",
        F.when(whole, all_of_it).otherwise(F.coalesce("removed", empty)).alias("removed"),
        F.when(whole, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
        F.when(whole, F.sha2(F.lit(""), 256)).otherwise(F.coalesce("kept_sha256", "sha")).alias("kept_sha256"),
    )
