"""Periodic runs of words: suffix classes united by falling common prefix.

A run is a stretch of words with smallest period p that no neighbouring word extends. Its first word i
and the word i + p start suffixes whose common prefix is the run's length less p. Suffixes are put into
classes by a union-find that takes the neighbours of the suffix array in falling order of their common
prefix; each class keeps its places in order. Where two classes meet at a common prefix l, a place and
its new neighbour at a distance p <= l start words of period p, and nothing between them does, so that p
is the smallest period. Such a pair is a run's seed if the word before doesn't extend it to the left.

Only texts in which some words come again, as many in a row as a seed needs, get a suffix array. A text
is a cell, so it is worked on as a whole; no two texts meet, and nothing is shuffled.
"""

from bisect import bisect_left, insort
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import chunks, id_and_text, mix, prefix_hashes, shingles, span_hashes, text_buffer

RESULT = (
    "id long, n_words long, runs array<struct<start:long,length:long,period:long>>, text string"
)
RUNS = pa.list_(pa.struct([(name, pa.int64()) for name in ("start", "length", "period")]))
# Classes of fewer places are put into a larger one place by place.
FEW = 64
# The bytes that part words.
SPACES = b" \t\n\v\f\r"


def suffix_array(words: np.ndarray) -> np.ndarray:
    """Starts of the suffixes in order, by prefix doubling; a suffix precedes what it begins."""
    n, width = len(words), 1
    rank = np.unique(words, return_inverse=True)[1].astype(np.int64)
    while True:
        after = np.zeros(n, np.int64)
        after[: max(n - width, 0)] = rank[width:] + 1
        key = rank * (n + 1) + after
        order = np.argsort(key, kind="stable")
        steps = np.diff(key[order]) != 0
        rank[order[1:]] = np.cumsum(steps)
        rank[order[0]] = 0
        if steps.all():
            return order
        width *= 2


def common_prefixes(words: list, order: np.ndarray) -> np.ndarray:
    """Common prefix of each suffix with the one before it in the order; 0 for the first."""
    n = len(words)
    before = np.full(n, -1, np.int64)
    before[order[1:]] = order[:-1]
    found, length = np.zeros(n, np.int64), 0
    for place, other in enumerate(before.tolist()):
        if other < 0:
            length = 0
            continue
        most = n - max(place, other)
        while length < most and words[place + length] == words[other + length]:
            length += 1
        found[place] = length
        length = max(length - 1, 0)
    return found[order]


def least_prefix(min_length: int, min_exponent: int) -> int:
    """The shortest common prefix that a seed of any period can have."""
    return min(
        max((min_exponent - 1) * p, min_length - p, 1) for p in range(1, max(min_length, 1) + 1)
    )


def seeds(order: np.ndarray, prefixes: np.ndarray, least: int) -> Iterator[tuple[int, int, int]]:
    """(i, j, common prefix) of places that become neighbours in a class, longest prefix first."""
    places = order.tolist()
    parent, members = list(range(len(places))), {}

    def root(k):
        while parent[k] != k:
            parent[k] = parent[parent[k]]
            k = parent[k]
        return k

    falling = np.argsort(-prefixes, kind="stable")
    falling = falling[: int((prefixes >= least).sum())]
    for k, length in zip(falling.tolist(), prefixes[falling].tolist(), strict=True):
        a, b = root(k - 1), root(k)
        large, small = members.pop(a, [places[a]]), members.pop(b, [places[b]])
        if len(large) < len(small):
            a, b, large, small = b, a, small, large
        for n, place in enumerate(small):
            at = bisect_left(large, place)
            # A neighbour of the larger class counts where none of the smaller one lies between.
            if at and (not n or small[n - 1] < large[at - 1]):
                yield large[at - 1], place, length
            if at < len(large) and (n + 1 == len(small) or large[at] < small[n + 1]):
                yield place, large[at], length
        if len(small) < FEW:
            for place in small:
                insort(large, place)
        else:
            large += small
            large.sort()
        parent[b], members[a] = a, large


def runs_of(words: list, min_length: int, min_exponent: int) -> list[tuple[int, int, int]]:
    """(start, length, period) of the runs of a list of words, by start and period."""
    least = least_prefix(min_length, min_exponent)
    if len(words) <= least:
        return []
    known = {}
    numbers = [known.setdefault(word, len(known)) for word in words]
    order = suffix_array(np.array(numbers, np.int64))
    found = []
    for i, j, length in seeds(order, common_prefixes(numbers, order), least):
        period = j - i
        if length < (min_exponent - 1) * period or length + period < min_length:
            continue
        if i == 0 or numbers[i - 1] != numbers[j - 1]:
            found.append((i, length + period, period))
    return sorted(found, key=lambda run: (run[0], run[2]))


def collapsed(words: list, runs: list) -> list:
    """Each run cut to its first period."""
    edges = [0] * (len(words) + 1)
    for start, length, period in runs:
        edges[start + period] += 1
        edges[start + length] -= 1
    inside, kept = 0, []
    for word, edge in zip(words, edges, strict=False):
        inside += edge
        if not inside:
            kept.append(word)
    return kept


def may_repeat(buffer: np.ndarray, offsets: np.ndarray, width: int) -> np.ndarray:
    """Which rows have some `width` words in a row twice; seldom one that has not."""
    space = np.zeros(256, bool)
    space[list(SPACES)] = True
    inside = np.zeros(len(buffer) + 2, bool)
    inside[1:-1] = ~space[buffer]
    begins = inside[1:-1] & ~inside[:-2]
    ends = inside[1:-1] & ~inside[2:]
    edges = offsets[(offsets > 0) & (offsets < len(buffer))]
    begins[edges] |= inside[1:-1][edges]
    ends[edges - 1] |= inside[1:-1][edges - 1]
    starts = np.flatnonzero(begins)
    hashes = span_hashes(prefix_hashes(buffer), starts, np.flatnonzero(ends) + 1)
    spans = shingles(hashes, width)
    row = np.searchsorted(offsets, starts, "right") - 1
    whole = row[: len(spans)] == row[width - 1 :][: len(spans)]
    spans, row = spans[whole], row[: len(spans)][whole]
    keys = mix(spans ^ mix(row.astype(np.uint64) + np.uint64(1)))
    by_key = np.argsort(keys, kind="stable")
    again = by_key[1:][keys[by_key][1:] == keys[by_key][:-1]]
    found = np.zeros(len(offsets) - 1, bool)
    found[row[again]] = True
    return found


def periodic_runs(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_length: int = 6,
    min_exponent: int = 4,
    rewrite: Callable[[int | None, list[bytes]], list[bytes]] | None = None,
) -> DataFrame:
    """One row per text: id, n_words, its runs by start and period, and the text without what any run
    holds beyond its first period, words joined by one space.

    Words are parted by space, tab, line feed, vertical tab, form feed and carriage return. A run has
    `min_length` words and `min_exponent` (2 or more) periods at least, the last one perhaps cut short.
    `rewrite`, if given, gets a row's id and words and returns the words to be judged; it must run on
    executors. Rows are judged one by one: repeated rows and ids each give a row, a null id stays null, a
    null or empty text has no words and no runs. A text is a cell, so a very long one is one task's work.
    """
    if min_exponent < 2:
        raise ValueError("a run has two periods at least")
    least = least_prefix(min_length, min_exponent)

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            buffer, offsets = text_buffer(batch["text"])
            ids = batch["id"]
            for first, last in chunks(offsets):
                low, high = offsets[first], offsets[last]
                part = offsets[first : last + 1] - low
                repeats = may_repeat(buffer[low:high], part, least)
                raw, counts, runs, texts = buffer[low:high].tobytes(), [], [], []
                for row in range(last - first):
                    words = raw[part[row] : part[row + 1]].split()
                    again = repeats[row]
                    if rewrite is not None:
                        given, words = words, rewrite(ids[first + row].as_py(), words)
                        again = again or words is not given
                    found = runs_of(words, min_length, min_exponent) if again else []
                    counts.append(len(words))
                    runs.append([dict(zip(("start", "length", "period"), r)) for r in found])
                    texts.append(b" ".join(collapsed(words, found) if found else words))
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.slice(first, last - first),
                        pa.array(counts, pa.int64()),
                        pa.array(runs, RUNS),
                        pa.array(texts, pa.binary()).view(pa.string()),
                    ],
                    ["id", "n_words", "runs", "text"],
                )

    return id_and_text(df, id_col, text_col).mapInArrow(judged, RESULT)
