import random
import re
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from snapsync.llm import common, neardup
from snapsync.llm.components import components

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def kmers(text):
    w = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return [tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))] if w else []


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b):
            last, row[j + 1] = row[j + 1], last + 1 if x == y else max(row[j + 1], row[j])
    return row[-1]


def alike(a, b):
    if a == b:
        return True
    if not a or not b or min(len(a), len(b)) < 0.8 * max(len(a), len(b)):
        return False
    n = lcs(a, b)
    return n >= 0.8 * (len(a) + len(b) - n) - 1e-9


def plain(texts):
    seqs = [kmers(t) for t in texts]
    name = list(range(len(texts)))

    def root(i):
        while name[i] != i:
            i = name[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            if alike(seqs[i], seqs[j]):
                a, b = sorted((root(i), root(j)))
                name[b] = a
    return [root(i) for i in range(len(texts))]


def made(seed):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    texts = [None, "", "...", "one", "One!", "a b c", "a b d", "a b c d e", "A, b c d e", "x" * 50_000]
    for _ in range(12):
        base = rng.choices(words, k=rng.randrange(40, 260))
        texts.append(" ".join(base))
        for _ in range(rng.randrange(4)):
            copy = list(base)
            for _ in range(rng.randrange(1 + len(copy) // 40)):
                at = rng.randrange(len(copy))
                copy[at : at + rng.randrange(2)] = rng.choices(words, k=rng.randrange(2))
            texts.append(" ".join(copy))
        texts.append(" ".join(reversed(base)))
    texts += ["same words again and again " * 30, "same words again and again " * 31, "same words again " * 40]
    return texts


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_all_pairs(documents, seed):
    texts = made(seed)
    want = plain(texts)
    rows = neardup.near_duplicates(documents(texts)).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert r.class_id == want[r.id], texts[r.id]
        assert r.group_size == want.count(want[r.id])
        assert r.kept == (r.id == r.class_id)


def test_hot_group_chain_and_common_passage(documents):
    rng = random.Random(4)
    words = [f"v{i}" for i in range(3000)]
    base = rng.choices(words, k=150)
    texts = []
    for i in range(120):  # near copies of one text
        copy = list(base)
        copy[rng.randrange(150)] = f"edit{i}"
        texts.append(" ".join(copy))
    chain = rng.choices(words, k=150)
    for i in range(12):  # each like the one before, the last unlike the first
        chain = list(chain)
        chain[12 * i] = f"step{i}"
        texts.append(" ".join(chain))
    passage = rng.choices(words, k=60)
    for i in range(60):  # one passage in texts of their own
        texts.append(" ".join(rng.choices(words, k=50) + passage + rng.choices(words, k=50)))
    rows = {r.id: r for r in neardup.near_duplicates(documents(texts)).collect()}
    assert {rows[i].class_id for i in range(120)} == {0}
    assert {rows[i].class_id for i in range(120, 132)} == {120}
    assert all(rows[i].group_size == 1 for i in range(132, 192))


def families(seed, n, variants):
    """Families of texts with one template; variants of a text are about 0.8 alike or just below."""
    rng = random.Random(seed)
    template, texts = [f"t{i}" for i in range(84)], []
    for f in range(n):
        own = [f"f{f}x{i}" for i in range(16)]
        for v in range(variants):
            copy = template[:42] + own + template[42:]
            for e in range(rng.choice([1, 2])):
                copy[rng.randrange(len(copy))] = f"e{f}x{v}x{e}"
            texts.append(" ".join(copy))
    rng.shuffle(texts)
    return texts


def can_be_alike(a, b):
    n = sum((Counter(a) & Counter(b)).values())
    return n >= 0.8 * (len(a) + len(b) - n) - 1e-9


@pytest.mark.parametrize("seed, n, variants", [(2, 150, 3), (3, 250, 2)])
def test_families_with_one_template(documents, seed, n, variants):
    texts = families(seed, n, variants)
    seqs = [kmers(t) for t in texts]
    links = [
        (a, b)
        for b in range(len(texts))
        for a in range(b)
        if can_be_alike(seqs[a], seqs[b]) and alike(seqs[a], seqs[b])
    ]
    found = {r.id: r.class_id for r in neardup.near_duplicates(documents(texts)).collect()}
    assert [(a, b) for a, b in links if found[a] != found[b]] == []
    parts = {i: i for i in range(len(texts))}
    for a, b in links:
        low, high = sorted((parts[a], parts[b]))
        parts = {i: low if p == high else p for i, p in parts.items()}
    assert found == parts


def test_pairs_of_a_common_kmer_in_pieces(documents, spark, monkeypatch):
    monkeypatch.setattr(neardup, "PIECE", 7)
    texts = families(1, 20, 3)
    seqs = [kmers(t) for t in texts]
    documents([])
    rows = [(i, i, t) for i, t in enumerate(texts)]
    frame = spark.createDataFrame(rows, "node long, component long, text string")
    found = [(r.a, r.b) for r in neardup.overlapping(frame, 0.8).collect()]
    assert len(found) == len(set(found))
    want = {(a, b) for b in range(len(texts)) for a in range(b) if can_be_alike(seqs[a], seqs[b])}
    assert want and want <= set(found)


def test_alignment_equals_plain_one():
    rng = random.Random(9)
    for _ in range(400):
        a = rng.choices(range(12), k=rng.randrange(1, 40))
        b = list(a)
        for _ in range(rng.randrange(6)):
            at = rng.randrange(len(b) + 1)
            b[at : at + rng.randrange(2)] = rng.choices(range(12), k=rng.randrange(2))
        got = neardup.banded_matches(a, b, len(a) + len(b))
        assert got == lcs(a, b)
        n = lcs(a, b)
        want = n / (len(a) + len(b) - n)
        found = neardup.similarity_of(np.array(a, np.uint64), np.array(b, np.uint64))
        assert found == pytest.approx(want if b and want >= 0.8 else 0.0)


def test_memory_of_compared_pairs():
    """It follows the chunk, not the batch; chunks neither lose nor mix up pairs."""
    rng = random.Random(7)
    words = [f"w{i}" for i in range(900)]
    texts = [" ".join(rng.choices(words, k=500)) for _ in range(40)]
    texts[3], texts[5] = "", " ".join(rng.choices(words, k=5000))
    edited = [t.replace("w1 ", "other ", 1) for t in texts]
    pairs = [(a, b) for a in range(40) for b in {a, (a + 1) % 40}] * 60
    columns = [[a for a, _ in pairs], [b for _, b in pairs]]
    batch = pa.RecordBatch.from_arrays(
        [*map(pa.array, columns), pa.array([texts[a] for a, _ in pairs]), pa.array([edited[b] for _, b in pairs])],
        ["a", "b", "text_a", "text_b"],
    )
    common._powers.cache_clear()
    tracemalloc.start()
    try:
        found = pa.Table.from_batches(neardup._verify(0.8)([batch.slice(1), batch.slice(0, 0)]))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert batch.nbytes > 16 << 20 and peak < 100 << 20
    rows = found.to_pylist()
    assert [(r["a"], r["b"]) for r in rows] == pairs[1:]
    for r in rows[:100]:
        want = neardup.similarity_of(*[
            neardup._kmer_rows(*common.text_buffer(pa.array([t])), 0, 1)[0] for t in (texts[r["a"]], edited[r["b"]])
        ])
        assert r["similarity"] == want and (want > 0) == (r["a"] == r["b"] != 3)


def test_null_repeated_and_clashing(documents, spark):
    rows = [(None, "a b c d e f"), (None, "a b c d e f"), (3, "a b c d e f"), (3, "q r s t u v"), (None, "lone text")]
    docs = documents(rows).withColumnRenamed("lang", "row").withColumnRenamed("source", "node")
    found = neardup.near_duplicates(docs).collect()
    assert sorted((r.class_id or 0, r.group_size, r.kept) for r in found) == [
        (0, 1, True), (3, 1, True), (3, 3, False), (3, 3, False), (3, 3, True),
    ]
    assert neardup.near_duplicates(documents([])).count() == 0


def test_components_of_a_long_chain(spark, documents):
    documents([])
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101)], "a long, b long")
    names = {r.node: r.component for r in components(edges).collect()}
    assert names == {**{i: 0 for i in range(41)}, 100: 100, 101: 100}
