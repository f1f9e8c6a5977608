import hashlib
import random
import tracemalloc

import pyarrow as pa
import pytest

from snapsync.llm import repeats


def plain(rows, length):
    """rows: (rank, raw) in order of (id, row)."""
    seen, out = set(), []
    for raw in rows:
        cover = [False] * len(raw)
        for i in range(len(raw) - length + 1):
            window = raw[i : i + length]
            if window in seen:
                cover[i : i + length] = [True] * length
            seen.add(window)
        n_spans = sum(c and (i == 0 or not cover[i - 1]) for i, c in enumerate(cover))
        kept = bytes(b for b, c in zip(raw, cover) if not c)
        out.append((len(raw), sum(cover), n_spans, hashlib.sha256(kept).hexdigest()))
    return out


def check(found, texts, length=100):
    rows = sorted(found.collect(), key=lambda r: (r.id is None, r.id, r.row))
    got = [(r.n_bytes, r.n_removed, len(r.removed), r.kept_sha256) for r in rows]
    assert got == plain([(t or "").encode() for t in texts], length)


def made(rng, alphabet, n):
    parts = ["".join(rng.choices(alphabet, k=rng.randrange(40, 260))) for _ in range(12)]
    texts = []
    for _ in range(n):
        text = "".join(
            rng.choice(parts) if rng.random() < 0.6 else "".join(rng.choices(alphabet, k=rng.randrange(150)))
            for _ in range(rng.randrange(6))
        )
        if texts and rng.random() < 0.3:  # near copies
            text = list(rng.choice(texts))
            for _ in range(rng.randrange(4)):
                if text:
                    text[rng.randrange(len(text))] = rng.choice(alphabet)
            text = "".join(text)
        texts.append(text)
    return texts


@pytest.mark.parametrize("alphabet", ["ab", "abcdefgh é", "a"])
def test_equals_plain_search(documents, alphabet):
    rng = random.Random(len(alphabet))
    texts = made(rng, alphabet, 60) + [None, "", "x" * 99, "x" * 100, "x" * 101, "y" * 1000, "y" * 99]
    check(repeats.repeated_bytes(documents(texts)), texts)


def test_short_length(documents):
    texts = made(random.Random(8), "abc", 40)
    check(repeats.repeated_bytes(documents(texts), length=20, k=6), texts, 20)


def test_given_and_long_text(documents, spark, given):
    texts = [r.text for r in spark.read.parquet(f"{given}/documents.parquet").orderBy("doc_id").collect()]
    texts.append("".join(texts[:80]) * 2)
    check(repeats.repeated_bytes(documents(texts)), texts)


def test_hot_copies_repeated_ids_and_nulls(documents):
    rng = random.Random(3)
    base = "".join(rng.choices("abcdefgh", k=700))
    passage = "".join(rng.choices("ijklmnop", k=180))
    texts = [base] * 150 + [base[:i] + "#" + base[i:] for i in range(0, 700, 10)]
    texts += ["".join(rng.choices("qrst", k=40)) + passage + "".join(rng.choices("qrst", k=90)) for _ in range(80)]
    check(repeats.repeated_bytes(documents(texts)), texts)
    twice = [(None, base), (5, base), (5, base), (None, base + "x"), (6, base[1:])]
    rows = repeats.repeated_bytes(documents(twice)).collect()
    assert sorted(r.n_removed for r in rows) == [0, 699, 700, 700, 700]
    assert repeats.repeated_bytes(documents([])).count() == 0


def test_maximal_repeats_have_all_occurrences():
    rng = random.Random(6)
    contexts = ["".join(rng.choices("ab", k=rng.randrange(4, 30))).encode() for _ in range(12)]
    found = {}
    for size, places in repeats.maximal_repeats(contexts, 4):
        strings = {contexts[c][p : p + size] for c, p in places}
        assert len(strings) == 1
        found[strings.pop()] = sorted(places)
    for string, places in found.items():
        every = [
            (c, p) for c, raw in enumerate(contexts) for p in range(len(raw)) if raw[p:].startswith(string)
        ]
        assert places == every and len(every) > 1
    for raw in contexts:  # every repeated string lies in a maximal one
        for p in range(len(raw) - 3):
            window = raw[p : p + 4]
            if sum(r.startswith(window, q) for r in contexts for q in range(len(r))) > 1:
                assert any(window in string for string in found)


def one_anchor(rng, n):
    """Rows of contexts of one anchor: a common passage around it between different bytes, and the
    number of bytes that plain search covers."""
    passage = "".join(rng.choices("ijklmnop", k=130)).encode()
    rows, seen, covered = [], set(), 0
    for row in range(n):
        left, right = ("".join(rng.choices("abcdefgh", k=23)).encode() for _ in range(2))
        context = left + passage + right
        cover = [False] * len(context)
        for i in range(len(context) - 99):
            window = hash(context[i : i + 100])
            if window in seen:
                cover[i : i + 100] = [True] * 100
            seen.add(window)
        covered += sum(cover)
        rows.append((7, row, row, 1000, 76, context))
    return rows, covered


def contexts_in_batches(rows, size):
    names = ["hash", "rank", "row", "start", "anchor", "context"]
    for i in range(0, len(rows), size):
        yield pa.RecordBatch.from_pydict(dict(zip(names, zip(*rows[i : i + size]))))


def test_memory_of_an_anchor_with_many_contexts():
    """1.6 MB of contexts in a task whose chunks have 128 KB; as one array they took 141 MB."""
    rows, covered = one_anchor(random.Random(9), 9_000)
    work = repeats._repeat(100, 24, 1 << 17)
    list(work(contexts_in_batches(rows[:10], 10)))  # tables that stay
    tracemalloc.start()
    found = pa.Table.from_batches(work(contexts_in_batches(rows, 1_000)))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 100 << 20
    spans = {}
    for row, start, stop in zip(*(c.to_pylist() for c in found.columns)):
        spans.setdefault(row, set()).update(range(start, stop))
    assert sum(map(len, spans.values())) == covered


@pytest.mark.parametrize("alphabet", ["ab", "abcdefgh é"])
@pytest.mark.parametrize("limit", [1, 700])
def test_divided_anchors_equal_plain_search(documents, monkeypatch, alphabet, limit):
    monkeypatch.setattr(repeats._repeat, "__defaults__", (limit,))
    rng = random.Random(limit)
    passage = "".join(rng.choices("ijklmnop", k=180))
    texts = made(rng, alphabet, 60)
    texts += ["".join(rng.choices("qrst", k=40)) + passage + "".join(rng.choices("qrst", k=90)) for _ in range(40)]
    check(repeats.repeated_bytes(documents(texts)), texts)
