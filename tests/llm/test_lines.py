import random

import pytest

from snapsync.llm import lines


def plain(texts, min_words):
    """Every run of lines that is right-maximal for a pair of places, by comparing all pairs."""
    flat = []  # per text: (line number, trimmed line) of lines with words
    for t in texts:
        cut = [(i, x.strip(" \t\r\x0b\x0c")) for i, x in enumerate((t or "").split("\n"))]
        flat.append([(i, x) for i, x in cut if x])
    gone = [set() for _ in texts]
    places = [(d, p) for d, own in enumerate(flat) for p in range(len(own))]
    by_line = {}
    for d, p in places:
        by_line.setdefault(flat[d][p][1], []).append((d, p))
    for d, p in places:
        for e, q in by_line[flat[d][p][1]]:
            if (e, q) >= (d, p):
                break
            n = words = 0
            while p + n < len(flat[d]) and q + n < len(flat[e]) and flat[d][p + n][1] == flat[e][q + n][1]:
                words += len(flat[d][p + n][1].split(" "))
                n += 1
            if words >= min_words:
                gone[d] |= set(range(flat[d][p][0], flat[d][p + n - 1][0] + 1))
    out = []
    for t, g in zip(texts, gone):
        own = (t or "").split("\n")
        out.append(("\n".join(x for i, x in enumerate(own) if i not in g), len(own), len(g)))
    return out


def check(found, texts, min_words=50):
    rows = sorted(found.collect(), key=lambda r: (r.id is None, r.id, r.row))
    assert [(r.text, r.n_lines, r.n_removed) for r in rows] == plain(texts, min_words)


def made(seed, n=70):
    rng = random.Random(seed)
    pool = [" ".join(rng.choices("abcdefgh", k=rng.choice([1, 2, 5, 12, 30, 60]))) for _ in range(25)]
    runs = [[rng.choice(pool) for _ in range(rng.randrange(1, 14))] for _ in range(8)]
    texts = []
    for i in range(n):
        own = []
        for _ in range(rng.randrange(5)):
            kind = rng.random()
            own += rng.choice(runs) if kind < 0.5 else [rng.choice(pool)] if kind < 0.7 else [f"line {i} {rng.random()}"]
            own += [""] * (rng.random() < 0.2)
        texts.append("\n".join(own))
        if rng.random() < 0.2:
            texts.append(texts[-1])
    return texts


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_comparing_all_pairs(documents, seed):
    texts = made(seed) + [None, "", "\n\n", " \n\t", "a " * 60, "a " * 60 + "\r", "a " * 60]
    check(lines.repeated_lines(documents(texts)), texts)


def test_other_bounds(documents):
    texts = made(9, 40)
    check(lines.repeated_lines(documents(texts), min_words=3), texts, 3)


def test_given(documents, spark, given):
    rows = spark.read.parquet(f"{given}/documents.parquet").orderBy("doc_id").collect()
    texts = [r.text for r in rows]
    check(lines.repeated_lines(spark.read.parquet(f"{given}/documents.parquet")), texts)


def test_hot_line_long_text_and_repeated_rows(documents):
    passage = " ".join(f"p{i}" for i in range(55))
    texts = [f"own {i}\ncommon\n{passage}\nother {i}\ncommon" for i in range(150)]
    texts.append("\n".join(f"z{i % 300} and some more words" for i in range(3000)))
    found = lines.repeated_lines(documents(texts))
    check(found, texts)
    twice = [(None, passage), (4, passage), (4, passage), (None, "x")]
    rows = lines.repeated_lines(documents(twice)).collect()
    assert sorted((r.id or 0, r.text == "") for r in rows) == [(0, False), (0, True), (4, False), (4, True)]
    assert lines.repeated_lines(documents([])).count() == 0


def test_one_line_many_times(documents):
    # Suffixes of these as texts would be 3,200 million entries; each line but the first copies goes.
    n = 80_000
    texts = ["x\n" * n, "head of its own\n" + "\n".join(["x"] * 60) + "\n|\n" + "|\n" * 100]
    rows = {r.id: r for r in lines.repeated_lines(documents(texts)).collect()}
    assert (rows[0].text, rows[0].n_lines, rows[0].n_removed) == ("x\n", n + 1, n - 1)
    assert (rows[1].text, rows[1].n_removed) == ("head of its own\n|\n", 160)


@pytest.mark.parametrize("seed", [3, 4])
def test_few_short_lines(documents, seed):
    rng = random.Random(seed)
    texts = ["\n".join(rng.choices(["x", "x", "x y", "a b c d e f"], k=rng.randrange(60))) for _ in range(40)]
    check(lines.repeated_lines(documents(texts), min_words=9), texts, 9)


@pytest.mark.parametrize("between, words, goes", [
    ("\t", 60, True), ("\u00a0", 60, True), ("\u3000", 60, True), ("  ", 30, False), (" \t ", 60, True),
])
def test_words_between_any_white_space(documents, between, words, goes):
    passage = between.join(f"c{i}" for i in range(words))
    rows = lines.repeated_lines(documents([f"a\n{passage}", f"b\n{passage}"])).collect()
    assert {r.id: r.n_removed for r in rows} == {0: 0, 1: int(goes)}
