import hashlib
import random
import zlib

from hypothesis import example
from hypothesis import given as arbitrary
from hypothesis import settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from snapsync.llm import queries, runs


def smallest_period(words):
    return next(p for p in range(1, len(words) + 1) if words[p:] == words[: len(words) - p])


def plain_runs(words, min_length=6, min_exponent=4):
    """Every stretch that is periodic and can't be extended, tried one by one."""
    n, found = len(words), []
    for period in range(1, n // min_exponent + 1):
        start = 0
        while start + period < n:
            stop = start
            while stop + period < n and words[stop] == words[stop + period]:
                stop += 1
            length = stop + period - start
            if stop > start and length >= max(min_length, min_exponent * period):
                if smallest_period(words[start : start + length]) == period:
                    found.append((start, length, period))
            start = stop + 1
    return sorted(found, key=lambda r: (r[0], r[2]))


@settings(max_examples=400, deadline=None)
@arbitrary(st.lists(st.sampled_from("abc"), max_size=60), st.integers(1, 8), st.integers(2, 5))
@example(["a"] * 50, 6, 4)
@example(list("abababcabababcabababcabababc"), 6, 4)
@example(list("aaaaaabaaaaaabaaaaaabaaaaaab"), 6, 4)
def test_runs_of_words(words, min_length, min_exponent):
    assert runs.runs_of(words, min_length, min_exponent) == plain_runs(words, min_length, min_exponent)


def test_larger_classes():
    chosen = random.Random(3)
    words = [chosen.choice("ab") for _ in range(700)] + list("abcab" * 90) + ["a"] * 300
    assert runs.runs_of(words, 6, 4) == plain_runs(words)


def looped(doc_id, words):
    h = zlib.crc32(str(doc_id).encode())
    n, g = len(words), h // 10
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[a + (i - a) % p] if i >= a else words[i] for i in range(n)]


def plain_row(doc_id, text):
    words = looped(doc_id, (text or "").encode().split())
    found = plain_runs(words)
    dropped = {i for s, n, p in found for i in range(s + p, s + n)}
    best = min(found, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=None)
    kept = b" ".join(w for i, w in enumerate(words) if i not in dropped)
    lines = "".join(f"{s},{n},{p}\n" for s, n, p in found)
    return (
        doc_id,
        len(found),
        *(best or (None, None, None)),
        1000 * best[1] // best[2] if best else None,
        hashlib.sha256(lines.encode()).hexdigest(),
        hashlib.sha256(kept).hexdigest(),
    )


COLUMNS = (
    *("doc_id", "n_runs", "start", "length", "period", "exponent_milli"),
    *("runs_sha256", "collapsed_sha256"),
)


def digests(df):
    return sorted((tuple(r) for r in df.select(*COLUMNS).collect()), key=repr)


def test_the_query_on_given_documents(spark, given):
    rows = spark.read.parquet(f"{given}/documents.parquet").select("doc_id", "text").collect()
    found = digests(queries.QUERIES["op13_periodic_runs"](spark, given))
    assert found == sorted((plain_row(*r) for r in rows), key=repr)
    assert sum(r[1] for r in found) > 0


def test_odd_rows(documents):
    looping = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 10 == 0)
    texts = [
        None, "", " \t\r\n", "one", "a a a a a", "a a a a a a", "a a " * 6, "é\x0bé\x0cé é é\ré",
        "x y z " * 400, "a b a b a b a b a c " * 9, "w " * 3000,
    ]
    rows = [(100 + i, t) for i, t in enumerate(texts)]
    rows += [(looping, "a b c d e f g h i j k l m n o p"), (looping, None), (107, "w w w w w w")]
    found = digests(queries.run_digest(documents(rows)))
    assert found == sorted((plain_row(*r) for r in rows), key=repr)
    assert digests(queries.run_digest(documents([]))) == []


def test_null_id_and_clashing_columns(documents):
    df = documents([(None, "a a a a a a b"), (3, "b")])
    df = df.withColumnsRenamed({"lang": "id", "source": "runs"}).withColumn("n_words", F.lit("?"))
    found = {r.id: r for r in runs.periodic_runs(df).collect()}
    assert [tuple(r) for r in found[None].runs] == [(0, 6, 1)]
    assert (found[None].text, found[None].n_words, found[3].runs) == ("a b", 7, [])
