import random
import re

from snapsync.llm import pii

BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def good(kind, match):
    digits = re.sub("[^0-9]", "", match)
    if kind == "ip":
        return all(int(p) <= 255 for p in match.split("."))
    if kind == "card":
        own = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
        return 12 <= len(digits) <= 19 and sum(d - 9 * (d > 9) for d in own) % 10 == 0
    return kind == "email" or 9 <= len(digits) <= 15


def plain(text):
    found = []
    for number, (kind, pattern) in enumerate(BASE.items(), 1):
        for m in re.finditer(pattern, text or "", re.ASCII):
            if good(kind, m[0]):
                found.append((m.start(), number, kind, m.end()))
    return sorted(found)


TEXTS = [
    None, "", "a@b.c+d@e.f x@y", "@a.b a@@b.c a.b@c.d.e-f. a@b..c", "1.2.3.4.5 256.1.1.1 01.002.0003.4 1.2..3.4.5.6",
    "4111 1111 1111 1111, 4111-1111-1111-1112 4111111111111111222233334444", "+1 (223) 555-0147 +49.30.1234567 + 12 +1-",
    "😀😀 a@b.co 😀 10.0.0.1 ñ +1 223 555 0147 4111111111111111", "name (at) host dot com", "(030) 1234-5678 223-555-0147",
    "1 2 3 4 5 6 7 8 9 0 1 2 3 4 5 6 7 8 9 0 1", "9" * 50_000 + " a@b.c", "x" * 60_000 + "@y.z", "1.2." * 9000,
    "4111111111111111 4111111111111111", "10.0.0.1" * 3, "a@b.c" * 3,
]


def check(docs, texts):
    rows = pii.find_personal_data(docs).collect()
    assert len(rows) == len(texts)
    for r in rows:
        base = [(s.start, s.number, s.kind, s.stop) for s in r.spans if s.base]
        assert base == plain(texts[r.id])
        for s in r.spans:
            if not s.base:
                assert all(s.stop <= b[0] or s.start >= b[3] for b in base)
    return rows


def test_base_spans_of_odd_texts(documents):
    check(documents(TEXTS), TEXTS)


def test_base_spans_of_random_texts(documents):
    rng = random.Random(5)
    texts = ["".join(rng.choices("0123456789.@+- ()ab", k=rng.randrange(120))) for _ in range(300)]
    check(documents(texts), texts)


def test_given(documents, spark, given):
    rows = spark.read.parquet(f"{given}/documents.parquet").collect()
    check(spark.read.parquet(f"{given}/documents.parquet"), {r.doc_id: r.text for r in rows})


def test_method_adds_spans_of_the_same_look(documents):
    rng = random.Random(2)
    texts = []
    for i in range(400):
        digits = [rng.randrange(10) for _ in range(15)]
        own = [d * (2 - j % 2) for j, d in enumerate(digits)]
        last = -sum(d - 9 * (d > 9) for d in own) % 10
        texts.append("pay by card " + "".join(map(str, [*digits, last])) + " now")
    texts.append("pay by card 4111111111111112 now")
    rows = {r.id: r for r in pii.find_personal_data(documents(texts)).collect()}
    assert [(s.kind, s.base) for s in rows[400].spans] == [("card", False)]


def test_empty_table_and_repeated_rows(documents):
    assert pii.find_personal_data(documents([])).count() == 0
    rows = pii.find_personal_data(documents([(1, "a@b.c"), (1, "a@b.c"), (None, "a@b.c")])).collect()
    assert [len(r.spans) for r in rows] == [1, 1, 1]
