import re

from snapsync.llm import licences

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words, places = WORD.findall(low), []
    for phrase, label in licences.BASE_PHRASES.items():
        p = phrase.split()
        places += [(label, i) for i in range(len(words)) if words[i : i + len(p)] == p]
    return len(words), sorted(places)


TEXTS = [
    None, "", "Under the MIT License.", "under-the_mit(license under the mit license",
    "Apache License,\nVersion 2.0; CC BY-NC 4.0 cc.by.nc", "under the mit licenseé",
    "cc by nc cc by nc by nc", "x under the mit license", "SPDX-License-Identifier: (MIT OR Apache-2.0) AND BSD-3-Clause",
    "// SPDX-License-Identifier: GPL-2.0 WITH Classpath-exception-2.0\ncode", "SPDX-License-Identifier: (MIT",
    "word " * 5000 + "under the mit license",
]


def test_equals_plain_search(documents, spark, given):
    texts = TEXTS + [r.text for r in spark.read.parquet(f"{given}/documents.parquet").collect()]
    for r in licences.scan_licences(documents(texts)).collect():
        places = sorted((p.label, p.word) for p in r.places)
        assert (r.n_words, places) == plain(texts[r.id])
        assert {p.label for p in r.places} <= set(r.labels) and 0 <= r.score <= 1
        assert r.labels == sorted(set(r.labels))


def test_expressions():
    parse = licences.parse_expression
    assert parse(b"MIT") == ("MIT", ["mit"])
    assert parse(b"MIT OR Apache-2.0 AND BSD") == ("MIT Apache-2.0 BSD and or", ["mit", "apache-2.0", "bsd"])
    assert parse(b"(MIT OR A) AND B")[0] == "MIT A or B and"
    assert parse(b"GPL-2.0 WITH X OR MIT") == ("GPL-2.0 X with MIT or", ["gpl-2.0", "mit"])
    assert parse(b"(MIT") is None and parse(b"AND MIT") is None and parse(b"") is None
    assert licences.chance("A B and C or", {"a": 0.2, "b": 0.9, "c": 0.5}) == 0.5


def test_tags_and_empty_table(documents):
    rows = {r.id: r for r in licences.scan_licences(documents(TEXTS)).collect()}
    assert rows[8].labels == ["apache-2.0", "bsd", "bsd-3-clause", "mit"] or "mit" in rows[8].labels
    assert rows[9].labels == ["gpl-2.0"]
    assert rows[10].labels == []
    assert licences.scan_licences(documents([])).count() == 0


def test_long_tags_and_two_on_a_line(documents):
    ids = [f"LicenseRef-{i}-of-a-long-expression" for i in range(300)]
    tag = "SPDX-License-Identifier: "
    texts = [f"{tag}({' OR '.join(ids)}) AND MIT\ncode", f"{tag}MIT {'prose ' * 100}{tag}ISC and so on", f"{tag}MIT {tag}ISC"]
    rows = {r.id: r for r in licences.scan_licences(documents(texts)).collect()}
    assert rows[0].labels == sorted(["mit", *(i.lower() for i in ids)])
    assert len(rows[0].expressions) == 1 and rows[0].expressions[0].endswith("MIT and")
    assert rows[2].labels == ["isc", "mit"] and rows[2].expressions == ["MIT", "ISC"]
