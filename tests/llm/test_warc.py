import hashlib

import pytest
from pyspark.sql import functions as F

from snapsync.llm import queries, warc

RECORD = (
    "WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:999>\r\n"
    "Content-Length: {}\r\n\r\n{}"
)


def false_record(text):
    """A record that is none, as it stands inside a payload."""
    return RECORD.format(len(text.encode()), text) + "\r\n\r\n"


@pytest.fixture(scope="module")
def pages(spark, documents):
    def make(rows):
        df = spark.createDataFrame(rows, "page_id long, url string, html string")
        return df.repartition(3, F.col("page_id"))

    return make


def plain(rows, least=1000):
    newest, out = {}, []
    for page_id, _, html in rows:
        if page_id is not None:
            newest[html or ""] = max(page_id, newest.get(html or "", page_id))
    for page_id, _, html in rows:
        data, kept = (html or "").encode(), newest.get(html or "")
        refers = kept if len(data) >= least and kept != page_id else None
        kind = "response" if refers is None else "revisit"
        out.append((page_id, len(data), hashlib.sha1(data).hexdigest(), kind, refers))
    return sorted(out, key=repr)


COLUMNS = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def digests(df):
    return sorted((tuple(r) for r in df.select(*COLUMNS).collect()), key=repr)


def test_the_query_on_given_pages(spark, given):
    rows = [tuple(r) for r in spark.read.parquet(f"{given}/pages.parquet").collect()]
    assert digests(queries.QUERIES["op12_warc"](spark, given)) == plain(rows)


# Payloads that hold what looks like records: whole ones, cut ones, chains, and bare magic.
ODD = [
    None, "", "x", "é" * 499, "é" * 500, "é" * 500, "WARC/1.", "WARC/1.0\r\n", "\r\n\r\n" * 300,
    false_record("inner") * 3,
    "<p>" + false_record("inner") + "tail",
    "<p>" + false_record("inner")[:-4],
    RECORD.format(7, "cut"),
    RECORD.format(10**17, "far"),
    RECORD.format(10**30, "too far"),
    "WARC/1.0\r\nWARC-Type: response\r\nContent-Length: -5\r\n\r\n",
    ("WARC/1.0\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n" + "y" * 50) * 40,
    false_record("z" * 2000), false_record("z" * 2000), "long " * 60_000,
]


def odd_rows():
    rows = [(i, f"http://h/{i}", t) for i, t in enumerate(ODD)]
    rows += [(None, "http://h/\r\nWARC/1.0", "n" * 1200), (50, "http://h/\u0085", "n" * 1200), (50, None, "n" * 1200)]
    rows += [(None, None, "m" * 1200), (None, None, "m" * 1200), (-7, "u", "o" * 1000), (-9, "u", "o" * 1000)]
    return rows + [(1000 + i, "same", "hot " * 400) for i in range(200)]


@pytest.mark.parametrize("split", ["128m", "2k"])
def test_odd_pages(spark, pages, split):
    """Also with files that are cut into very small parts."""
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        found = queries.record_digest(pages(odd_rows()))
        assert digests(found) == plain(odd_rows())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert queries.record_digest(pages([])).count() == 0


def test_payloads_round_trip(spark, pages, tmp_path):
    rows = odd_rows()
    folder = str(tmp_path / "archives")
    warc.write_pages(pages(rows), folder, records_per_file=20)
    found = warc.read_records(spark, folder).where("record_type = 'response'").collect()
    kinds = plain(rows)
    kept = [(i, h) for i, _, h in rows for k in kinds if k[0] == i and k[3] == "response" and k[2] == hashlib.sha1((h or "").encode()).hexdigest()]
    want = {(f"<urn:page:{'' if i is None else i}>", (h or "").encode()) for i, h in kept}
    assert {(r.record_id, bytes(r.payload)) for r in found} == want
    assert all(r.payload_sha1 == r.digest for r in found)
    assert len(found) == sum(k[3] == "response" for k in kinds)
    assert all(s.whole for s in warc.archive_states(spark, folder).collect())


def archive(path, records):
    path.write_bytes(b"".join(r.encode() for r in records))


def test_foreign_archives(spark, documents, tmp_path):
    """Other versions and records, a file that is cut off, one that is no archive at all."""
    head = "WARC/1.0\r\nWARC-Type: {}\r\nWARC-Record-ID: <{}>\r\ncontent-length: {}\r\n\r\n"
    info = head.format("warcinfo", "a", 9) + "software!" + "\r\n\r\n"
    http = "HTTP/1.1 200 OK\r\nX: y\r\n\r\nbody WARC/1.0\r\n"
    page = head.replace("1.0", "1.1").format("response", "b", len(http)) + http + "\r\n\r\n"
    archive(tmp_path / "whole.warc", [info, page, info.replace("<a>", "<c>")])
    archive(tmp_path / "cut.warc", [info, page, info[:-8]])
    archive(tmp_path / "broken.warc", [info, "junk", page])
    archive(tmp_path / "none.warc", ["text", info])
    found = warc.read_records(spark, str(tmp_path)).collect()
    names = sorted((r.file.rsplit("/", 1)[1], r.record_id, bytes(r.payload)) for r in found)
    body = b"body WARC/1.0\r\n"
    assert names == [
        ("broken.warc", "<a>", b""), ("cut.warc", "<a>", b""), ("cut.warc", "<b>", body),
        ("whole.warc", "<a>", b""), ("whole.warc", "<b>", body), ("whole.warc", "<c>", b""),
    ]
    states = warc.archive_states(spark, str(tmp_path)).collect()
    assert {s.file.rsplit("/", 1)[1] for s in states if s.whole} == {"whole.warc"}
    assert len(states) == 4


def test_clashing_columns(pages):
    rows = [(1, "u", "x" * 1000), (2, "u", "x" * 1000)]
    df = pages(rows).withColumns({"sha1": F.lit(1), "refers_to": F.lit(2), "value": F.lit("v")})
    assert digests(queries.record_digest(df)) == plain(rows)
