import hashlib
import re

import numpy as np
from hypothesis import given as arbitrary
from hypothesis import settings
from hypothesis import strategies as st

from snapsync.llm import exact


@settings(max_examples=80, deadline=None)
@arbitrary(st.sets(st.integers(0, 2**64 - 1), min_size=1, max_size=60))
def test_codes_round_trip(values):
    sent = np.array(sorted(values), np.uint64)
    assert (exact.golomb_decode(exact.golomb_encode(sent)) == sent).all()


def plain(rows):
    groups = {}
    for doc_id, text in rows:
        norm = re.sub("[\x20\x09-\x0d]+", " ", text or "")
        groups.setdefault(hashlib.sha256(norm.encode()).hexdigest(), []).append(doc_id)
    out = []
    for sha, ids in groups.items():
        known = [i for i in ids if i is not None]
        keep = min(known) if known else None
        out += [(i, keep, len(ids), sha) for i in ids]
    return sorted(out, key=repr)


def check(spark_rows, rows):
    assert sorted(((r.id, r.keep_id, r.group_size, r.sha) for r in spark_rows), key=repr) == plain(rows)
    kept = [(r.sha, r.keep_id) for r in spark_rows if r.kept]
    assert len(kept) == len(set(kept)) == len({p[3] for p in plain(rows)})
    assert all(r.id == r.keep_id for r in spark_rows if r.kept)


def test_odd_rows(documents):
    rows = [
        (1, None), (2, ""), (3, " "), (4, "\t\n"), (5, "a b"), (6, "a\t\r\nb"), (7, "a b"), (7, "a b"),
        (None, "a b"), (None, "z"), (None, "z"), (8, "x" * 200_000), (9, "x" * 200_000), (10, "A b"), (11, "q"), (11, "q2"),
    ]
    check(exact.exact_duplicates(documents(rows)).collect(), rows)
    assert exact.exact_duplicates(documents([])).count() == 0


def test_given_and_a_hot_group(documents, spark, given):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{given}/documents.parquet").collect()]
    rows += [(10_000 + i, "the same text") for i in range(300)]
    check(exact.exact_duplicates(documents(rows)).collect(), rows)
