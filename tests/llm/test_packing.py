import itertools
import json
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
from tokenizers import Tokenizer

from snapsync.llm import packing

PATH = public_tokenizers.path("byte_bpe_50k.json")
ODD = [
    "", None, "a", " lead", "trail ", "two  spaces", "a\n b", "a \nb", "tab\there", "nb sp x",
    "it's we'll I'D", "end.<|endoftext|> more", "nul\0 in", "x" * 9000, "Só. É? 漢字 。 x", "  a b",
    "a.\n\nB c.", "1 234 5a -- ++ !", "word " * 3000,
]


def ids_of(text):
    t = Tokenizer.from_file(PATH)
    return t.encode(text or "", add_special_tokens=False).ids + [1]


def check(rows, texts):
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
    for doc_id, text in texts.items():
        ids, at = ids_of(text), 0
        for r in sorted(by_doc[doc_id], key=lambda r: r.start):
            assert r.start == at and r.length > 0 and r.doc_tokens == len(ids)
            part = np.array(ids[at : at + r.length], "<u4")
            assert r.ids_crc32 == zlib.crc32(part.tobytes())
            at += r.length
        assert at == len(ids)
    padding = total = 0
    for pieces in by_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 2048
        total += at
        padding += 0 if at & (at - 1) == 0 else 2048 - at
    return padding / max(1, total)


def test_round_trip_of_odd_texts(documents):
    assert check(packing.pack(documents(ODD), PATH).collect(), dict(enumerate(ODD))) < 0.5


def test_given_documents_lose_nothing(spark, given):
    docs = spark.read.parquet(f"{given}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert check(packing.pack(docs, PATH).collect(), texts) < 0.02


def test_cuts_are_the_cheapest():
    rng = random.Random(3)
    for _ in range(60):
        places = sorted(rng.sample(range(1, 40), 9))
        places = [p for p in places]
        costs = [rng.choice([0, 2, 5]) for _ in places]
        window = max(12, max(b - a for a, b in zip([0, *places], places)))

        def price(cuts):
            edges = [0, *(places[c] for c in cuts)]
            sizes = [b - a for a, b in zip(edges, edges[1:])]
            if max(sizes) > window:
                return None
            return sum(window - s for s in sizes) + sum(costs[c] for c in cuts)

        last = len(places) - 1
        every = [
            price([*c, last]) for n in range(last + 1) for c in itertools.combinations(range(last), n)
        ]
        assert price(packing.cheapest_cuts(places, costs, window)) == min(
            p for p in every if p is not None
        )


def test_empty_null_ids_and_repeated_rows(documents):
    assert packing.pack(documents([]), PATH).count() == 0
    rows = packing.pack(documents([(None, "a b"), (7, "c"), (7, "c")]), PATH).collect()
    assert sum(r.length for r in rows if r.doc_id == 7) == 4
    assert sum(r.length for r in rows if r.doc_id is None) == 3


def test_ids_of_the_file(given):
    """Every kind of character beside letters, digits, spaces and itself, and the given texts."""
    tokenizer, tokens = Tokenizer.from_file(PATH), packing.Tokens(PATH)
    assert tokens.fast
    odd = (chr(c) for c in range(0x30000) if c % 7 == 0 and not 0xD800 <= c < 0xE000)
    texts = [f"a{x}b {x}1{x} {x}{x}  x{x}.{x}\n{x}" for x in odd]
    texts += [t or "" for t in ODD] + ["x" * 100_000, " " * 3000, "<|endoftext|>", "a<|endoftext|> b"]
    texts += [r["text"] or "" for r in pq.read_table(f"{given}/documents.parquet").to_pylist()]
    for text, (ids, _) in zip(texts, tokens.of(texts), strict=True):
        assert ids.tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_other_tokenizers_get_whole_texts(tmp_path):
    """With a space before each text the cutting rules don't hold."""
    settings = json.loads(Tokenizer.from_file(PATH).to_str())
    settings["pre_tokenizer"]["add_prefix_space"] = True
    path = str(tmp_path / "other.json")
    Tokenizer.from_str(json.dumps(settings)).save(path)
    other = Tokenizer.from_file(path)
    texts = ["one two, three.", "x y"]
    found = [i.tolist() for i, _ in packing.Tokens(path).of(texts)]
    assert not packing.Tokens(path).fast
    assert found == [other.encode(t, add_special_tokens=False).ids for t in texts]
    assert found[0] != ids_of(texts[0])[:-1]
    # so it is with merged tokens that are not numbered in the order of their merges
    settings = json.loads(Tokenizer.from_file(PATH).to_str())
    assert packing._byte_ranks(settings)
    settings["model"]["merges"] = settings["model"]["merges"][::-1]
    assert packing._byte_ranks(settings) is None
