"""Licence scan: Aho-Corasick over the words of a text, shunting-yard over licence expressions."""

import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import FOLD_BYTES, id_and_text

# The base phrases and their labels.
BASE_PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}
# Further notices of well-known licences, and how strongly each speaks for its label.
NOTICES = {
    "permission is hereby granted free of charge to any person": ("mit", 0.95),
    "the mit license": ("mit", 0.9),
    "mit license": ("mit", 0.85),
    "licensed under the apache license": ("apache-2", 0.9),
    "apache license 2 0": ("apache-2", 0.95),
    "gnu general public license version 3": ("gpl-3", 0.95),
    "gnu general public license version 2": ("gpl-2", 0.95),
    "gnu general public license": ("gpl", 0.8),
    "gnu lesser general public license": ("lgpl", 0.9),
    "gnu affero general public license": ("agpl", 0.9),
    "mozilla public license": ("mpl", 0.9),
    "redistribution and use in source and binary forms": ("bsd", 0.95),
    "bsd 3 clause": ("bsd", 0.9),
    "bsd 2 clause": ("bsd", 0.9),
    "isc license": ("isc", 0.85),
    "boost software license": ("bsl", 0.9),
    "eclipse public license": ("epl", 0.9),
    "this is free and unencumbered software": ("unlicense", 0.95),
    "released into the public domain": ("public-domain", 0.85),
    "cc0 1 0": ("cc0", 0.9),
    "cc by sa": ("cc-by-sa", 0.9),
    "cc by nd": ("cc-by-nd", 0.9),
    "cc by 4 0": ("cc-by", 0.9),
    "creative commons attribution": ("cc-by", 0.8),
    "creative commons attribution sharealike": ("cc-by-sa", 0.9),
    "creative commons attribution noncommercial": ("cc-by-nc", 0.9),
    "all rights reserved": ("proprietary", 0.6),
}
TAG = "spdx license identifier"
TAG_TEXT = re.compile(rb"spdx-license-identifier\s*:\s*([^\r\n*]+)", re.IGNORECASE)
NEXT_TAG = re.compile(rb"spdx-license-identifier\s*:", re.IGNORECASE)
TERM = re.compile(rb"[()]|[A-Za-z0-9.+:-]+")
STRENGTH = {b"or": 1, b"and": 2, b"with": 3}
RESULT = (
    "id long, n_words long, places array<struct<label:string,word:long>>, "
    "labels array<string>, expressions array<string>, score double"
)


def automaton(phrases) -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for phrase in phrases:
        found.add_word(f" {phrase} ", phrase)
    found.make_automaton()
    return found


def parse_expression(text: bytes):
    """(terms in postfix order, ids that the expression names), or None where it is no expression.

    Shunting-yard: `with` binds tighter than `and`, `and` tighter than `or`. Words after a complete
    expression end it, as prose may follow a tag on its line.
    """
    output, waiting, ids, want_id = [], [], [], True
    for term in TERM.findall(text):
        low = term.lower()
        if want_id:
            if term == b"(":
                waiting.append(term)
            elif low in STRENGTH or term == b")":
                return None
            else:
                output.append(term)
                if not (waiting and waiting[-1] == b"with"):
                    ids.append(low.decode())
                want_id = False
        elif low in STRENGTH:
            while waiting and waiting[-1] != b"(" and STRENGTH[waiting[-1]] >= STRENGTH[low]:
                output.append(waiting.pop())
            waiting.append(low)
            want_id = True
        elif term == b")":
            while waiting and waiting[-1] != b"(":
                output.append(waiting.pop())
            if not waiting:
                break
            waiting.pop()
        else:
            break
    if want_id or b"(" in waiting:
        return None
    output += waiting[::-1]
    return " ".join(t.decode("utf-8", "replace") for t in output), ids


def chance(postfix: str, known: dict[str, float]) -> float:
    """Evaluate a postfix expression: `and` takes the weaker side, `or` the stronger one, `with` the
    licence it modifies."""
    stack = []
    for term in postfix.split():
        if term in ("and", "or", "with") and len(stack) > 1:
            right, left = stack.pop(), stack.pop()
            stack.append({"and": min(left, right), "or": max(left, right), "with": left}[term])
        else:
            stack.append(known.get(term.lower(), 0.7))
    return stack[-1]


class Scanner:
    def __init__(self, base: dict, notices: dict):
        self.base, self.notices = base, notices
        self.automaton = automaton({**base, **notices, TAG: None})
        self.known = {label: 1.0 for label in base.values()}
        for label, strength in notices.values():
            self.known.setdefault(label, strength)

    def scan(self, raw: bytes):
        words = raw.translate(FOLD_BYTES).split()
        line = f" {b' '.join(words).decode('utf-8', 'replace')} "
        places, labels, expressions, score, tagged = [], set(), [], 0.0, False
        counted, word = 0, 0
        for end, phrase in self.automaton.iter(line):
            if phrase in self.base:
                start = end + 1 - len(phrase) - 2
                word += line.count(" ", counted, start) if start >= counted else 0
                if start < counted:
                    word = line.count(" ", 0, start)
                counted = start
                places.append({"label": self.base[phrase], "word": word})
                labels.add(self.base[phrase])
                score = 1.0
            elif phrase == TAG:
                tagged = True
            else:
                label, strength = self.notices[phrase]
                labels.add(label)
                score = max(score, strength)
        if tagged:
            # A tag's text goes to the end of its line, or to the next tag there.
            found = [t for m in TAG_TEXT.finditer(raw) for t in NEXT_TAG.split(m[1])]
            for text in found:
                if parsed := parse_expression(text):
                    expressions.append(parsed[0])
                    labels.update(parsed[1])
                    score = max(score, chance(parsed[0], self.known))
        return len(words), places, sorted(labels), expressions, score


def scan_licences(
    docs: DataFrame,
    base: dict = BASE_PHRASES,
    notices: dict = NOTICES,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per document: words, places of base phrases (label, first word), all labels sorted,
    the expressions of identifier tags in postfix order, and a score.

    A null or empty text has no words, places or labels and the score 0. Ids may be null or repeat;
    every row is scanned on its own. A tag whose text is no licence expression gives no label.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(base, notices)
        kinds = [
            ("n_words", pa.int64()),
            ("places", pa.list_(pa.struct([("label", pa.string()), ("word", pa.int64())]))),
            ("labels", pa.list_(pa.string())),
            ("expressions", pa.list_(pa.string())),
            ("score", pa.float64()),
        ]
        for batch in batches:
            texts = batch.column(1).cast(pa.binary()).to_pylist()
            columns = list(zip(*[scanner.scan(t or b"") for t in texts])) or [()] * len(kinds)
            arrays = [pa.array(c, kind) for c, (_, kind) in zip(columns, kinds)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *arrays], ["id", *(name for name, _ in kinds)]
            )

    return id_and_text(docs, id_col, text_col).mapInArrow(work, RESULT)
