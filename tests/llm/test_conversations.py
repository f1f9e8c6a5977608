import hashlib
import heapq
import random
import re
import zlib

import pytest
from hypothesis import given as arbitrary
from hypothesis import settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from snapsync.llm import conversations, queries

SCHEMA = "conv_id long, turn long, role string, text string"
CELLS = [i + f for i in "sua?" for f in "012"]


def plain_best(codes):
    """Cheapest edits and the least of them by letters, by a search over all (cost, letters) in order."""
    waiting, seen = [(0, "", 0, "")], set()
    while True:
        cost, letters, place, given = heapq.heappop(waiting)
        if place == len(codes) and re.fullmatch("(s?(ua)+)?", given):
            return cost, letters
        # What was given counts by how it may go on.
        key = (place, given[-1:], len(given) > 1 or given == "u")
        if key in seen or not re.fullmatch("s?(ua)*u?", given):
            continue
        seen.add(key)
        for role in "ua":
            heapq.heappush(waiting, (cost + 3, letters + "I", place, given + role))
        if place == len(codes):
            continue
        initial, fault = codes[place]
        heapq.heappush(waiting, (cost + 4, letters + "D", place + 1, given))
        if fault != "1":
            more = 3 * (fault == "2")
            heapq.heappush(waiting, (cost + more, letters + "K", place + 1, given + initial))
            for role in "ua":
                heapq.heappush(waiting, (cost + 3 + more, letters + "R", place + 1, given + role))


def in_blocks(codes, size, fan):
    """The result of the blocks' searches put together as the operator does."""
    if not codes:
        return 0, ""
    cut = ["".join(codes[k : k + size]) for k in range(0, len(codes), size)]
    found = [conversations.paths_of(rows, k == 0) for k, rows in enumerate(cut)]
    parts = [{(s, g): (cost, rank) for s, g, cost, rank, _ in paths} for paths in found]
    levels = [parts]
    while len(levels[-1]) > 1:
        groups = [levels[-1][k : k + fan] for k in range(0, len(levels[-1]), fan)]
        tops = [conversations.as_paths(conversations.joined(g)[-1]) for g in groups]
        levels.append([conversations.as_part(t) for t in tops])
    top = {ends: (c, (r,), 0) for ends, (c, r) in levels[-1][0].items()}
    cost, goal = conversations.end_of(top)
    states = [(conversations.START, goal)]
    for level in levels[-2::-1]:
        states = [
            ends
            for k, (state, after) in enumerate(states)
            for ends in conversations.states_between(
                conversations.joined(level[k * fan : (k + 1) * fan]), state, after
            )
        ]
    letters = [
        next(p[4] for p in paths if p[:2] == ends) for paths, ends in zip(found, states, strict=True)
    ]
    return cost, "".join(letters) + conversations.ENDING[goal]


@settings(max_examples=500, deadline=None)
@arbitrary(st.lists(st.sampled_from(CELLS), max_size=14), st.integers(1, 6), st.integers(2, 3))
def test_the_search(codes, size, fan):
    best = plain_best(codes)
    assert in_blocks(codes, 64, 2) == best
    assert in_blocks(codes, size, fan) == best


def test_long_blocks():
    chosen = random.Random(5)
    for n in (60, 200):
        codes = [chosen.choice("suaaauuu") + chosen.choice("0000000012") for _ in range(n)]
        assert in_blocks(codes, 64, 2) == in_blocks(codes, 16, 4) == plain_best(codes)


def plain_repair(rows):
    """Report of one conversation's damaged rows, in order."""
    seen, codes, counts = set(), [], [0, 0, 0]
    for _, role, text in rows:
        last = re.sub(r"[\x20\x09-\x0d]", "", text)[-1:]
        fault = 1 if not last else 2 if (role, text) in seen else 3 if last not in ".!?" else 0
        seen.add((role, text))
        if fault:
            counts[fault - 1] += 1
        codes.append((role[0] if role[:1] in ("s", "u", "a") else "?") + "0112"[fault])
    cost, audit = plain_best(codes)
    lines, given, at = [], "", 0
    for letter in audit:
        following = "a" if given[-1:] == "u" else "u"
        if letter == "I":
            lines.append(({"u": "user", "a": "assistant"}[following], ""))
        else:
            _, role, text = rows[at]
            at += 1
            if letter == "D":
                continue
            lines.append(({"u": "user", "a": "assistant"}[following] if letter == "R" else role, text))
        given += lines[-1][0][0]
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    initials = [c[0] for c in codes]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    text = "\n".join(f"{r}:{t}" for r, t in lines)
    return gaps, *counts, illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest()


def plain(table):
    groups = {}
    for conv, turn, role, text in table:
        rows = groups.setdefault(conv, [])
        key = ":".join(" " if v is None else str(v) for v in (conv, turn))
        kind = zlib.crc32(key.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if kind == 1:
            text = ""
        if kind == 2:
            text = re.sub("[.!?]", "", text)
        if kind == 4:
            role = "user"
        rows += [(turn, role, text)] * {0: 0, 3: 2}.get(kind, 1)
    order = {c: sorted(r, key=lambda x: (x[0] is not None, x[0] or 0, x[1], x[2])) for c, r in groups.items()}
    return sorted(((c, *plain_repair(r)) for c, r in order.items()), key=repr)


COLUMNS = (
    *("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"),
    "repaired_sha256",
)


def digests(df):
    return sorted((tuple(r) for r in df.select(*COLUMNS).collect()), key=repr)


@pytest.fixture(scope="module")
def make(spark, documents):
    return lambda rows: spark.createDataFrame(rows, SCHEMA).repartition(3)


def test_the_query_on_given_conversations(spark, given):
    rows = [tuple(r) for r in spark.read.parquet(f"{given}/conversations.parquet").collect()]
    assert digests(queries.QUERIES["op11_conversation_repair"](spark, given)) == plain(rows)


def odd_rows():
    chosen = random.Random(11)
    rows = [
        (1, None, "user", "Hi."), (1, None, "assistant", "Yes."), (1, None, None, "What?"),
        (2, 1, "system", "Be good."), (2, 2, "user", None), (2, 2, "user", "b."), (2, 2, "user", "a."),
        (2, 9, "", "no role."), (2, 10, "sister", "s."), (2, 11, "User", "Upper."),
        (None, 1, "user", "x!"), (None, 2, "assistant", "y?"), (None, None, "assistant", "z"),
        (3, -5, "user", "é" * 5000 + "."), (3, 5, "assistant", "\x0b\t\r\n"), (4, 0, "system", "alone."),
        (5, 0, "user", "\u2028"), (5, 1, "assistant", "end.\u0085"), (5, 2, "user", "a.\u2029\n"),
    ]
    rows += [rows[3]] * 3
    roles, texts = ["user", "assistant", "system", "tool"], ["a.", "b", "c!", " ", "dd?"]
    rows += [(100 + k // 9, k, chosen.choice(roles), chosen.choice(texts) + str(k)) for k in range(180)]
    rows += [(k, 0, "user", "q?") for k in range(1000, 1060)]
    # A conversation of many rows, some of them equal.
    return rows + [(7, k // 2, chosen.choice(roles[:3]), f"t{k % 300}" + chosen.choice(".. !")) for k in range(700)]


@pytest.mark.parametrize("sizes", [{}, {"rows_per_block": 8, "blocks_per_group": 3}])
def test_odd_conversations(make, sizes):
    assert digests(queries.repair_digest(make(odd_rows()), **sizes)) == plain(odd_rows())


def test_empty_table_and_clashing_columns(make):
    assert digests(queries.repair_digest(make([]))) == []
    rows = odd_rows()[:19]
    df = make(rows).withColumns({c: F.lit(1) for c in ("conv", "position", "fault", "audit", "kind", "block")})
    assert digests(queries.repair_digest(df)) == plain(rows)


def test_repaired_rows(make):
    rows = [(1, 1, "user", "a."), (1, 2, "user", "b."), (1, 3, "tool", "c."), (2, 1, "user", " ")]
    found = conversations.repair_conversations(make(rows))
    assert sorted((r.conv, r.place, r.role, r.text) for r in found.repaired().collect()) == [
        ("=1", 0, "user", "a."), ("=1", 1, "assistant", ""), ("=1", 2, "user", "b."), ("=1", 3, "assistant", "c."),
    ]
    assert {r.conv: (r.cost, r.audit) for r in found.reports.collect()} == {"=1": (6, "KIKR"), "=2": (4, "D")}
