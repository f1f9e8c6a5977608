"""Repair of conversations: the cheapest edits that make turns alternate, by iterative-deepening A*.

A conversation is well formed if the initials of its roles give `(s?(ua)+)?`. Rows are kept, deleted or
given another role, and empty rows are put in. The search goes through a conversation's rows depth first,
trying delete, insert, keep and rerole in this order (that of their initials), within a bound on the cost
that starts at a lower estimate and rises to the least estimate that was beyond it. States that failed
within some remaining cost are remembered and not searched again within less. The first path that ends
well is the answer: the cheapest, and of these the least one by its initials.

A conversation may hold any number of rows: it is cut into blocks of `rows_per_block` rows. The search
gives each block its cheapest edits for each grammar state before and after it, and blocks are put
together by these few numbers, block by block and then group by group, so that no task ever holds a
conversation. Texts are moved twice, to number the rows and to write the repaired ones; only initials and
faults go to the search.
"""

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache, reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from .common import partitions, written

# Costs of the edits.
DELETE, INSERT, REROLE, TRUNCATED = 4, 3, 3, 3
# Grammar states: nothing yet, after the system row, after a user row, after an assistant row.
START, SYSTEM, USER, ASSISTANT = range(4)
STATES = range(4)
NEXT = {START: "su", SYSTEM: "u", USER: "a", ASSISTANT: "u"}
STATE_OF = {"s": SYSTEM, "u": USER, "a": ASSISTANT}
ROLE_OF = {"u": "user", "a": "assistant"}
# Edits that end a conversation well, by the state it is left in.
ENDING = {START: "", SYSTEM: "II", USER: "I", ASSISTANT: ""}
LEGAL = {"su", "ua", "au"}
# Faults, and what stands for a row in a block: its role's initial (? for another) and its fault.
SOUND, GONE, CUT = "0", "1", "2"
BLANK = r"\A[\x20\x09-\x0D]*\z"
ENDS_SENTENCE = r"[.!?][\x20\x09-\x0D]*\z"


# --- the search in one block -------------------------------------------------------------------


def least_costs(rows: str) -> list[int]:
    """Lower estimate of the cost of the rows from each place on.

    Forced costs, and for disjoint pairs of rows that meet illegally the least that it takes to part or
    change them: a row with a cut text costs but one more when it is deleted.
    """
    forced, pairs, later = [0], [(0, 0)], None
    for at in range(len(rows) - 2, -1, -2):
        initial, fault = rows[at], rows[at + 1]
        best, best_after = pairs[-1]
        if fault == GONE:
            forced.append(forced[-1] + DELETE)
            pairs.append((best, best_after))
            continue
        forced.append(forced[-1] + (TRUNCATED if fault == CUT else 0))
        meeting = 0
        if later is not None and initial + later[0] not in LEGAL:
            cheap = DELETE - TRUNCATED if CUT in (fault, later[1]) else DELETE
            meeting = min(cheap, INSERT, REROLE)
        # Either this row is in a pair with the next one left, or it is in none.
        pairs.append((max(best, best_after + meeting), best))
        later = (initial, fault)
    return [f + p for f, (p, _) in zip(forced, pairs, strict=True)][::-1]


def edits_of(initial: str, fault: str, state: int):
    """(letter, cost, state after it, rows used) of the edits before or of a row, by letter."""
    yield "D", DELETE, state, 1
    inserted = NEXT[state][-1]
    yield "I", INSERT, STATE_OF[inserted], 0
    if fault == GONE:
        return
    more = TRUNCATED if fault == CUT else 0
    if initial in NEXT[state]:
        yield "K", more, STATE_OF[initial], 1
    yield "R", REROLE + more, STATE_OF[inserted], 1


class Search:
    """Iterative-deepening A* over one block, from a state before it to a state after it."""

    def __init__(self, rows: str, goal: int):
        self.rows, self.goal, self.n = rows, goal, len(rows) // 2
        self.least = least_costs(rows)
        # The largest remaining cost within which a place and state are known to fail.
        self.failed = {}

    def cheapest(self, state: int, most: int) -> tuple[int, str]:
        """Cost and letters of the best edits, which cost `most` or less."""
        bound = self.least[0]
        while bound <= most:
            letters, beyond = self.within(state, bound)
            if letters is not None:
                return bound, letters
            bound = beyond
        raise ValueError(f"no edits of {self.rows} lead from {state} to {self.goal}")

    def within(self, state: int, bound: int):
        """The first path within the bound, and the least estimate beyond it."""
        beyond = 1 << 60
        # One frame per edit: place, state, cost that is left, further edits.
        stack, letters = [], []
        frame = (0, state, bound)
        while True:
            place, state, left = frame
            over = self.least[place] - left
            edits = iter(())
            if over > 0:
                beyond = min(beyond, bound + over)
            elif place == self.n and state == self.goal:
                return "".join(letters), beyond
            elif self.failed.get((place, state), -1) >= left:
                # It failed with this much or more; what lies beyond is at least one further.
                beyond = min(beyond, bound + self.failed[place, state] + 1 - left)
            elif place < self.n and may_follow(state, self.goal):
                # Insertions after the last row belong to the next block or to the ending.
                edits = edits_of(self.rows[2 * place], self.rows[2 * place + 1], state)
            stack.append((place, state, left, edits))
            while True:
                place, state, left, edits = stack[-1]
                found = next(edits, None)
                if found is not None:
                    break
                if place < self.n:
                    self.failed[place, state] = max(left, self.failed.get((place, state), -1))
                stack.pop()
                if not stack:
                    return None, beyond
                letters.pop()
            letter, cost, after, used = found
            letters.append(letter)
            frame = (place + used, after, left - cost)


@lru_cache(maxsize=1 << 13)
def paths_of(rows: str, first: bool) -> tuple:
    """(state before, state after, cost, rank, letters) of a block; only from the start in a first one.

    The rank orders the letters of paths from one state. They can't be beginnings of each other, as each
    ends with the edit of the block's last row.
    """
    found = []
    has_system = any(rows[k] == "s" and rows[k + 1] != GONE for k in range(0, len(rows), 2))
    # Deleting everything and putting in what is missing is always possible.
    most = len(rows) // 2 * (DELETE + TRUNCATED) + 3 * INSERT
    searches = [Search(rows, goal) for goal in STATES]
    for state in [START] if first else STATES:
        goals = [g for g in STATES if may_follow(state, g) and (state == g or g != SYSTEM or has_system)]
        ways = [(goal, *searches[goal].cheapest(state, most)) for goal in goals]
        ranks = {goal: r for r, (goal, _, _) in enumerate(sorted(ways, key=lambda w: w[2]))}
        found += [(state, goal, cost, ranks[goal], letters) for goal, cost, letters in ways]
    return tuple(found)


def may_follow(state: int, goal: int) -> bool:
    """Can any rows lead from one state to the other?"""
    return goal in (USER, ASSISTANT) or goal == state or (state == START and goal == SYSTEM)


# --- putting blocks together -------------------------------------------------------------------


def joined(parts: list[dict]) -> list[dict]:
    """Tables of best paths up to each part: {(state before the first, state after): (cost, ranks,
    state before the part)}; the ranks of all parts, one after the other, order equal costs."""
    tables, table = [], None
    for part in parts:
        if table is None:
            table = {ends: (cost, (rank,), ends[0]) for ends, (cost, rank) in part.items()}
        else:
            new = {}
            for (start, middle), (cost, ranks, _) in table.items():
                for (state, goal), (more, rank) in part.items():
                    if state != middle:
                        continue
                    way = (cost + more, (*ranks, rank), middle)
                    if (start, goal) not in new or way[:2] < new[start, goal][:2]:
                        new[start, goal] = way
            table = new
        tables.append(table)
        # Only the order of the ranks counts from here on.
        for start in STATES:
            own = sorted({w[1] for (s, _), w in table.items() if s == start})
            place = {ranks: (k,) for k, ranks in enumerate(own)}
            for ends, (cost, ranks, middle) in table.items():
                if ends[0] == start:
                    table[ends] = (cost, place[ranks], middle)
    return tables


PATHS = "array<struct<state:int,goal:int,cost:long,rank:int>>"


def as_part(paths) -> dict:
    return {(p["state"], p["goal"]): (p["cost"], p["rank"]) for p in paths}


def as_paths(table: dict) -> list[dict]:
    return [
        {"state": s, "goal": g, "cost": cost, "rank": ranks[0]}
        for (s, g), (cost, ranks, _) in table.items()
    ]


def end_of(table: dict) -> tuple[int, int]:
    """(cost, state left) of a whole conversation: cheapest with its ending, least by letters."""
    ways = [
        (cost + INSERT * len(ENDING[goal]), ranks, goal)
        for (state, goal), (cost, ranks, _) in table.items()
        if state == START
    ]
    cost, _, goal = min(ways)
    return cost, goal


def states_between(tables: list[dict], start: int, goal: int) -> list[tuple[int, int]]:
    """(state before, state after) of each part on the best path between two states."""
    found = []
    for table in reversed(tables):
        _, _, middle = table[start, goal]
        found.append((middle, goal))
        goal = middle
    return found[::-1]


def mapped(df: DataFrame, work, schema: str) -> DataFrame:
    """mapInArrow of a function from rows (as dicts) to rows."""

    def batches(given: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in given:
            rows = [found for row in batch.to_pylist() for found in work(row)]
            if rows:
                yield pa.RecordBatch.from_pylist(rows, kinds)

    kinds = to_arrow_schema(StructType.fromDDL(schema))
    return df.mapInArrow(batches, schema)


def grouped(blocks: DataFrame, fan: int) -> DataFrame:
    """`fan` blocks at a time of the conversations that have several."""
    several = blocks.where("block > 0").select("conv").distinct()
    return (
        blocks.join(several, "conv", "left_semi")
        .withColumn("group", F.floor(F.col("block") / fan))
        .groupBy("conv", "group")
        .agg(F.sort_array(F.collect_list(F.struct("block", "paths"))).alias("parts"))
    )


def levels_of(blocks: DataFrame, fan: int) -> list[DataFrame]:
    """Blocks, groups of `fan` blocks, groups of groups and so on, until each conversation is one; only
    those go up that are more."""
    levels = [blocks]

    def together(row):
        table = joined([as_part(p["paths"]) for p in row["parts"]])[-1]
        yield {"conv": row["conv"], "block": row["group"], "paths": as_paths(table)}

    while not levels[-1].where("block > 0").isEmpty():
        above = mapped(grouped(levels[-1], fan), together, f"conv string, block long, paths {PATHS}")
        levels.append(written(above))
    return levels


def chosen_states(levels: list[DataFrame], fan: int) -> tuple[DataFrame, DataFrame]:
    """(conv, cost, goal) of each conversation, and (conv, block, state, goal) of each of its blocks."""

    def ended(row):
        cost, goal = end_of({ends: (c, (r,), 0) for ends, (c, r) in as_part(row["paths"]).items()})
        yield {"conv": row["conv"], "cost": cost, "goal": goal}

    def whole(level):
        """Conversations that are one block at a level; each is at one level only."""
        several = level.where("block > 0").select("conv").distinct()
        alone = level.join(several, "conv", "left_anti")
        return written(mapped(alone, ended, "conv string, cost long, goal int"))

    def between(row):
        parts = row["parts"]
        ways = states_between(joined([as_part(p["paths"]) for p in parts]), row["state"], row["goal"])
        for part, (state, goal) in zip(parts, ways, strict=True):
            yield {"conv": row["conv"], "block": part["block"], "state": state, "goal": goal}

    def from_start(top):
        first = F.lit(0).cast("long").alias("block")
        return top.select("conv", first, F.lit(START).alias("state"), "goal")

    tops = [whole(level) for level in levels]
    chosen = from_start(tops[-1])
    for level, top in zip(levels[-2::-1], tops[-2::-1], strict=True):
        wanted = grouped(level, fan).join(chosen.withColumnRenamed("block", "group"), ["conv", "group"])
        below = mapped(wanted, between, "conv string, block long, state int, goal int")
        chosen = written(below.unionByName(from_start(top)))
    return reduce(DataFrame.unionByName, tops), chosen


# --- rows --------------------------------------------------------------------------------------


def in_order() -> list[Column]:
    return [F.col("conv"), F.asc_nulls_first("turn"), F.col("role"), F.col("text")]


def numbered(rows: DataFrame) -> DataFrame:
    """(conv, turn, role, said, fault, position): the rows of each conversation, numbered from 1 in order.
    `said` is the text's hash, `fault` is blank or truncated.

    The rows are cut into ranges of their order, so that a conversation spans as many tasks as it needs;
    one row per range and conversation carries the count on.
    """
    fault = F.when(F.col("text").rlike(BLANK), "blank").when(
        ~F.col("text").rlike(ENDS_SENTENCE), "truncated"
    )
    placed = written(
        rows.repartitionByRange(*in_order())
        .sortWithinPartitions(*in_order())
        .select(
            *("conv", "turn", "role"),
            F.unhex(F.sha2("text", 256)).alias("said"),
            fault.alias("fault"),
            F.monotonically_increasing_id().alias("row"),
        )
    ).withColumn("range", F.shiftright("row", 33))
    earlier = Window.partitionBy("conv").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = placed.groupBy("conv", "range").agg(
        F.min("row").alias("low"), F.count(F.lit(1)).alias("n")
    )
    before = ranges.select(
        "conv", "range", (F.coalesce(F.sum("n").over(earlier), F.lit(0)) - F.col("low") + 1).alias("add")
    )
    return (
        placed.join(before, ["conv", "range"])
        .withColumn("position", F.col("row") + F.col("add"))
        .drop("row", "range", "add")
    )


def with_faults(rows: DataFrame) -> DataFrame:
    """Numbered rows with each one's first fault: blank, duplicate or truncated."""
    firsts = rows.groupBy("conv", "role", "said").agg(F.min("position").alias("position"))
    first = firsts.select("conv", "position", F.lit(True).alias("first"))
    again = F.col("first").isNull() & ~F.col("fault").eqNullSafe("blank")
    return (
        rows.drop("said")
        .join(first, ["conv", "position"], "left")
        .withColumn("fault", F.when(again, "duplicate").otherwise(F.col("fault")))
        .drop("first")
    )


def code() -> Column:
    """Two characters for a row: its role's initial, and whether it must go or is cut."""
    initial = F.substring("role", 1, 1)
    known = F.when(initial.isin("s", "u", "a"), initial).otherwise("?")
    fault = F.when(F.col("fault").isNull(), SOUND).when(F.col("fault") == "truncated", CUT)
    return F.concat(known, fault.otherwise(GONE))


def blocks_of(rows: DataFrame, rows_per_block: int) -> DataFrame:
    """(conv, block, rows, before): the codes of each block's rows in order, and the code of the row
    before the block."""
    block = F.floor((F.col("position") - 1) / rows_per_block)
    coded = rows.select("conv", "position", code().alias("code"), block.alias("block"))
    # A block's last row also tells the next block what came before it.
    is_last = F.col("position") % rows_per_block == 0
    places = F.when(is_last, F.array("block", F.col("block") + 1)).otherwise(F.array("block"))
    sent = coded.select("conv", "position", "code", "block", F.explode(places).alias("to"))
    own = F.when(F.col("block") == F.col("to"), F.struct("position", "code"))
    before = F.when(F.col("block") < F.col("to"), F.col("code"))
    return (
        sent.groupBy("conv", F.col("to").alias("block"))
        .agg(
            F.array_join(F.sort_array(F.collect_list(own))["code"], "").alias("rows"),
            F.max(before).alias("before"),
        )
        .where("rows <> ''")
    )


def searched(blocks: DataFrame) -> DataFrame:
    """The paths of each block, and how many of its rows meet the row before them illegally."""

    def search(row):
        initials = (row["before"] or "")[:1] + row["rows"][::2]
        yield {
            "conv": row["conv"],
            "block": row["block"],
            "illegal": sum(a + b not in LEGAL for a, b in zip(initials, initials[1:])),
            "paths": [
                dict(zip(("state", "goal", "cost", "rank", "letters"), path, strict=True))
                for path in paths_of(row["rows"], row["block"] == 0)
            ],
        }

    # The search takes longer than the few bytes of a block suggest: a fixed number of partitions, as
    # adaptive execution would join small ones.
    dealt = blocks.repartition(partitions(blocks.sparkSession), F.xxhash64("conv", "block"))
    paths = PATHS.replace("rank:int", "rank:int,letters:string")
    return mapped(dealt, search, f"conv string, block long, illegal long, paths {paths}")


@dataclass(frozen=True)
class Repair:
    """`reports` (conv, gaps, n_blank, n_duplicate, n_truncated, illegal, cost, audit), one row per
    conversation, and the given `rows` in their clean form."""

    reports: DataFrame
    rows: DataFrame

    def repaired(self) -> DataFrame:
        """(conv, place, role, text) of the repaired rows; place counts from 0."""

        def numbered_lines(batches):
            conv, place, found = None, 0, []
            for name, role, text in repaired_lines(batches):
                conv, place = name, place + 1 if name == conv else 0
                found.append((name, place, role, text))
                if len(found) == 4096:
                    yield pa.RecordBatch.from_arrays(list(map(pa.array, zip(*found))), columns)
                    found = []
            if found:
                yield pa.RecordBatch.from_arrays(list(map(pa.array, zip(*found))), columns)

        columns = ["conv", "place", "role", "text"]
        kinds = "conv string, place long, role binary, text binary"
        found = self._with_audits().mapInArrow(numbered_lines, kinds)
        return found.withColumns({c: F.col(c).cast("string") for c in ("role", "text")})

    def text_hashes(self) -> DataFrame:
        """(conv, sha256) of the repaired `role:text` lines, joined by line feeds; none where no row is
        left. A hash goes on from row to row, so that no task holds a conversation."""

        def hashed(batches):
            conv, state, found = None, None, []
            for name, role, text in repaired_lines(batches):
                if name == conv:
                    state.update(b"\n")
                else:
                    if conv is not None:
                        found.append({"conv": conv, "sha256": state.hexdigest()})
                    conv, state = name, hashlib.sha256()
                state.update(role + b":" + text)
                if len(found) == 4096:
                    yield pa.RecordBatch.from_pylist(found)
                    found = []
            if conv is not None:
                found.append({"conv": conv, "sha256": state.hexdigest()})
                yield pa.RecordBatch.from_pylist(found)

        return self._with_audits().mapInArrow(hashed, "conv string, sha256 string")

    def _with_audits(self) -> DataFrame:
        """Each conversation's audit and then its rows, in order, for one task to walk along."""
        audits = self.reports.select(
            "conv",
            F.lit(0).alias("kind"),
            F.lit(None).cast("long").alias("turn"),
            F.lit("").alias("role"),
            F.col("audit").alias("text"),
        )
        every = audits.unionByName(self.rows.withColumn("kind", F.lit(1)))
        conv, *order = in_order()
        ordered = every.repartition("conv").sortWithinPartitions(conv, "kind", *order)
        return ordered.select("conv", "kind", *[F.col(c).cast("binary") for c in ("role", "text")])


def repaired_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, bytes, bytes]]:
    """(conv, role, text) of the repaired rows, from audits and rows in order."""
    conv, letters, at, state = None, "", 0, START

    def inserted():
        nonlocal at, state
        while letters[at : at + 1] == "I":
            initial = NEXT[state][-1]
            at, state = at + 1, STATE_OF[initial]
            yield conv, ROLE_OF[initial].encode(), b""

    for batch in batches:
        for name, kind, role, text in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            yield from inserted()
            if kind == 0:
                conv, letters, at, state = name, text.decode(), 0, START
                continue
            letter, at = letters[at], at + 1
            if letter == "D":
                continue
            if letter == "R":
                role = ROLE_OF[NEXT[state][-1]].encode()
            state = STATE_OF[role[:1].decode()]
            yield conv, role, text
    yield from inserted()


def key_of(column) -> Column:
    """A conversation's key; null is one of its own."""
    return F.coalesce(F.concat(F.lit("="), F.col(column).cast("string")), F.lit(""))


def repair_conversations(
    rows: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    rows_per_block: int = 64,
    blocks_per_group: int = 64,
) -> Repair:
    """Find the cheapest repair of each conversation.

    Keeping a row is free, giving it the role user or assistant costs 3, deleting it 4, putting in an empty
    row of one of these roles 3, and 3 more go for each row left with a truncated text (one that doesn't
    end in `.`, `!` or `?`). A row whose text is blank, or whose role and text were seen before in the
    conversation, must go.

    A null role or text counts as one space. Null turns come first; rows of one turn are taken by role and
    text, so that equal rows and ties have a fixed order. Only the first characters of roles count; a row
    with another one than s, u or a, or with an empty role, can't be kept as it is. Conversations are told
    by `key_of` their id, so a null id is one conversation. An empty table gives empty reports; other
    columns are ignored. A conversation of any length is searched in blocks; its repaired rows, which its
    hash needs in one order, are walked along by one task, row by row.
    """
    clean = rows.select(
        key_of(f"`{conv_col}`").alias("conv"),
        F.col(f"`{turn_col}`").cast("long").alias("turn"),
        F.coalesce(F.col(f"`{role_col}`").cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(" ")).alias("text"),
    )
    marked = written(with_faults(numbered(clean)))
    blocks = written(searched(blocks_of(marked, rows_per_block)))
    numbers = F.transform(
        "paths", lambda p: F.struct(*[p[c].alias(c) for c in ("state", "goal", "cost", "rank")])
    )
    levels = levels_of(blocks.select("conv", "block", numbers.alias("paths")), blocks_per_group)
    ends, chosen = chosen_states(levels, blocks_per_group)

    is_chosen = F.filter(
        "paths", lambda p: (p["state"] == F.col("state")) & (p["goal"] == F.col("goal"))
    )
    letters = F.get(is_chosen, 0)["letters"]
    parts = blocks.join(chosen, ["conv", "block"]).groupBy("conv").agg(
        F.sum("illegal").alias("illegal"),
        F.sort_array(F.collect_list(F.struct("block", letters.alias("letters")))).alias("parts"),
    )
    endings = F.create_map(*[F.lit(x) for pair in ENDING.items() for x in pair])
    audit = F.concat(F.array_join("parts.letters", ""), endings[F.col("goal")])
    counts = [
        F.count_if(F.col("fault") == fault).alias(f"n_{fault}")
        for fault in ("blank", "duplicate", "truncated")
    ]
    faults = marked.groupBy("conv").agg(
        *counts, F.min("turn").alias("low"), F.max("turn").alias("high")
    )
    turns = marked.select("conv", "turn").distinct().groupBy("conv").agg(F.count("turn").alias("turns"))
    gaps = F.coalesce(F.col("high") - F.col("low") + 1 - F.col("turns"), F.lit(0).cast("long"))
    reports = (
        ends.join(parts, "conv")
        .join(faults, "conv")
        .join(turns, "conv")
        .select(
            *("conv", gaps.alias("gaps"), "n_blank", "n_duplicate", "n_truncated", "illegal", "cost"),
            audit.alias("audit"),
        )
    )
    return Repair(written(reports), clean)
