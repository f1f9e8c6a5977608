"""Personal data: generators propose spans, boosted trees judge them, thresholds select.

Generators are patterns with a high recall; their spans may overlap. A span's format and context
become a few binned features. Trees learn from all proposed spans which formats and contexts go with
spans that pass their kind's own check (check digit, range, number of digits), and select further
spans of the same look beside those that pass. Spans of the base patterns that pass always stay.
"""

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import boosting
from .common import id_and_text, written

# Patterns start only where a run of their characters starts or the last match ended, and take
# whole runs at once: the same matches, without trying every place of a long run.
_MAIL = r"[A-Za-z0-9._%+-]"
GENERATORS = [
    # name, kind, base?, pattern, text that must be there
    (
        "email",
        "email",
        True,
        rf"(?:\G|(?<!{_MAIL})){_MAIL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
        "@",
    ),
    (
        "ip",
        "ip",
        True,
        r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
        None,
    ),
    ("card", "card", True, r"(?:\G|(?<![0-9]))[0-9](?:[\x20-]?[0-9]){11,}+", None),
    ("phone", "phone", True, r"\+[0-9][\x20().0-9-]+[0-9]", "+"),
    (
        "written_email",
        "email",
        False,
        r"(?i)\b[a-z0-9._%+-]{1,64}\s?[(\[{]\s?at\s?[)\]}]\s?[a-z0-9-]{1,63}"
        r"(?:\s?(?:\.|[(\[{]\s?dot\s?[)\]}])\s?[a-z0-9-]{1,63}){1,5}",
        None,
    ),
    (
        "national_phone",
        "phone",
        False,
        r"(?<![0-9+.-])(?:\([0-9]{2,5}\)|0[0-9]{1,4})[\x20./-]{1,2}[0-9]{2,4}(?:[\x20.-][0-9]{2,4}){1,4}(?![0-9])",
        None,
    ),
    (
        "dashed_phone",
        "phone",
        False,
        r"(?<![0-9+.-])[0-9]{3}[.\x20-][0-9]{3}[.\x20-][0-9]{4}(?![0-9])",
        None,
    ),
]
KINDS = ("email", "ip", "card", "phone")
CONTEXT = 24
KEYWORDS = (
    r"(?i)(?:e-?mail|mail|tel|phone|fon|call|fax|mobil|contact|card|visa|master|credit|ip|addr|host|server)"
    r"[^\n]{0,16}$"
)
FEATURES = ["generator", "digits", "separators", "before", "after", "keyword", "size"]
PRECISION = 0.95


def _proposed(text: Column, number: int, pattern: str, needs: str | None) -> Column:
    """Spans of one pattern in order: matched text, length of the gap before it, its context."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)
    spans = F.transform(
        found,
        lambda match, i: F.struct(
            F.lit(number).alias("generator"),
            i.alias("place"),
            match.alias("match"),
            F.char_length(F.get(gaps, i)).alias("gap"),
            F.right(F.get(gaps, i), F.lit(CONTEXT)).alias("left"),
            F.left(F.get(gaps, i + 1), F.lit(4)).alias("right"),
        ),
    )
    may = F.rlike(text, F.lit("[0-9]")) if needs is None else F.contains(text, F.lit(needs))
    if GENERATORS[number][0] == "written_email":
        may = F.rlike(text, F.lit(r"(?i)[(\[{]\s?at\s?[)\]}]"))
    return F.when(may, spans).otherwise(F.array().cast(_SPANS))


_SPANS = (
    "array<struct<generator:int,place:int,match:string,gap:int,left:string,right:string>>"
)


def luhn(digits: Column) -> Column:
    """Does the check digit of a string of digits fit?"""
    total = F.aggregate(
        F.transform(
            F.split(F.reverse(digits), ""),
            lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(
                (d.cast("int") * 2) - F.when(d.cast("int") > 4, 9).otherwise(0)
            ),
        ),
        F.lit(0),
        lambda a, d: a + F.coalesce(d, F.lit(0)),
    )
    return total % 10 == 0


def passes(kind: Column, match: Column, digits: Column) -> Column:
    count = F.char_length(digits)
    parts = F.transform(F.split(match, r"\."), lambda p: F.ltrim(p, F.lit("0")))
    octets = F.forall(
        parts,
        lambda p: (F.char_length(p) < 3) | ((F.char_length(p) == 3) & (p <= "255")),
    )
    return (
        F.when(kind == "email", F.lit(True))
        .when(kind == "ip", octets)
        .when(kind == "card", F.when(count.between(12, 19), luhn(digits)).otherwise(F.lit(False)))
        .otherwise(count.between(9, 15))
    )


def _class(character: Column) -> Column:
    return (
        F.when((character == "") | character.isNull(), 0)
        .when(F.rlike(character, F.lit(r"^\s")), 1)
        .when(F.rlike(character, F.lit("^[0-9]")), 2)
        .when(F.rlike(character, F.lit(r"^\p{L}")), 3)
        .when(F.rlike(character, F.lit("^[.,;:!?]")), 4)
        .otherwise(5)
    )


def candidates(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows, spans): a numbered row per document and all proposed spans with their features. Both
    come from one written table, so that the numbers hold."""
    text = F.col("text")
    proposed = F.concat(
        *[_proposed(text, n, pattern, needs) for n, (_, _, _, pattern, needs) in enumerate(GENERATORS)]
    )
    rows = written(
        docs.select(F.monotonically_increasing_id().alias("row"), "id", proposed.alias("spans"))
    )
    order = Window.partitionBy("row", "generator").orderBy("place")
    length = F.char_length("match")
    start = F.sum(F.col("gap") + length).over(order) - length
    kind = F.element_at(F.array(*[F.lit(g[1]) for g in GENERATORS]), F.col("generator") + 1)
    base = F.col("generator").isin(*[n for n, g in enumerate(GENERATORS) if g[2]])
    digits = F.regexp_replace("match", "[^0-9]", "")
    n = F.char_length(digits)
    spans = (
        rows.select("row", F.explode("spans").alias("s"))
        .select("row", "s.*")
        .select(
            "row",
            "generator",
            kind.alias("kind"),
            base.alias("base"),
            "match",
            start.alias("start"),
            (start + length).alias("stop"),
            passes(kind, F.col("match"), digits).alias("passes"),
            F.when(n == 0, 0).when(n < 7, 1).when(n < 9, 2).when(n < 12, 3).when(n < 16, 4)
            .when(n == 16, 5).when(n < 20, 6).otherwise(7).alias("digits"),
            F.size(F.array_distinct(F.split(F.regexp_replace("match", r"[\p{L}0-9]", ""), "")))
            .alias("separators"),
            _class(F.right("left", F.lit(1))).alias("before"),
            _class(F.left("right", F.lit(1))).alias("after"),
            F.rlike("left", F.lit(KEYWORDS)).cast("int").alias("keyword"),
            F.least(F.lit(8), F.floor(length / 4)).cast("int").alias("size"),
        )
        .withColumn("separators", F.least("separators", F.lit(4)))
    )
    return rows, spans


@dataclass
class Model:
    trees: boosting.Trees
    thresholds: list[float]


def fit(spans: DataFrame, precision: float = PRECISION) -> Model:
    """Trees from all proposed spans, by their counts per combination of bins (bounded by the number
    of combinations). One half of the rows grows the trees, the other one sets each generator's
    threshold: from there on `precision` of the spans pass their check."""
    counted = (
        spans.groupBy((F.xxhash64("row") % 2 == 0).alias("half"), *FEATURES)
        .agg(F.count_if("passes").alias("good"), F.count_if(~F.col("passes")).alias("bad"))
        .collect()
    )
    counted.sort(key=lambda r: tuple(r))
    grown = [r for r in counted if r.half]
    held = [r for r in counted if not r.half]
    take = lambda rows: np.array([[r[f] for f in FEATURES] for r in rows], np.int64).reshape(-1, len(FEATURES))
    trees = boosting.fit(take(grown), [r.good for r in grown], [r.bad for r in grown])
    p = 1 / (1 + np.exp(-trees.logits(take(held))))
    thresholds = []
    for number in range(len(GENERATORS)):
        own = np.array([r.generator == number for r in held], bool)
        good, bad = (np.array([r[k] for r in held], float)[own] for k in ("good", "bad"))
        thresholds.append(boosting.threshold(p[own], good, bad, precision))
    return Model(trees, thresholds)


def find_personal_data(
    docs: DataFrame, precision: float = PRECISION, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per document: `id` and `spans`, an array of (start, kind number, kind, stop, base,
    score) in order; places are code points from 0, the stop is exclusive.

    Base spans are all that pass their check. A further span is taken if its score reaches the
    threshold and it overlaps no base span and no span taken before it. Null and empty texts have no
    spans. Ids may be null or repeat; every row is judged on its own. An empty table gives no rows.
    """
    rows, spans = candidates(id_and_text(docs, id_col, text_col))
    spans = written(spans)
    model = fit(spans, precision)
    limit = F.element_at(F.array(*[F.lit(t) for t in model.thresholds]), F.col("generator") + 1)
    scored = spans.withColumn("score", model.trees.column(FEATURES)).withColumn(
        "sure", F.col("base") & F.col("passes")
    )
    chosen = scored.where(F.col("sure") | (F.col("score") >= limit))
    # Further spans that meet a base span: the nearest base ends before and starts after tell.
    by_start = Window.partitionBy("row").orderBy("start", F.col("sure").desc(), "stop", "generator")
    before = by_start.rowsBetween(Window.unboundedPreceding, -1)
    after = by_start.rowsBetween(1, Window.unboundedFollowing)
    met = (F.coalesce(F.max(F.when(F.col("sure"), F.col("stop"))).over(before), F.lit(-1)) > F.col("start")) | (
        F.coalesce(F.min(F.when(F.col("sure"), F.col("start"))).over(after), F.lit(1 << 62)) < F.col("stop")
    )
    free = chosen.withColumn("met", met).where(F.col("sure") | ~F.col("met"))
    reach = F.coalesce(F.max("stop").over(before), F.lit(-1))
    taken = free.withColumn("reach", reach).where(F.col("sure") | (F.col("reach") <= F.col("start")))
    number = F.array_position(F.array(*[F.lit(k) for k in KINDS]), F.col("kind"))
    lists = taken.groupBy("row").agg(
        F.array_sort(
            F.collect_list(F.struct("start", number.alias("number"), "kind", "stop", F.col("sure").alias("base"), "score"))
        ).alias("found")
    )
    empty = "array<struct<start:bigint,number:bigint,kind:string,stop:bigint,base:boolean,score:double>>"
    return rows.join(lists, "row", "left").select(
        "id", F.coalesce(F.col("found").cast(empty), F.array().cast(empty)).alias("spans")
    )
