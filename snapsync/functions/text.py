"""Expressions on object texts."""

from pyspark.sql import Column, functions as F

# The characters that a Unicode strip removes, as a regular-expression class body.
WHITESPACE = (
    r"\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)
# Fixed value: the head of every trigger text.
TRIGGER_HEAD = "CREATE OR REPLACE TRIGGER "


def or_empty(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def nonblank(c: Column) -> Column:
    """True where the text has a character other than white space; null text is not a text."""
    return F.coalesce(c.rlike(f"[^{WHITESPACE}]"), F.lit(False))


def nonempty(c: Column) -> Column:
    """False for null and for '': such a text removes its file instead of writing it."""
    return F.coalesce(c != "", F.lit(False))


def view_text(condition: Column, order_by: Column, group_by: Column) -> Column:
    return F.concat(or_empty(condition), or_empty(order_by), or_empty(group_by))


def trigger_text(description: Column, body: Column) -> Column:
    return F.concat(F.lit(TRIGGER_HEAD), or_empty(description), or_empty(body))


def normalized_text(c: Column) -> Column:
    """Drop blanks before each line end and end lines with CR LF.

    The look-behind starts a match only at the head of a run of blanks, so that a long run that no
    line end follows is scanned once.
    """
    return F.regexp_replace(c, r"(?<![ \t\r\f\x0B])[ \t\r\f\x0B]*+\n", "\r\n")


def line_slice(c: Column) -> Column:
    """The n lines that follow line 2, where line 2 holds n; null when it holds no number."""
    lines = F.split(c, "\n")
    n = F.trim(F.get(lines, F.lit(1))).try_cast("int")
    length = F.when(n < 0, 0).otherwise(n)
    return F.array_join(F.slice(lines, F.lit(3), length), "\n")


def text_sha(c: Column) -> Column:
    return F.sha2(F.encode(c, "UTF-8"), 256)


def strip_domain(c: Column) -> Column:
    """The piece after the last dot."""
    return F.substring_index(c, ".", -1)
