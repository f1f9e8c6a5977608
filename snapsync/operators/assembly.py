"""Ordered assembly of texts and name lists."""

from pyspark.sql import DataFrame, functions as F

from snapsync.functions.text import or_empty
from snapsync.operators.ordering import number_parts
from snapsync.settings import Settings


def joined_in_order(order, text, separator=""):
    """Join the group's texts in order; the text itself settles what the order leaves open."""
    rows = F.sort_array(F.collect_list(F.struct(*order, text.alias("_text"))))
    return F.array_join(rows["_text"], separator)


def nested_lines(
    lines: DataFrame,
    keys,
    line="line",
    ties=(),
    text="text",
    lines_per_block=Settings.lines_per_block,
) -> DataFrame:
    """One row per key with its lines as an ordered array<struct<line, text>>, put together block by
    block as in `assemble_text`."""
    rows = F.sort_array(F.collect_list(F.struct(line, *ties, text)))
    pairs = F.arrays_zip(rows[line].alias("line"), rows[text].alias("text"))
    blocks = F.sort_array(F.collect_list(F.struct("_block", F.col("_lines"))))
    return (
        _blocks(lines, list(keys), line, lines_per_block)
        .agg(pairs.alias("_lines"))
        .groupBy(*keys)
        .agg(F.flatten(blocks["_lines"]).alias("lines"))
    )


def _blocks(lines: DataFrame, keys: list, line: str, lines_per_block: int):
    """Lines grouped by key and block of line numbers. They are moved once, by the key alone: that
    also places the blocks of a key together, so that no later grouping moves anything."""
    block = F.floor(F.col(line) / lines_per_block)
    return lines.withColumn("_block", block).repartition(*keys).groupBy(*keys, "_block")


def assemble_text(
    lines: DataFrame,
    keys,
    line="line",
    ties=(),
    text="text",
    lines_per_block=Settings.lines_per_block,
) -> DataFrame:
    """One text per key: every line in order, each followed by a line end; null lines are empty.

    A task holds the lines of one block at a time and the joined blocks of one text, which is one
    cell in the end. Lines are read and moved once, and before they are collected: collecting first
    would not make them fewer, only larger.
    """
    keys = list(keys)
    piece = F.concat(or_empty(F.col(text)), F.lit("\n"))
    return (
        _blocks(lines, keys, line, lines_per_block)
        .agg(joined_in_order([line, *ties], piece).alias("_block_text"))
        .groupBy(*keys)
        .agg(joined_in_order(["_block"], F.col("_block_text")).alias("text"))
    )


def list_names(
    df: DataFrame, groups, name: str, separator=", ", per_row=Settings.names_per_message, how="ranges"
) -> DataFrame:
    """Distinct names of each group, ascending, as one text per `per_row` names.

    `part_no` counts the texts of a group from 0; only a group with more names than that has
    a second one.
    """
    groups = list(groups)
    distinct = df.select(*groups, name).where(F.col(name).isNotNull()).distinct()
    parts = number_parts(distinct, groups, [name], per_row, "part_no", how)
    return parts.groupBy(*groups, "part_no").agg(
        joined_in_order([name], F.col(name), separator).alias("names")
    )
