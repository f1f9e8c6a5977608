"""The engine's tables out of several databases, each read by a function of its own."""

from collections.abc import Callable
from dataclasses import fields
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from snapsync.sources.catalog import Tables

Reader = Callable[[str], DataFrame]
# What a reader is asked for; the rest of Tables is made here.
MADE = ("line_ties", "method_state", "criteria_state")
TABLES = tuple(f.name for f in fields(Tables) if f.name not in MADE)


def labelled(sources: dict[str, Reader], table: str) -> DataFrame:
    """One table of all sources, each row with its source's name in `source_db`."""
    parts = [read(table).withColumn("source_db", F.lit(name)) for name, read in sources.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def read_sources(
    sources: dict[str, Reader], line_ties=(), names=TABLES
) -> tuple[Tables, DataFrame, DataFrame]:
    """(tables, now, restored) of the sources, each a function from a table's name to its rows.

    Beside the tables a reader gives `now`: one row with the source's `as_of` and `local_time`, read
    before anything else, and `marker`: rows where the source still bears the mark that a poll left;
    one without is counted as restored.
    """
    now = labelled(sources, "now").select("source_db", "as_of", "local_time")
    marks = labelled(sources, "marker").select("source_db").distinct()
    restored = now.select("source_db").join(marks, "source_db", "left_anti")
    tables = {name: labelled(sources, name) for name in names}
    return Tables(**tables, line_ties=tuple(line_ties)), now, restored
