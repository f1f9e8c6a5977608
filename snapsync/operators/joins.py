"""Joins that treat null keys as equal, and membership tests."""

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, functions as F


def join_null_safe(left: DataFrame, right: DataFrame, keys, how: str) -> DataFrame:
    """Equi join where null equals null; the right keys are dropped."""
    renamed = right.withColumnsRenamed({k: f"_right_{k}" for k in keys})
    on = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_right_{k}")) for k in keys])
    joined = left.join(renamed, on, how)
    return joined.drop(*[f"_right_{k}" for k in keys])


def flagged(df: DataFrame, members: DataFrame, on, alias: str) -> DataFrame:
    """Add a boolean: does the row's key occur in `members`? Never filters or repeats rows."""
    keys = members.select(*on).distinct().withColumn(alias, F.lit(True))
    return df.join(keys, list(on), "left").withColumn(alias, F.coalesce(alias, F.lit(False)))


def known_size(df: DataFrame, most: int = 10_000) -> DataFrame:
    """A table of few rows (one per source or per poll) as a local one, whose size the optimizer
    knows: the large side of a join with it is not shuffled by the few keys. A larger table stays as
    it is."""
    if df.isStreaming:
        return df
    rows = df.limit(most + 1).toArrow()
    return df.sparkSession.createDataFrame(rows, df.schema) if rows.num_rows <= most else df


def with_bounds(df: DataFrame, bounds: DataFrame) -> DataFrame:
    """Add `last` and `as_of` of each row's source; bounds has one row per source."""
    return df.join(known_size(bounds.select("source_db", "last", "as_of")), "source_db")
