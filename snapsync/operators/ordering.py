"""Ordered passes over groups of any size: row numbers, previous values, runs of equal values.

The rows are cut into ranges of the sort order, so that a group spans as many tasks as it needs; each
slice is numbered on its own and one row per slice and group carries the state over the borders.
The range-sorted rows are written once, because both passes must see the same cuts.

`order` must be total within a group. `how` is "ranges" or, where the caller knows that every group
fits one task, "window".
"""

from pyspark.sql import Column, DataFrame, Window, functions as F

from snapsync.operators.joins import join_null_safe
from snapsync.operators.sizing import written

ROW, SLICE = "_row", "_slice"
# monotonically_increasing_id keeps the partition number above this bit.
PARTITION_BIT = 33


def in_one_task(how: str) -> bool:
    """May one task hold a whole group?"""
    if how not in ("window", "ranges"):
        raise ValueError(f"unknown way: {how}")
    return how == "window"


def _ranges(df: DataFrame, groups, order) -> DataFrame:
    by = [*groups, *order]
    ranked = (
        df.repartitionByRange(*by)
        .sortWithinPartitions(*by)
        .withColumn(ROW, F.monotonically_increasing_id())
    )
    return written(ranked, "ranges").withColumn(SLICE, F.shiftright(ROW, PARTITION_BIT))


def _across_slices(groups):
    return Window.partitionBy(*groups).orderBy(SLICE)


def _earlier_slices(groups):
    return _across_slices(groups).rowsBetween(Window.unboundedPreceding, -1)


def number_rows(df, groups, order, alias="position", how="ranges") -> DataFrame:
    """Add the 1-based position of each row in its group."""
    if in_one_task(how):
        position = F.row_number().over(Window.partitionBy(*groups).orderBy(*order))
        return df.withColumn(alias, position.cast("bigint"))
    rows = _ranges(df, groups, order)
    slices = (
        rows.groupBy(*groups, SLICE)
        .agg(F.min(ROW).alias("_first"), F.count(F.lit(1)).alias("_n"))
        .withColumn("_before", F.coalesce(F.sum("_n").over(_earlier_slices(groups)), F.lit(0)))
        .drop("_n")
    )
    return (
        join_null_safe(rows, slices, [*groups, SLICE], "inner")
        .withColumn(alias, F.col("_before") + F.col(ROW) - F.col("_first") + 1)
        .drop(ROW, SLICE, "_first", "_before")
    )


def number_parts(df, groups, order, size: int, alias="part_no", how="ranges") -> DataFrame:
    """Cut each group into parts of `size` rows in order, counted from 0."""
    placed = number_rows(df, groups, order, "_position", how)
    return placed.withColumn(alias, _part("_position", size)).drop("_position")


def _part(position: str, size: int) -> Column:
    return F.floor((F.col(position) - 1) / size)


def with_previous(df, groups, order, value: Column, alias="previous", how="ranges") -> DataFrame:
    """Add struct<value> of the row before in the group; null struct on the first row."""
    boxed = F.struct(value.alias("value"))
    if in_one_task(how):
        return df.withColumn(alias, F.lag(boxed).over(Window.partitionBy(*groups).orderBy(*order)))
    rows = _ranges(df, groups, order)
    slices = (
        rows.groupBy(*groups, SLICE)
        .agg(F.max_by(boxed, F.col(ROW)).alias("_last"))
        .withColumn("_carried", F.lag("_last").over(_across_slices(groups)))
        .drop("_last")
    )
    inside = F.lag(boxed).over(Window.partitionBy(*groups, SLICE).orderBy(ROW))
    return (
        join_null_safe(rows.withColumn(alias, inside), slices, [*groups, SLICE], "inner")
        .withColumn(alias, F.coalesce(alias, "_carried"))
        .drop(ROW, SLICE, "_carried")
    )


def number_runs(df, groups, order, value: Column, alias="run", how="ranges") -> DataFrame:
    """Number, from 1 in each group, the runs of consecutive rows with equal (or both null) value."""
    boxed = F.struct(value.alias("value"))
    if in_one_task(how):
        w = Window.partitionBy(*groups).orderBy(*order)
        return (
            df.withColumn("_starts", (~F.lag(boxed).over(w).eqNullSafe(boxed)).cast("bigint"))
            .withColumn(alias, F.sum("_starts").over(_running(w)))
            .drop("_starts")
        )
    w = Window.partitionBy(*groups, SLICE).orderBy(ROW)
    rows = (
        _ranges(df, groups, order)
        .withColumn("_starts", (~F.lag(boxed).over(w).eqNullSafe(boxed)).cast("bigint"))
        .withColumn("_local", F.sum("_starts").over(_running(w)))
        .drop("_starts")
    )
    # A slice whose first value equals the last value before it goes on with that run.
    slices = (
        rows.groupBy(*groups, SLICE)
        .agg(
            F.max("_local").alias("_n"),
            F.min_by(boxed, F.col(ROW)).alias("_head"),
            F.max_by(boxed, F.col(ROW)).alias("_tail"),
        )
        .withColumn(
            "_goes_on",
            F.lag("_tail").over(_across_slices(groups)).eqNullSafe(F.col("_head")).cast("bigint"),
        )
        .withColumn("_new", F.col("_n") - F.col("_goes_on"))
        .withColumn("_before", F.coalesce(F.sum("_new").over(_earlier_slices(groups)), F.lit(0)))
        .select(*groups, SLICE, (F.col("_before") - F.col("_goes_on")).alias("_offset"))
    )
    return (
        join_null_safe(rows, slices, [*groups, SLICE], "inner")
        .withColumn(alias, F.col("_local") + F.col("_offset"))
        .drop(ROW, SLICE, "_local", "_offset")
    )


def _running(window):
    return window.rowsBetween(Window.unboundedPreceding, Window.currentRow)


def latest_row(df: DataFrame, keys, newest_first) -> DataFrame:
    """Newest row of each key. The rank filter also runs before the shuffle, so that a key with
    many rows reaches the next stage as one row per task."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*newest_first))
    return df.withColumn("_rank", rank).where("_rank = 1").drop("_rank")
