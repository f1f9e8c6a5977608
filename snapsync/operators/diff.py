"""Comparison of a change feed or a source listing with a stored snapshot."""

from pyspark.sql import Column, DataFrame, functions as F

from snapsync.functions.text import nonempty, text_sha
from snapsync.operators.joins import join_null_safe
from snapsync.operators.ordering import with_previous


def diff_indicator(left: DataFrame, right: DataFrame, keys) -> DataFrame:
    """Every distinct key with left_only, right_only or both; null keys compare equal.

    A tagged union with one aggregate: duplicates fold before the shuffle, and there is only one.
    """
    tagged = left.select(*keys, F.lit(True).alias("_l"), F.lit(False).alias("_r")).unionByName(
        right.select(*keys, F.lit(False).alias("_l"), F.lit(True).alias("_r"))
    )
    sides = tagged.groupBy(*keys).agg(F.bool_or("_l").alias("_l"), F.bool_or("_r").alias("_r"))
    side = F.when(F.col("_l") & F.col("_r"), "both").when(F.col("_l"), "left_only")
    return sides.select(*keys, side.otherwise("right_only").alias("side"))


def stale_objects(stored: DataFrame, source: DataFrame, keys) -> DataFrame:
    """Distinct stored keys that the source no longer has."""
    return stored.select(*keys).subtract(source.select(*keys))


def stale_not_recent(stored, source, recent, keys) -> DataFrame:
    """Stale keys without those changed since a given time."""
    return stale_objects(stored, source, keys).subtract(recent.select(*keys))


def _baseline_of(rows: DataFrame, baseline: DataFrame, keys) -> DataFrame:
    """The baseline rows that `rows` can meet: a small feed is sent to the large table, so that
    the large table is filtered where it is read."""
    return baseline.join(rows.select(*keys).distinct(), list(keys), "left_semi")


def with_dirty(rows: DataFrame, baseline: DataFrame, keys, sha: Column) -> DataFrame:
    """Add `dirty`: the row's text differs from the baseline's, or the baseline has none."""
    stored = _baseline_of(rows, baseline.select(*keys, "text_sha"), keys).withColumnRenamed(
        "text_sha", "_stored_sha"
    )
    return (
        rows.join(stored, list(keys), "left")
        .withColumn("dirty", ~F.col("_stored_sha").eqNullSafe(sha))
        .drop("_stored_sha")
    )


def changed_vs_baseline(rows: DataFrame, baseline: DataFrame, keys, text="text") -> DataFrame:
    """Rows whose text differs from the baseline. Texts are compared by hash, so the stored texts
    are neither read nor moved; `baseline` has unique keys and text_sha."""
    return with_dirty(rows, baseline, keys, text_sha(F.col(text))).where("dirty").drop("dirty")


def effective_changes(
    rows: DataFrame, baseline: DataFrame, keys, order, text="text", how="ranges"
) -> DataFrame:
    """Rows that flip their path between equal to the baseline and different from it.

    `order` names columns that, with the keys, tell rows apart. Only they and the hash go through
    the ordered pass; the texts of the rows that flip are fetched after it.
    """
    place = [*keys, *order]
    hashed = rows.select(*place, text_sha(F.col(text)).alias("_sha"))
    marked = with_dirty(hashed, baseline, keys, F.col("_sha")).drop("_sha")
    before = with_previous(marked, list(keys), order, F.col("dirty"), "_before", how)
    flips = F.col("dirty") != F.coalesce(F.col("_before.value"), F.lit(False))
    found = before.where(flips).select(*place, "dirty")
    return join_null_safe(rows, found, place, "inner")


def upsert_with_delete(stored: DataFrame, rows: DataFrame, keys, text="text") -> DataFrame:
    """Stored rows replaced by new rows of the same key; a null or empty new text deletes.

    The stored side is filtered by the new keys and never joined as a whole.
    """
    kept = join_null_safe(stored, rows.select(*keys).distinct(), keys, "left_anti")
    return kept.unionByName(rows.where(nonempty(F.col(text))).select(*stored.columns))


def remove_objects(stored: DataFrame, removed: DataFrame, keys) -> DataFrame:
    return join_null_safe(stored, removed.select(*keys).distinct(), keys, "left_anti")


def drop_unknown(stored: DataFrame) -> DataFrame:
    return stored.where(F.col("type") != "UNKNOWN")
