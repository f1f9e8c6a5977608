"""Selections by time, user and key."""

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, functions as F

from snapsync.functions.times import days


def in_window(time: Column, last: Column, as_of: Column) -> Column:
    """Closed at both ends, so consecutive polls share their border."""
    return time.between(last, as_of)


def in_lookback(time: Column, as_of: Column, interval: Column) -> Column:
    """Strict and open towards the future."""
    return time > as_of - interval


def above_floor(modified: Column, as_of: Column, floor_days: int) -> Column:
    return modified >= as_of - days(floor_days)


def allowed_users(allowed: DataFrame, user="user_name") -> DataFrame:
    return allowed.select(F.upper(user).alias("_user")).where("_user is not null").distinct()


def by_allow_list(df: DataFrame, allowed: DataFrame, user="user_modified") -> DataFrame:
    """Rows whose user is listed, in any case; a null user is not."""
    users = allowed_users(allowed)
    return df.join(users, F.upper(user) == F.col("_user"), "left_semi")


def with_allowed(df: DataFrame, allowed: DataFrame, user="user_modified") -> DataFrame:
    """Add `allowed` instead of filtering."""
    users = allowed_users(allowed).withColumn("allowed", F.lit(True))
    return (
        df.join(users, F.upper(user) == F.col("_user"), "left")
        .drop("_user")
        .withColumn("allowed", F.coalesce("allowed", F.lit(False)))
    )


OBJECT_KEY = ("source_db", "type", "class_id", "short_name")
NAME_KEY = ("source_db", "class_id", "short_name")


def by_keys(df: DataFrame, keys: DataFrame, on=OBJECT_KEY) -> DataFrame:
    return df.join(keys.select(*on).distinct(), list(on), "left_semi")


def by_folder(df: DataFrame, tree: DataFrame, kind: str | None = None, upper=True) -> DataFrame:
    """Rows named in the tree's folders; the tree's name, not the row's, is upper-cased."""
    return by_keys(df, folder_keys(tree, kind, upper), NAME_KEY)


def folder_keys(tree: DataFrame, kind: str | None = None, upper=True) -> DataFrame:
    if kind is not None:
        tree = tree.where(F.col("type") == kind)
    name = F.upper("short_name") if upper else F.col("short_name")
    return tree.select("source_db", "class_id", name.alias("short_name")).distinct()


def parse_object_list(df: DataFrame, text: str) -> DataFrame:
    """Rows (class_id, short_name) of texts like A.B,C.D; pieces after a second dot are ignored."""
    pairs = df.select(F.explode(F.split(text, ",")).alias("_pair"))
    pieces = F.split("_pair", r"\.")
    return pairs.select(
        F.get(pieces, F.lit(0)).alias("class_id"), F.get(pieces, F.lit(1)).alias("short_name")
    )


def by_list(df: DataFrame, listed: DataFrame, text: str) -> DataFrame:
    return by_keys(df, parse_object_list(listed, text), ("class_id", "short_name"))


def outside_folders(folder: Column, excluded) -> Column:
    return ~folder.isin(*excluded)


def any_null(df: DataFrame) -> DataFrame:
    return df.where(reduce(or_, [F.col(c).isNull() for c in df.columns]))
