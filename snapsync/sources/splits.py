"""Splits of a scan: predicates on a key that parts a table into ranges of about equal counts."""

import datetime

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import DateType, DecimalType, IntegralType, TimestampNTZType

# Fixed value: the accuracy of the quantile sketch; a bound is off by at most 1/10,000 of the rows.
ACCURACY = 10_000
KINDS = (IntegralType, DecimalType, DateType, TimestampNTZType)


def plan_splits(keys: DataFrame, column: str, n: int, then: str | None = None) -> list[str]:
    """About `n` SQL predicates of which each row fulfils exactly one, whatever its key is, also rows that
    come later.

    `keys` has the column (of whole numbers, decimals, dates or times without zone; texts are refused, as
    databases order them each in their own way). Bounds come from a quantile sketch, so one row of them
    reaches the driver. Null keys have splits of their own. A key that holds several n-ths of the rows is
    one split, or, if a second column `then` is given, as many ranges of that one; so are null keys.
    """
    if n < 1:
        raise ValueError("n must be at least 1")
    for name in filter(None, [column, then]):
        if not isinstance(keys.schema[name].dataType, KINDS):
            raise TypeError(f"{name} is no number, date or time without zone")
    key = F.col(f"`{column}`")
    steps = [i / n for i in range(1, n)] or [0.5]
    found = keys.agg(
        F.percentile_approx(key, steps, ACCURACY).alias("at"),
        F.count("*").alias("rows"),
        F.count(key).alias("known"),
    ).first()
    bounds = sorted(found.at or []) if n > 1 else []
    hot = {b: bounds.count(b) for b in set(bounds) if bounds.count(b) > 1}
    nulls = max(1, -(-(found.rows - found.known) * n // found.rows)) if found.rows else 1
    parts = {**hot, None: nulls}
    inner = _inner_bounds(keys, column, then, parts) if then else {}
    splits = []
    for value, count in parts.items():
        same = f"{column} is null" if value is None else f"{column} = {_literal(value)}"
        cuts = inner.get(value, []) if count > 1 else []
        splits += [same if r is None else f"{same} and {r}" for r in _ranges(then, cuts)]
    cuts = sorted(set(bounds))
    for low, high in zip([None, *cuts], [*cuts, None]):
        after = [] if low is None else [f"{column} {'>' if low in hot else '>='} {_literal(low)}"]
        before = [] if high is None else [f"{column} < {_literal(high)}"]
        splits.append(" and ".join(after + before) or f"{column} is not null")
    return splits


def _ranges(column, cuts):
    """Predicates of the ranges between cuts, [None] without any; nulls go with the first."""
    if not cuts:
        return [None]
    out = []
    for low, high in zip([None, *cuts], [*cuts, None]):
        if low is None:
            out.append(f"({column} < {_literal(high)} or {column} is null)")
        else:
            up = "" if high is None else f" and {column} < {_literal(high)}"
            out.append(f"{column} >= {_literal(low)}{up}")
    return out


def _inner_bounds(keys: DataFrame, column: str, then: str, parts: dict) -> dict:
    """Cuts of `then` within the values that need several splits: at most one row per bound."""
    wanted = [v for v, count in parts.items() if count > 1]
    if not wanted:
        return {}
    key = F.col(f"`{column}`")
    chosen = key.isin([v for v in wanted if v is not None])
    if None in wanted:
        chosen = F.coalesce(chosen, F.lit(True))
    steps = sorted({i / parts[v] for v in wanted for i in range(1, parts[v])})
    rows = keys.where(chosen).groupBy(key.alias("v")).agg(
        F.percentile_approx(F.col(f"`{then}`"), steps, ACCURACY).alias("at")
    )
    cuts = {}
    for row in rows.collect():
        own = {i / parts[row.v] for i in range(1, parts[row.v])}
        cuts[row.v] = sorted({at for step, at in zip(steps, row["at"] or []) if step in own})
    return cuts


def _literal(value) -> str:
    """A bound as SQL that databases share."""
    if isinstance(value, datetime.datetime):
        return f"timestamp '{value.isoformat(' ')}'"
    if isinstance(value, datetime.date):
        return f"date '{value.isoformat()}'"
    return str(value)


def scan_in_splits(rows: DataFrame, splits: list[str]) -> DataFrame:
    """The rows, read split by split, as a JDBC scan does it."""
    parts = [rows.where(split) for split in splits]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
