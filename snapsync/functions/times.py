"""Expressions on times, durations and epochs."""

from pyspark.sql import Column, functions as F

# The two spellings of an object time, the marker's, and the author time.
OBJECT_TIME_FORMATS = ("yyyy-MM-dd:HH:mm:ss", "yyyy-MM-dd HH:mm:ss")
MARKER_FORMAT = "dd/MM/yyyy HH:mm:ss"
AUTHOR_TIME_FORMAT = "dd.MM.yyyy'T'HH:mm:ss"
# Epoch name formats, the current one and two older ones.
EPOCH_FORMATS = {
    "current": "yyyy.MM.dd_HH.mm",
    "day_first": "dd.MM.yyyy_HH.mm",
    "compact": "yyyyMMdd_HHmm",
}
# Duration units.
DURATION_PATTERN = r"^(\d+)(\w+)"


def _parse(c: Column, pattern: str) -> Column:
    return F.try_to_timestamp(c, F.lit(pattern)).cast("timestamp_ntz")


def parse_object_time(c: Column) -> Column:
    return F.coalesce(*[_parse(c, pattern) for pattern in OBJECT_TIME_FORMATS])


def parse_marker(c: Column) -> Column:
    return _parse(c, MARKER_FORMAT)


def days(n) -> Column:
    n = n if isinstance(n, Column) else F.lit(n)
    return F.make_dt_interval(days=n)


def duration(count: Column, unit: Column) -> Column:
    """Interval of `count` units d, h, m or s; null for another unit."""
    zero = F.lit(0)
    return F.when(
        unit.isin("d", "h", "m", "s"),
        F.make_dt_interval(
            F.when(unit == "d", count).otherwise(zero),
            F.when(unit == "h", count).otherwise(zero),
            F.when(unit == "m", count).otherwise(zero),
            F.when(unit == "s", count).otherwise(zero).cast("decimal(18,6)"),
        ),
    )


def parse_duration(c: Column) -> Column:
    """Interval of a text such as 36h, 3d or 15m; null when it is none."""
    count = F.nullif(F.regexp_extract(c, DURATION_PATTERN, 1), F.lit("")).try_cast("int")
    return duration(count, F.regexp_extract(c, DURATION_PATTERN, 2))


def clock_shift(local_time: Column, source_time: Column) -> Column:
    """Whole days that the source clock is behind the local one."""
    return F.datediff(local_time.cast("date"), source_time.cast("date"))


def author_time(modified: Column, shift_days: Column, hour_shift: int) -> Column:
    moved = modified + F.make_dt_interval(days=shift_days, hours=F.lit(hour_shift))
    return F.date_format(moved, AUTHOR_TIME_FORMAT)


def epoch_name(source_db: Column, marker: Column, style: str = "current") -> Column:
    return F.concat(source_db, F.lit("_"), F.date_format(marker, EPOCH_FORMATS[style]))
