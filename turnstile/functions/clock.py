"""Time expressions on zone-free timestamps.

None of them depends on the session time zone: days, weeks and differences are computed on dates
and day-time intervals instead of zoned timestamps.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, TimestampNTZType, TimestampType

NTZ = "timestamp_ntz"
ISO_PATTERN = "yyyy-MM-dd'T'HH:mm:ss"
# Every text that the pattern reads has this shape: years may have a sign and more digits, the separator either case.
ISO_SHAPE = r"^[+-]?[0-9]{4,}-[0-9]{2}-[0-9]{2}[Tt][0-9]{2}:[0-9]{2}:[0-9]{2}$"

# Weekday numbers 1 to 7 start on Sunday.
WEEKDAY_NAMES = ("Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday")

DayLike = dt.date | dt.datetime | str | Column | None


def day(value: DayLike = None) -> Column:
    """A date column from a date, ISO text or column; today when nothing is given (F-17)."""
    if value is None:
        return F.current_date()
    if isinstance(value, Column):
        return value.cast("date")
    return F.lit(str(value)[:10]).cast("date")


def moment(value: dt.date | dt.datetime | str | Column) -> Column:
    """A zone-free timestamp column from a date, datetime, ISO text or column."""
    return value.cast(NTZ) if isinstance(value, Column) else F.lit(str(value)).cast(NTZ)


def days_before(as_of: DayLike, days: int) -> Column:
    """Midnight ``days`` days before ``as_of``; a constant, so the comparison reaches the scan."""
    return F.date_sub(day(as_of), days).cast(NTZ)


def start_of_day(ts: Column) -> Column:
    """F-13."""
    return ts.cast("date").cast(NTZ)


def start_of_week(ts: Column) -> Column:
    """F-13: Monday, midnight."""
    return F.trunc(ts, "week").cast(NTZ)


def weekday_name(number: Column) -> Column:
    """F-12: name of a Sunday-based weekday number."""
    return F.element_at(F.array(*[F.lit(name) for name in WEEKDAY_NAMES]), number)


def whole_days(start: Column, end: Column) -> Column:
    """F-18: completed 24-hour periods from ``start`` to ``end``."""
    return F.extract(F.lit("DAY"), end.cast(NTZ) - start.cast(NTZ))


def whole_years(born: Column, as_of: Column) -> Column:
    """F-19: completed years; a 29 February birthday counts on 28 February of common years."""
    years = F.year(as_of) - F.year(born)
    birthday = F.add_months(born, years * 12)
    return years - F.when(birthday > as_of, 1).otherwise(0)


def from_epoch_millis(c: Column) -> Column:
    """F-21: epoch milliseconds (text or number) to a timestamp; the millisecond part is dropped."""
    seconds = F.call_function("div", c.try_cast("bigint"), F.lit(1000))
    return F.timestamp_add("SECOND", seconds, moment("1970-01-01 00:00:00"))


def parse_iso(c: Column) -> Column:
    """C-16: strict ``date T time`` text; anything else is null.

    Text of another shape does not reach the parser, which raises and catches an error for each: many times the price.
    """
    text = c.cast("string")
    return F.when(text.rlike(ISO_SHAPE), F.try_to_timestamp(text, F.lit(ISO_PATTERN))).cast(NTZ)


def event_time(c: Column, kind: DataType) -> Column:
    """C-16 for a column of any type: a timestamp stays as it is, everything else is read as strict text."""
    return c.cast(NTZ) if isinstance(kind, (TimestampType, TimestampNTZType)) else parse_iso(c)


def parse_moment(c: Column) -> Column:
    """C-18, F-9: default timestamp text, also with the separator lower-cased; else null."""
    return F.replace(c.cast("string"), F.lit("t"), F.lit(" ")).try_cast(NTZ)


def date_of_parts(year: Column, month: Column, day_: Column) -> Column:
    """F-7, F-22: date from numeric parts; impossible dates are null."""
    two = lambda c: F.lpad(c.cast("string"), 2, "0")
    return F.concat(year.cast("string"), F.lit("-"), two(month), F.lit("-"), two(day_)).try_cast("date")
