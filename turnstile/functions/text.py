"""Text, key and number expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fill words that downstream queries and existing outputs rely on.
STREAM_FILL = "unknown"
HISTORICAL_FILL = "UNKNOWN"


def lower_or_unknown(c: Column) -> Column:
    """C-5, C-7: lower case; null becomes ``unknown``; blanks and empty text stay."""
    return F.coalesce(F.lower(c), F.lit(STREAM_FILL))


def tidy_or_unknown(c: Column) -> Column:
    """C-6, C-8: strip spaces, lower case; null or empty becomes ``unknown``."""
    return F.coalesce(F.nullif(F.lower(F.trim(c)), F.lit("")), F.lit(STREAM_FILL))


def tidy_email(c: Column) -> Column:
    """C-12."""
    return F.lower(F.trim(c))


def digits_only(c: Column) -> Column:
    """C-13."""
    return F.regexp_replace(c, "[^0-9]", "")


def blank_for_t(c: Column) -> Column:
    """F-3: undo the lower-cased ISO separator."""
    return F.replace(c, F.lit("t"), F.lit(" "))


def pair_key(user: Column, session: Column) -> Column:
    """F-6: user and session joined without separator; null if either is null."""
    return F.concat(user, session)


def attendance_key(user: Column, session: Column) -> Column:
    """F-8: upper-case hex MD5 of the joined pair."""
    return F.upper(F.md5(pair_key(user, session)))


def lenient_number(c: Column) -> Column:
    """P-1: text to double, anything unreadable to null."""
    return c.try_cast("double")
