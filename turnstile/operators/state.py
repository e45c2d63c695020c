"""W-1: the latest row per key, and the test on it that must come after the ranking."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PAIR = ("user_id", "session_id")

# Event types with a meaning for attendance.
SIGNUP = "signup"
CHECKIN = "checkin"
CANCEL = "cancel"


def newest_first(*columns: str) -> list[Column]:
    return [F.desc_nulls_last(c) for c in columns]


def latest_by(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key: the first in ``order``, which should end in a unique column.

    Spark keeps only the best row per key in every map task before the shuffle (``WindowGroupLimit``),
    so a key that holds a large share of the rows reaches its reducer as one row per map task.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).where(F.col("_rank") == 1).drop("_rank")


def latest_state(
    events: DataFrame,
    order: Sequence[str],
    where: Column | None = None,
    accept: str | None = SIGNUP,
    keys: Sequence[str] = PAIR,
    tie_break: str = "event_id",
) -> DataFrame:
    """W-1: restrict, take the latest event per (user, session), and only then test its type.

    A session whose latest event is a cancellation vanishes, however many signups came before.
    """
    rows = events if where is None else events.where(where)
    latest = latest_by(rows, keys, newest_first(*order, tie_break))
    return latest if accept is None else latest.where(F.col("event_type") == accept)


def one_per_key(df: DataFrame, keys: Sequence[str], prefer: Sequence[str] = ()) -> DataFrame:
    """C-2: one row per key with a repeatable winner: newest in ``prefer``, then by all other columns."""
    rest = [c for c in df.columns if c not in keys and c not in prefer]
    return latest_by(df, keys, newest_first(*prefer, *rest))
