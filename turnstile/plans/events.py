"""Q-01 … Q-06: totals, types and trends over the raw events."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turnstile.functions import clock
from turnstile.sources.zones import rows_between

TableMap = Mapping[str, DataFrame]


def since(tables: TableMap, as_of: clock.DayLike, days: int) -> DataFrame:
    """R-6: events of the last ``days`` days; of a table with a zone map only the partitions that can hold them."""
    start = clock.days_before(as_of, days)
    return rows_between(tables, "events", "event_ts", start).where(F.col("event_ts") >= start)


def count_per(df: DataFrame, *keys: Column | str, alias: str = "event_count") -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(alias))


def total_events(tables: TableMap) -> DataFrame:
    """Q-01."""
    return tables["events"].agg(F.count(F.lit(1)).alias("total_events"))


def event_types(tables: TableMap, limit: int = 10) -> DataFrame:
    """Q-02."""
    counts = count_per(tables["events"], "event_type")
    return counts.orderBy(F.desc("event_count"), F.asc_nulls_last("event_type")).limit(limit)


def recent_events(tables: TableMap, limit: int = 100) -> DataFrame:
    """Q-03."""
    columns = tables["events"].select("event_id", "event_type", "event_ts")
    return columns.orderBy(F.desc_nulls_last("event_ts"), F.desc_nulls_last("event_id")).limit(limit)


def daily_trends(tables: TableMap, as_of: clock.DayLike = None, days: int = 30) -> DataFrame:
    """Q-04."""
    bucket = clock.start_of_day(F.col("event_ts")).alias("day")
    return count_per(since(tables, as_of, days), bucket).orderBy("day")


def hourly_distribution(tables: TableMap, as_of: clock.DayLike = None, days: int = 7) -> DataFrame:
    """Q-05."""
    bucket = F.hour("event_ts").alias("hour_of_day")
    return count_per(since(tables, as_of, days), bucket).orderBy("hour_of_day")


def weekly_trends(tables: TableMap, as_of: clock.DayLike = None, days: int = 90) -> DataFrame:
    """Q-06: weeks start on Monday."""
    bucket = clock.start_of_week(F.col("event_ts")).alias("week")
    return count_per(since(tables, as_of, days), bucket).orderBy("week")
