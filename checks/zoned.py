"""Queries on events and facts stored in partitions, read through zone maps; the SQL is that of the plain keys.

Every fiftieth event lies in the partition of a later day, as rows of late folders do.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import adapters as A
from checks.adapters import domain_tables
from turnstile.plans import classes, events, users
from turnstile.session import scratch_path
from turnstile.sources.zones import ZonedTables, write_sorted, zoned_tables

Runner = Callable[[SparkSession, str], DataFrame]


def late_partitions(df: DataFrame) -> DataFrame:
    """Year, month and day of the folder: 40 days later for some."""
    late = F.when(F.col("event_id").cast("bigint") % 50 == 0, 40).otherwise(0)
    at = F.date_add(F.col("event_ts").cast("date"), late)
    return df.withColumns({"year": F.year(at), "month": F.month(at), "day": F.day(at)})


def stored_star(spark: SparkSession, sf_dir: str) -> ZonedTables:
    tables, root = domain_tables(spark, sf_dir), scratch_path(spark, "zoned")
    paths = {"events": f"{root}/events", "fact_event": f"{root}/fact_event"}
    write_sorted(late_partitions(tables["events"]), paths["events"], ["year", "month", "day"], "event_ts")
    write_sorted(late_partitions(tables["fact_event"]).drop("day"), paths["fact_event"], ["year", "month"], "event_ts")
    return zoned_tables(spark, tables, paths)


def over_star(query: Callable[..., DataFrame], **params) -> Runner:
    return lambda spark, sf_dir: query(stored_star(spark, sf_dir), **params)


QUERIES: dict[str, Runner] = {
    "q04_zoned": over_star(events.daily_trends, as_of=A.EVENTS_AS_OF),
    "q05_zoned": over_star(events.hourly_distribution, as_of=A.EVENTS_AS_OF),
    "q06_zoned": over_star(events.weekly_trends, as_of=A.EVENTS_AS_OF),
    "q09_zoned": over_star(users.active_users, as_of=A.EVENTS_AS_OF),
    "q10_zoned": over_star(users.type_preferences, as_of=A.EVENTS_AS_OF),
    "q11_zoned": over_star(users.engagement, as_of=A.EVENTS_AS_OF),
    "q19_zoned": over_star(classes.location_trend, year=A.YEAR),
    "q20_zoned": over_star(classes.leaderboard, month=A.BOARD_MONTH),
}
# The plain key that each shares its SQL with.
SAME_SQL = {
    "q04_zoned": "q04_daily_trends",
    "q05_zoned": "q05_hourly",
    "q06_zoned": "q06_weekly_trends",
    "q09_zoned": "q09_active_users",
    "q10_zoned": "q10_type_prefs",
    "q11_zoned": "q11_engagement",
    "q19_zoned": "q19_location_trend",
    "q20_zoned": "q20_leaderboard",
}
