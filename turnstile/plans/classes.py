"""Q-07, Q-08, Q-19 … Q-21: popular days, hours, places and classes, and the leaderboard."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turnstile.functions import clock, text
from turnstile.operators.state import CANCEL, CHECKIN, PAIR, SIGNUP, latest_state
from turnstile.plans.events import TableMap, count_per
from turnstile.sources.manifest import in_parts, input_bytes
from turnstile.sources.zones import rows_between

# The period that the dashboards report on by default.
YEAR = 2025
MONTHS = (4, 5)
CUTOVER = dt.date(2025, 5, 1)
BOARD_MONTH = dt.date(2025, 4, 1)

# Bytes of files of a session dimension from which it is not sent whole to every task.
SENT_BYTES = 1 << 20


def in_range(column: str, start: dt.date, end: dt.date) -> Column:
    """R-7: half-open range written on the bare column, so it reaches the scan."""
    return (F.col(column) >= clock.moment(start)) & (F.col(column) < clock.moment(end))


def in_year(column: str, year: int) -> Column:
    return in_range(column, dt.date(year, 1, 1), dt.date(year + 1, 1, 1))


def in_months(year: int, months: Sequence[int]) -> Column:
    """Partition filter of the event fact."""
    return (F.col("year") == year) & F.col("month").isin(*months)


def attendance_before(tables: TableMap, year: int, cutover: dt.date) -> DataFrame:
    """Confirmed attendance of the year up to the cut-over to the event stream."""
    end = min(cutover, dt.date(year + 1, 1, 1))
    return tables["fact_class_attendance"].where(in_range("class_datetime", dt.date(year, 1, 1), end))


def untouched_signups(events: DataFrame) -> DataFrame:
    """Latest state is a signup and the pair never had a checkin or cancellation (R-11).

    Both tests concern the same pairs, so they are two aggregates of one grouping: one scan and one
    shuffle, with partial aggregation, where an anti join would read and move the events twice. Pairs
    with a null key match nothing in a join, so they pass the second test.
    """
    latest = F.max_by(F.struct("event_type", "class_datetime"), F.struct("event_ts", "event_id"))
    touched = F.max(F.coalesce(F.col("event_type").isin(CHECKIN, CANCEL), F.lit(False)))
    pairs = events.groupBy(*PAIR).agg(latest.alias("latest"), touched.alias("touched"))
    unmatched = ~F.col("touched") | F.col("user_id").isNull() | F.col("session_id").isNull()
    signups = pairs.where((F.col("latest.event_type") == SIGNUP) & unmatched)
    return signups.select(*PAIR, F.col("latest.class_datetime").alias("class_datetime"))


def class_days(
    tables: TableMap, year: int = YEAR, months: Sequence[int] = MONTHS, cutover: dt.date = CUTOVER
) -> DataFrame:
    """Q-07: sessions per weekday (1 is Sunday)."""
    signups = untouched_signups(tables["fact_event"].where(in_months(year, months)))
    times = attendance_before(tables, year, cutover).select("class_datetime").unionAll(signups.select("class_datetime"))
    counts = count_per(times, F.dayofweek("class_datetime").alias("weekday"), alias="total_sessions")
    named = counts.select("weekday", clock.weekday_name(F.col("weekday")).alias("weekday_name"), "total_sessions")
    return named.orderBy(F.desc("total_sessions"), F.asc_nulls_last("weekday"))


def class_times(
    tables: TableMap, year: int = YEAR, months: Sequence[int] = MONTHS, cutover: dt.date = CUTOVER
) -> DataFrame:
    """Q-08: sessions per hour of day."""
    signups = latest_state(tables["fact_event"], ["event_ts"], where=in_months(year, months))
    times = attendance_before(tables, year, cutover).select("class_datetime").unionAll(signups.select("class_datetime"))
    counts = count_per(times, F.hour("class_datetime").alias("class_hour"), alias="total_sessions")
    return counts.orderBy(F.desc("total_sessions"), F.asc_nulls_last("class_hour"))


def sessions_of(tables: TableMap, year: int, *columns: str) -> DataFrame:
    """Sessions of a year. Copies of a session cannot change distinct counts, so they go before the join."""
    return tables["dim_class_session"].where(F.col("year") == year).select("session_id", *columns).distinct()


def _with_sessions(pairs: DataFrame, sessions: DataFrame) -> DataFrame:
    """``pairs`` joined to their sessions.

    Spark chooses a broadcast by bytes of compressed files, of which a table in memory takes some forty times as many in
    every task, and AQE does not take the choice back where that needs one more shuffle. Of dimensions of
    ``SENT_BYTES`` or more a task holds its part of the sessions only and streams the pairs, which no sort keeps; AQE
    splits hot sessions there.
    """
    return pairs.join(sessions.hint("shuffle_hash") if input_bytes(sessions) >= SENT_BYTES else sessions, "session_id")


def _count_pairs(rows: DataFrame, keys: Sequence[str], exact_pairs: bool, alias: str, *more: str) -> DataFrame:
    """Distinct (user, session) per ``keys``: joined without a separator, or by both columns when ``exact_pairs``.

    Nearly every pair differs, so collecting them in the tasks before the shuffle would only fill memory: large inputs
    are dealt by pair first, and the same shuffle serves the grouping.
    """
    pair = list(PAIR) if exact_pairs else ["pair"]
    named = rows if exact_pairs else rows.withColumn("pair", text.pair_key(F.col("user_id"), F.col("session_id")))
    whole = named.select(*keys, *more, *pair)
    counted = F.count_if(F.concat(*[F.col(c) for c in pair]).isNotNull()).alias(alias)
    return in_parts(whole, *whole.columns).distinct().groupBy(*keys).agg(counted)


def location_trend(tables: TableMap, year: int = YEAR, exact_pairs: bool = False) -> DataFrame:
    """Q-19: attendance per location and month; a pair found in both sources counts twice.

    Both sources are joined to their sessions together: "distinct per source, then added" is the
    same as "distinct (source, pair)", which needs one join and one aggregation. The names of a place
    depend on its id alone, so they are joined to the totals and stay out of the shuffles.
    """
    events = rows_between(tables, "fact_event", "event_ts", clock.moment(dt.date(year, 1, 1)), clock.moment(dt.date(year + 1, 1, 1)))
    signups = latest_state(events, ["event_ts"], where=in_year("event_ts", year))
    attended = tables["fact_class_attendance"].select(*PAIR, F.lit(1).alias("source"))
    pairs = attended.unionAll(signups.select(*PAIR, F.lit(2).alias("source")))
    sessions = sessions_of(tables, year, "location_id", "year", "month")
    totals = _count_pairs(_with_sessions(pairs, sessions), ["location_id", "year", "month"], exact_pairs, "total_attendance", "source")
    city, name = F.lower("city").alias("city"), F.lower("location_name").alias("location_name")
    places = tables["dim_location"].select("location_id", city, name).distinct()
    columns = ["location_id", "city", "location_name", "year", "month", "total_attendance"]
    ties = [F.asc_nulls_last(c) for c in columns[:3]]
    named = totals.join(places, "location_id").select(*columns)
    return named.orderBy("year", F.asc_nulls_last("month"), F.desc("total_attendance"), *ties)


def leaderboard(tables: TableMap, month: dt.date = BOARD_MONTH, limit: int = 20) -> DataFrame:
    """Q-20: users by distinct sessions attended or signed up for within one month.

    Checkins are not looked at: a signup stands until it is cancelled. A user with several rows in the
    dimension appears once per row. As every known user has a row, the best ``limit`` users hold the
    best ``limit`` rows: only those few are joined to their names.
    """
    start = month.replace(day=1)
    end = (start + dt.timedelta(days=31)).replace(day=1)
    counted = in_range("event_ts", start, end) & F.col("event_type").isin(SIGNUP, CANCEL)
    events = rows_between(tables, "fact_event", "event_ts", clock.moment(start), clock.moment(end))
    signups = latest_state(events, ["event_ts", "processed_time"], where=counted)
    attended = tables["fact_class_attendance"].where(in_range("class_datetime", start, end))
    pairs = attended.select(*PAIR).unionAll(signups.select(*PAIR))
    counts = pairs.groupBy("user_id").agg(F.count_distinct("session_id").alias("total_classes_attended"))
    names = tables["dim_user_v3"].select("user_id", "first_name", "last_name")
    most, ties = F.desc("total_classes_attended"), [F.asc_nulls_last(c) for c in names.columns]
    known = counts.join(names.select("user_id").distinct(), "user_id", "left_semi")
    best = known.orderBy(most, ties[0]).limit(limit)
    board = best.join(names, "user_id").select("user_id", "first_name", "last_name", "total_classes_attended")
    return board.orderBy(most, *ties).limit(limit)


def popular_classes(tables: TableMap, year: int = YEAR, limit: int = 10, exact_pairs: bool = False) -> DataFrame:
    """Q-21: classes by distinct pairs; a pair found in both sources counts once."""
    signups = latest_state(tables["fact_event"], ["processed_time"], where=F.col("year") == year)
    pairs = tables["fact_class_attendance"].select(*PAIR).unionAll(signups.select(*PAIR))
    totals = _count_pairs(_with_sessions(pairs, sessions_of(tables, year, "class_name")), ["class_name"], exact_pairs, "attendance_count")
    return totals.orderBy(F.desc("attendance_count"), F.asc_nulls_last("class_name")).limit(limit)
