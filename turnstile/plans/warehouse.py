"""M-1 … M-9: combined views, dimensions and facts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turnstile.functions import clock, text
from turnstile.operators.state import one_per_key
from turnstile.sources.readers import Tables
from turnstile.sources.sinks import create_table_as
from turnstile.sources.zones import ZonedTables, update_zones

# The columns of the two combined views.
USER_VIEW = (
    "user_id",
    "first_name",
    "last_name",
    "email",
    "phone_number",
    "date_of_birth",
    "gender",
    "city",
    "preferred_location_id",
    "created_at",
    "age",
    "full_name_length",
    "processed_time",
    "processed_timestamp",
    "day",
    "partition_0",
    "year",
    "month",
)
SCHEDULE_VIEW = (
    "session_id",
    "date",
    "time",
    "datetime",
    "class_code",
    "class_name",
    "instructor_id",
    "instructor_name",
    "loc_id",
    "city",
    "location_name",
    "week_number",
    "year",
    "month",
    "day_of_week",
    "is_weekend",
    "duration_mins",
    "release_timestamp",
    "processed_time",
)


def _pick(df: DataFrame, columns: Sequence[str], **changed) -> DataFrame:
    """The given columns as far as they exist, some replaced by an expression."""
    return df.select(
        *[changed[c].alias(c) if c in changed else F.col(c) for c in columns if c in changed or c in df.columns]
    )


def combined_users(historical: DataFrame, stream: DataFrame) -> DataFrame:
    """M-1: both user sources; columns that one side lacks are null there."""
    as_text = {c: F.col(c).cast("string") for c in ("date_of_birth", "created_at")}
    left = _pick(historical, USER_VIEW, **as_text)
    right = _pick(stream, USER_VIEW)
    both = left.unionByName(right, allowMissingColumns=True)
    return _pick(both, USER_VIEW)


def combined_schedule(historical: DataFrame, stream: DataFrame) -> DataFrame:
    """M-2: both schedules with the types of the historical one; unreadable text becomes null."""
    left = _pick(
        historical,
        SCHEDULE_VIEW,
        date=F.col("date").cast("date"),
        time=F.col("time").cast("string"),
        release_timestamp=F.lit(None).cast(clock.NTZ),
    )
    numbers = {c: F.col(c).try_cast("int") for c in ("instructor_id", "week_number", "year", "month", "duration_mins")}
    right = _pick(
        stream,
        SCHEDULE_VIEW,
        date=F.substring("date", 1, 10).try_cast("date"),
        time=F.substring("time", 1, 8),
        datetime=clock.parse_moment(F.col("datetime")),
        release_timestamp=clock.parse_moment(F.col("release_timestamp")),
        is_weekend=F.col("is_weekend").try_cast("boolean"),
        **numbers,
    )
    return left.unionByName(right)


def dim_instructor(schedule: DataFrame) -> DataFrame:
    """M-3: the -1 that stands for an unknown instructor is an instructor here."""
    return schedule.where(F.col("instructor_id").isNotNull()).select("instructor_id", "instructor_name").distinct()


def expanded_attendance(attendance: DataFrame) -> DataFrame:
    """M-4: one row per attendee; sessions without attendees vanish."""
    return attendance.select(
        "attendance_count",
        "class_datetime",
        "class_name",
        "instructor_name",
        "location_id",
        "session_id",
        "processed_time",
        "processed_timestamp",
        F.explode("attendees").alias("attendee"),
    ).select("*", F.col("attendee.email").alias("email"), F.col("attendee.user_id").alias("user_id")).drop("attendee")


def dim_user(users: DataFrame, dedupe: bool = False) -> DataFrame:
    """M-5. ``dedupe`` keeps the user row created last; the default keeps all of them."""
    rows = users.select(
        "user_id",
        "first_name",
        "last_name",
        "gender",
        "email",
        "phone_number",
        F.col("date_of_birth").try_cast("date").alias("date_of_birth"),
        "age",
        "city",
        "preferred_location_id",
        F.col("created_at").try_cast(clock.NTZ).alias("created_at"),
    )
    return one_per_key(rows, ["user_id"], ["created_at"]) if dedupe else rows


def dim_class_session(schedule: DataFrame, dedupe: bool = False) -> DataFrame:
    """M-6. ``dedupe`` keeps the session row processed last; the default keeps all of them."""
    rows = one_per_key(schedule, ["session_id"], ["processed_time"]) if dedupe else schedule
    return rows.select(
        "session_id",
        "class_code",
        "class_name",
        "instructor_id",
        F.col("loc_id").alias("location_id"),
        F.col("datetime").alias("class_datetime"),
        "duration_mins",
        "week_number",
        "year",
        "month",
        "day_of_week",
        "is_weekend",
        "release_timestamp",
    )


def dim_location(schedule: DataFrame) -> DataFrame:
    """M-7."""
    return schedule.select(F.col("loc_id").alias("location_id"), "location_name", "city").distinct()


def fact_class_attendance(expanded: DataFrame) -> DataFrame:
    """M-8."""
    return expanded.select(
        text.attendance_key(F.col("user_id"), F.col("session_id")).alias("attendance_id"),
        "user_id",
        "session_id",
        "location_id",
        clock.from_epoch_millis(F.col("class_datetime")).alias("class_datetime"),
        "processed_time",
    )


def fact_event(events: DataFrame) -> DataFrame:
    """M-9, with the event time that the queries need."""
    return events.where(F.col("event_id").isNotNull() & F.col("event_type").isNotNull()).select(
        "event_id",
        "user_id",
        "session_id",
        "event_type",
        "event_ts",
        "location_id",
        clock.parse_moment(F.col("class_datetime")).alias("class_datetime"),
        "processed_time",
        clock.date_of_parts(F.col("year"), F.col("month"), F.col("day")).alias("event_partition_date"),
        "year",
        "month",
    )


def build_warehouse(cleaned: Mapping[str, DataFrame], dedupe: bool = False) -> Tables:
    """All warehouse tables, built lazily from the cleaned inputs.

    Inputs: ``user_snapshot``, ``stream_users``, ``schedule``, ``stream_schedule``,
    ``class_attendance`` and ``events``.
    """
    tables = Tables(
        {
            "combined_user_view": lambda: combined_users(cleaned["user_snapshot"], cleaned["stream_users"]),
            "combined_schedule_view": lambda: combined_schedule(cleaned["schedule"], cleaned["stream_schedule"]),
            "dim_instructor": lambda: dim_instructor(tables["combined_schedule_view"]),
            "expanded_class_attendance": lambda: expanded_attendance(cleaned["class_attendance"]),
            "dim_user_v3": lambda: dim_user(tables["combined_user_view"], dedupe),
            "dim_class_session": lambda: dim_class_session(tables["combined_schedule_view"], dedupe),
            "dim_location": lambda: dim_location(tables["combined_schedule_view"]),
            "fact_class_attendance": lambda: fact_class_attendance(tables["expanded_class_attendance"]),
            "fact_event": lambda: fact_event(cleaned["events"]),
            "events": lambda: cleaned["events"],
        }
    )
    return tables


STORED = (
    "dim_instructor",
    "expanded_class_attendance",
    "dim_user_v3",
    "dim_class_session",
    "dim_location",
    "fact_class_attendance",
    "fact_event",
)
PARTITIONED = {"fact_event": ("year", "month")}
# Tables with a zone map, and the time that it is kept for.
ZONED = {"fact_event": "event_ts"}


def store_warehouse(tables: Mapping[str, DataFrame], root: str, database: str | None = None) -> Tables:
    """K-5: write the dimensions and facts as catalogue tables; views and other source tables are handed on as they are.

    The event fact is sorted by time within its partitions and has a zone map, so that the queries which ask for a range
    of event times open only the partitions that can hold it.
    """
    prefix, spark = f"{database}." if database else "", tables[STORED[0]].sparkSession
    stored = {
        name: create_table_as(tables[name], prefix + name, f"{root}/{name}", PARTITIONED.get(name, ()), ZONED.get(name)) for name in STORED
    }
    for name, time in ZONED.items():
        update_zones(spark, f"{root}/{name}", time)
    others = {name: (lambda name=name: tables[name]) for name in tables if name not in STORED}
    builders = others | {name: (lambda df=df: df) for name, df in stored.items()}
    return ZonedTables(spark, builders, {name: f"{root}/{name}" for name in ZONED})
