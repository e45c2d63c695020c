"""Schemas of the raw inputs and of the star schema, as DDL strings.

The streaming file source needs them up front; batch readers use them to skip inference.
"""

from __future__ import annotations

from pyspark.sql import types as T

# Stream inputs: text as delivered, plus the stamp added when the raw file became parquet.
STREAM_EVENTS = """
    event_id string, user_id string, session_id string, event_type string, event_ts string,
    location_id string, class_datetime string, processed_time timestamp_ntz
"""

STREAM_SCHEDULE = """
    session_id string, date string, time string, datetime string, class_code string, class_name string,
    instructor_id string, instructor_name string, loc_id string, city string, location_name string,
    week_number string, year string, month string, day_of_week string, is_weekend string,
    duration_mins string, release_timestamp string, processed_time timestamp_ntz
"""

STREAM_USERS = """
    user_id string, first_name string, last_name string, email string, phone_number string,
    date_of_birth string, gender string, city string, preferred_location_id string, created_at string,
    processed_time timestamp_ntz
"""

CLASS_ATTENDANCE = """
    session_id string, class_name string, instructor_name string, location_id string,
    attendance_count bigint, class_datetime string, processed_time timestamp_ntz,
    attendees array<struct<email: string, user_id: string>>
"""

# Historical inputs: typed.
HISTORICAL_SCHEDULE = """
    session_id string, date timestamp_ntz, time string, datetime timestamp_ntz, class_code string,
    class_name string, instructor_id int, instructor_name string, loc_id string, city string,
    location_name string, week_number int, year int, month int, day_of_week string, is_weekend boolean,
    duration_mins int, processed_time timestamp_ntz
"""

HISTORICAL_USERS = """
    user_id string, first_name string, last_name string, email string, phone_number string,
    date_of_birth date, gender string, city string, preferred_location_id string,
    created_at timestamp_ntz, age int, full_name_length int
"""

# Star schema.
DIM_USER = """
    user_id string, first_name string, last_name string, gender string, email string, phone_number string,
    date_of_birth date, age int, city string, preferred_location_id string, created_at timestamp_ntz
"""

DIM_CLASS_SESSION = """
    session_id string, class_code string, class_name string, instructor_id int, location_id string,
    class_datetime timestamp_ntz, duration_mins int, week_number int, year int, month int,
    day_of_week string, is_weekend boolean, release_timestamp timestamp_ntz
"""

DIM_LOCATION = "location_id string, location_name string, city string"

DIM_INSTRUCTOR = "instructor_id int, instructor_name string"

FACT_CLASS_ATTENDANCE = """
    attendance_id string, user_id string, session_id string, location_id string,
    class_datetime timestamp_ntz, processed_time timestamp_ntz
"""

FACT_EVENT = """
    event_id string, user_id string, session_id string, event_type string, event_ts timestamp_ntz,
    location_id string, class_datetime timestamp_ntz, processed_time timestamp_ntz,
    event_partition_date date, year int, month int
"""

# Batch job runs are listed as batch -1, streamed ones with their micro-batch number.
LEDGER = "unit string, batch bigint"


def struct_of(ddl: str) -> T.StructType:
    return T.StructType.fromDDL(" ".join(ddl.split()))
