"""Raw files to dashboard numbers, through every layer."""

import datetime as dt
import json

import pytest

from turnstile import schemas
from turnstile.operators import clean
from turnstile.plans import catalog, classes, users
from turnstile.plans.historical import clean_historical
from turnstile.plans.warehouse import build_warehouse, store_warehouse
from turnstile.sources.readers import Tables
from turnstile.streaming import ingest


def event(number, user, session, kind, hour):
    at = f"2025-04-10T{hour:02d}:00:00"
    return {
        "event_id": f"E{number}", "user_id": user, "session_id": session, "event_type": kind, "event_ts": at,
        "location_id": "L1", "class_datetime": "2025-04-20T09:00:00",
    }


EVENTS = [
    event(1, "U1", "S1", " SignUp", 8),
    event(2, "U2", "S1", "signup", 8),
    event(3, "U2", "S1", "cancel", 9),
    event(4, "U3", "S2", "signup", 8),
    event(4, "U3", "S2", "signup", 8),
    event(5, "U3", "S2", "checkin", 9),
]
SESSION = {
    "date": "2025-04-20T00:00:00", "time": "09:00:00.000", "datetime": "2025-04-20T09:00:00", "class_code": "Y1",
    "instructor_id": "7", "instructor_name": "Ann", "loc_id": "L1", "city": "NYC", "location_name": "Main",
    "week_number": "16", "year": "2025", "month": "4", "day_of_week": "Sunday", "is_weekend": "true",
    "duration_mins": "60", "release_timestamp": "2025-04-01T00:00:00",
}
SCHEDULE = [{"session_id": "S1", "class_name": "Yoga", **SESSION}, {"session_id": "S2", "class_name": "Spin", **SESSION}]
USERS = [
    {"user_id": u, "first_name": n, "last_name": "X", "email": f" {n}@X.com", "phone_number": "(1) 2", "gender": "Female",
     "date_of_birth": "1990-01-01", "city": "NYC", "preferred_location_id": "L1", "created_at": "2025-01-01 00:00:00"}
    for u, n in (("U1", "Ann"), ("U2", "Bob"), ("U3", "Cid"))
]


@pytest.fixture
def cleaned(spark, tmp_path):
    """Cleaned inputs of the warehouse, produced by the jobs."""
    raw = {"non-pii/events/events_20250410": EVENTS, "non-pii/schedule/schedule_20250401": SCHEDULE, "pii/users/users_20250401": USERS}
    for name, data in raw.items():
        file = tmp_path / "raw" / f"{name}.json"
        file.parent.mkdir(parents=True)
        file.write_text("\n".join(json.dumps(row) for row in data))
    converted = ingest.convert_pending(spark, f"{tmp_path}/raw", f"{tmp_path}/parquet")
    assert [r["outcome"] for r in converted.collect()] == ["converted"] * 3

    other = ingest.IngestPaths(f"{tmp_path}/parquet", f"{tmp_path}/cleaned", "non-pii")
    personal = ingest.IngestPaths(f"{tmp_path}/parquet", f"{tmp_path}/cleaned", "pii")
    ingest.start_ingest(spark, other, "events", schemas.STREAM_EVENTS, clean.NON_PII).awaitTermination()
    ingest.start_ingest(spark, other, "schedule", schemas.STREAM_SCHEDULE, clean.NON_PII).awaitTermination()
    ingest.ingest_pending(spark, personal, "users", clean.PII).collect()

    history = {
        "schedule": spark.createDataFrame([], schemas.struct_of(schemas.HISTORICAL_SCHEDULE)),
        "user_snapshot": spark.createDataFrame(
            [("U9", "Eve", "Y", "E@Y.com", "+1", dt.date(1980, 1, 1), "male", "NYC", "L1", dt.datetime(2024, 1, 1), 45, 3)] * 2,
            schemas.struct_of(schemas.HISTORICAL_USERS),
        ),
        "class_attendance": spark.createDataFrame(
            [("s1", "yoga", "ann", "l1", 2, "1743498000000", None, [("e@y.com", "U9"), ("x", "u1")])],
            schemas.struct_of(schemas.CLASS_ATTENDANCE),
        ),
    }
    for name, df in history.items():
        df.write.parquet(f"{tmp_path}/history/{name}")
    report = clean_historical(spark, {n: f"{tmp_path}/history/{n}" for n in history}, f"{tmp_path}/historical")
    assert {r["path"].rsplit("/", 1)[1]: r["n"] for r in report.collect()} == {"schedule": None, "user_snapshot": 1, "class_attendance": 1}

    return Tables(
        {
            "events": lambda: ingest.read_cleaned(spark, other.cleaned("events")),
            "stream_schedule": lambda: ingest.read_cleaned(spark, other.cleaned("schedule")).drop("day"),
            "stream_users": lambda: ingest.read_cleaned(spark, personal.cleaned("users")),
            "schedule": lambda: history["schedule"],
            "user_snapshot": lambda: spark.read.parquet(f"{tmp_path}/historical/user_snapshot"),
            "class_attendance": lambda: spark.read.parquet(f"{tmp_path}/historical/class_attendance"),
        }
    )


def test_raw_files_to_dashboard(spark, tmp_path, cleaned, rows):
    tables = store_warehouse(build_warehouse(cleaned), f"{tmp_path}/star")
    assert rows(tables["fact_event"], "event_id", "event_type", "year", "month") == [
        ("e1", "signup", 2025, 4),
        ("e2", "signup", 2025, 4),
        ("e3", "cancel", 2025, 4),
        ("e4", "signup", 2025, 4),
        ("e5", "checkin", 2025, 4),
    ]
    assert rows(tables["dim_user_v3"], "user_id", "first_name", "email", "age") == [
        ("U9", "Eve", "e@y.com", 45),
        ("u1", "ann", "ann@x.com", None),
        ("u2", "bob", "bob@x.com", None),
        ("u3", "cid", "cid@x.com", None),
    ]
    assert rows(tables["dim_location"]) == [("l1", "main", "nyc")]
    assert rows(tables["dim_instructor"]) == [(7, "ann")]
    at = dt.datetime(2025, 4, 20, 9)
    assert rows(tables["dim_class_session"], "session_id", "class_datetime", "duration_mins", "is_weekend", "year") == [
        ("s1", at, 60, True, 2025),
        ("s2", at, 60, True, 2025),
    ]
    assert rows(tables["fact_class_attendance"], "user_id", "session_id", "class_datetime") == [
        ("U9", "s1", dt.datetime(2025, 4, 1, 9)),
        ("u1", "s1", dt.datetime(2025, 4, 1, 9)),
    ]
    assert rows(classes.popular_classes(tables)) == [("yoga", 2)]
    assert rows(classes.location_trend(tables)) == [("l1", "nyc", "main", 2025, 4, 3)]
    assert rows(classes.leaderboard(tables), "user_id", "total_classes_attended") == [("U9", 1), ("u1", 1), ("u3", 1)]
    assert rows(classes.class_days(tables)) == [(1, "Sunday", 1), (3, "Tuesday", 2)]
    assert rows(users.gender_distribution(tables)) == [("Female", 3), ("Male", 1)]
    summary = catalog.run_query(tables, "User Behavior Analysis", "90-Day User Churn Analysis", as_of=dt.date(2025, 7, 5))
    assert rows(summary, "churn_status", "user_count") == [("Active", 1), ("Churned", 1)]
    assert catalog.run_query(tables, "Basic Queries", "Total Event Count").first()[0] == 5
