import datetime as dt

import pytest
from pyspark.sql import functions as F

from turnstile.functions import clock, text
from turnstile.operators import clean
from turnstile.operators.state import one_per_key

STAMP = "2025-05-02 00:00:00"


def column(spark, values, kind="string"):
    return spark.createDataFrame([(v,) for v in values], f"x {kind}")


def apply(df, change):
    return [r[0] for r in df.select(change(F.col("x"))).collect()]


def test_copies_are_compared_before_normalisation(spark, rows):
    df = spark.createDataFrame([("A", 1), ("A", 1), ("a", 1), (None, None)], "x string, n int")
    assert rows(clean.drop_copies(df)) == [(None, None), ("A", 1), ("a", 1)]
    assert rows(clean.drop_empty(clean.drop_copies(df))) == [("A", 1), ("a", 1)]


def test_pii_and_other_text_rules_differ(spark):
    df = column(spark, [None, "", " X ", "\tY\t", "MiX"])
    assert apply(df, text.lower_or_unknown) == ["unknown", "", " x ", "\ty\t", "mix"]
    assert apply(df, text.tidy_or_unknown) == ["unknown", "unknown", "x", "\ty\t", "mix"]


def test_contact_fields(spark):
    assert apply(column(spark, [" A@X.com ", None]), text.tidy_email) == ["a@x.com", None]
    assert apply(column(spark, ["(415) 555-0100", "unknown", None]), text.digits_only) == ["4155550100", "", None]


def test_durations(spark):
    df = column(spark, [-5, None, 0, 30], "int")
    assert apply(df, clean.not_negative) == [0, None, 0, 30]
    assert apply(df, clean.not_negative_or_null) == [0, 0, 0, 30]


def test_event_time_is_strict(spark):
    good = dt.datetime(2025, 5, 1, 10, 11, 12)
    values = ["2025-05-01T10:11:12", "2025-05-01t10:11:12", "2025-05-01 10:11:12", "2025-05-01T10:11:12.5", "unknown", None]
    assert apply(column(spark, values), clock.parse_iso) == [good, good, None, None, None, None]


def test_default_times_survive_lower_casing(spark):
    good = dt.datetime(2025, 5, 1, 10, 11, 12)
    values = ["2025-05-01t10:11:12", "2025-05-01 10:11:12", "unknown", None]
    assert apply(column(spark, values), clock.parse_moment) == [good, good, None, None]


def test_typed_defaults(spark, rows):
    df = spark.createDataFrame([(None, None, None)], "city string, instructor_id int, other array<string>")
    filled = clean.fill_defaults(df, {"city": "UNKNOWN", "instructor_id": -1})
    assert rows(filled) == [("UNKNOWN", -1, None)]
    assert rows(clean.fill_text(df)) == [("UNKNOWN", None, None)]
    with pytest.raises(Exception):
        clean.fill_defaults(df, {"missing": "x"}).collect()


def test_winner_per_key_is_repeatable(spark, rows):
    data = [("s1", 1, "old"), ("s1", 2, "new"), ("s2", 1, "b"), ("s2", 1, "a"), ("s3", None, "x")]
    df = spark.createDataFrame(data, "session_id string, processed_time int, v string")
    expected = [("s1", 2, "new"), ("s2", 1, "b"), ("s3", None, "x")]
    assert rows(one_per_key(df, ["session_id"], ["processed_time"])) == expected
    assert rows(one_per_key(df.repartition(3), ["session_id"], ["processed_time"])) == expected


def test_pii_cleaner(spark, rows):
    schema = "user_id string, email string, phone_number string, registration_date string, duration int"
    data = [
        ("U1", " A@X.com ", "(415) 555", "2025-05-01T10:11:12", -5),
        ("U1", " A@X.com ", "(415) 555", "2025-05-01T10:11:12", -5),
        ("U2", None, None, None, None),
        (None, None, None, None, None),
    ]
    df = clean.clean_pii(spark.createDataFrame(data, schema), "users", "users_20250501", F.lit(STAMP))
    at = dt.datetime(2025, 5, 2)
    assert rows(df) == [
        ("u1", "a@x.com", "415555", dt.datetime(2025, 5, 1, 10, 11, 12), 0, at, 2025, 5, 1),
        ("u2", "unknown", "", None, None, at, 2025, 5, 1),
    ]
    assert df.columns[-4:] == ["processed_timestamp", "year", "month", "day"]


def test_other_cleaner(spark, rows):
    schema = "event_id string, event_type string, event_ts string, duration int"
    data = [("E1", " SignUp ", "2025-05-01T10:11:12", None), ("E2", "", "2025-05-01 10:11:12", -1)]
    df = clean.clean_non_pii(spark.createDataFrame(data, schema), "events", "events_20250503_x", F.lit(STAMP))
    assert rows(df.select("event_id", "event_type", "event_ts", "duration", "event_date", "year", "month", "day")) == [
        ("e1", "signup", dt.datetime(2025, 5, 1, 10, 11, 12), 0, dt.date(2025, 5, 1), 2025, 5, 3),
        ("e2", "unknown", None, 0, None, 2025, 5, 3),
    ]


@pytest.mark.parametrize(
    "profile, folder, expected",
    [
        (clean.NON_PII, "events_20250503", (2025, 5, 3)),
        (clean.NON_PII, "events", (2025, 1, 1)),
        (clean.NON_PII, "events_2025", (2025, 1, 1)),
        (clean.PII, "users_20250503", (2025, 5, 3)),
        (clean.PII, "users", (2025, 5, 1)),
        (clean.PII, "users_", (2025, 5, 1)),
        (clean.PII, "users_20250503x", (2025, 5, 3)),
    ],
)
def test_day_comes_from_the_folder_name(spark, profile, folder, expected):
    df = clean.clean_stream(column(spark, ["a"]), profile, "other", folder)
    assert tuple(df.select("year", "month", "day").first()) == expected


def test_cleaning_twice_changes_no_text(spark, rows):
    df = spark.createDataFrame([(" A ", None), ("b", "")], "x string, y string")
    once = clean.clean_non_pii(df, "other", "other_20250501").select("x", "y")
    twice = clean.clean_non_pii(once, "other", "other_20250501").select("x", "y")
    assert rows(once) == rows(twice)


def test_report_and_unreadable(spark, rows):
    df = spark.createDataFrame([("x",), ("x",), ("2025-05-01T00:00:00",), (None,)], "event_ts string")
    assert rows(clean.cleaning_report(df, clean.drop_copies(df))) == [(4, 3, 1)]
    assert rows(clean.cleaning_report(df.limit(0), df.limit(0))) == [(0, 0, 0)]
    assert rows(clean.unreadable(df, "event_ts")) == [("x",), ("x",)]


def test_historical_cleaners(spark, rows):
    schedule = spark.createDataFrame(
        [("s1", None, " Yoga ", None, None, None, None, None, None), ("s1", "C", "Old", 3, "I", "L", "T", "N", 5)],
        "session_id string, class_code string, class_name string, instructor_id int, instructor_name string, "
        "loc_id string, city string, location_name string, duration_mins int",
    )
    assert len(rows(clean.clean_historical_schedule(schedule))) == 1
    only = clean.clean_historical_schedule(schedule.where("class_code is null"))
    assert rows(only) == [("s1", "UNKNOWN", "Yoga", -1, "UNKNOWN", "UNKNOWN", "UNKNOWN", "UNKNOWN", 0)]
    users = spark.createDataFrame(
        [("u1", None, "L", None, None, None)],
        "user_id string, first_name string, last_name string, email string, phone_number string, preferred_location_id string",
    )
    assert rows(clean.clean_historical_users(users)) == [("u1", "UNKNOWN", "L", "unknown", "", "UNKNOWN")]
    attendance = spark.createDataFrame(
        [("s1", None, None), ("s1", None, None)], "session_id string, class_name string, attendees array<string>"
    )
    cleaned = clean.clean_historical_attendance(attendance, F.lit(STAMP))
    assert rows(cleaned) == [("s1", "UNKNOWN", None, dt.datetime(2025, 5, 2))]


def test_event_time_that_is_a_timestamp_stays(spark):
    df = spark.sql("select 1 as user_id, timestamp_ntz '2025-05-01 10:00:00' as event_ts")
    row = clean.clean_stream(df, clean.NON_PII, "events", "2025_05_01").first()
    assert (str(row.event_ts), str(row.event_date)) == ("2025-05-01 10:00:00", "2025-05-01")
