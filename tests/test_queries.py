"""Golden rows for the decisions that the queries rest on."""

import datetime as dt

import pytest

from turnstile.plans import catalog, classes, members, users, warehouse
from turnstile.sources.readers import Tables

EVENT = (
    "event_id string, user_id string, session_id string, event_type string, event_ts timestamp_ntz, "
    "class_datetime timestamp_ntz, processed_time timestamp_ntz, year int, month int"
)
ATTENDED = "user_id string, session_id string, class_datetime timestamp_ntz"
USER = "user_id string, first_name string, last_name string, email string, gender string, age int, date_of_birth date"
SESSION = "session_id string, class_name string, location_id string, year int, month int"
PLACE = "location_id string, city string, location_name string"


def ts(text):
    return dt.datetime.fromisoformat(text) if text else None


@pytest.fixture
def make(spark):
    def build(event=(), attended=(), user=(), session=(), place=(), stream=()):
        data = {
            "fact_event": (
                [(e, u, s, t, ts(at), ts(cls), ts(at), ts(at).year, ts(at).month) for e, u, s, t, at, cls in event],
                EVENT,
            ),
            "fact_class_attendance": ([(u, s, ts(at)) for u, s, at in attended], ATTENDED),
            "dim_user_v3": (list(user), USER),
            "dim_class_session": (list(session), SESSION),
            "dim_location": (list(place), PLACE),
            "events": ([(e, u, t, ts(at)) for e, u, t, at in stream], "event_id string, user_id string, event_type string, event_ts timestamp_ntz"),
        }
        return Tables({name: (lambda d=d, s=s: spark.createDataFrame(d, s)) for name, (d, s) in data.items()})

    return build


def test_days_and_times_differ_in_the_anti_step(make):
    sunday, monday = "2025-05-04 09:00", "2025-05-05 09:00"
    tables = make(
        event=[
            ("1", "u1", "s1", "cancel", "2025-04-01 01:00", monday),
            ("2", "u1", "s1", "signup", "2025-04-01 02:00", monday),
            ("3", "u2", "s1", "signup", "2025-05-01 02:00", sunday),
            ("4", "u3", "s1", "signup", "2025-06-01 02:00", sunday),
        ],
        attended=[("u", "s", "2025-04-30 23:59"), ("u", "s", "2025-05-01 00:00"), ("u", "s", "2024-12-31 10:00")],
    )
    days = {r["weekday_name"]: (r["weekday"], r["total_sessions"]) for r in classes.class_days(tables).collect()}
    assert days == {"Sunday": (1, 1), "Wednesday": (4, 1)}
    assert {tuple(r) for r in classes.class_times(tables).collect()} == {(9, 2), (23, 1)}


def test_pair_in_both_sources(make):
    tables = make(
        event=[("1", "u1", "s1", "signup", "2025-03-01 01:00", None), ("2", "u9", "none", "signup", "2025-03-01 01:00", None)],
        attended=[("u1", "s1", "2025-01-01"), ("u1", "s1", "2025-01-02"), (None, "s1", "2025-01-01")],
        session=[("s1", "Yoga", "l1", 2025, 3), ("old", "Yoga", "l1", 2024, 3)],
        place=[("l1", "NYC", "Main"), ("l1", "nyc", "main"), ("l2", "nyc", "Other")],
    )
    assert [tuple(r) for r in classes.location_trend(tables).collect()] == [("l1", "nyc", "main", 2025, 3, 2)]
    assert [tuple(r) for r in classes.popular_classes(tables).collect()] == [("Yoga", 1)]


def test_pairs_without_separator_collide_unless_exact(make):
    tables = make(
        attended=[("1", "23", "2025-01-01"), ("12", "3", "2025-01-01")],
        session=[("23", "Yoga", "l1", 2025, 1), ("3", "Yoga", "l1", 2025, 1)],
        place=[("l1", "x", "y")],
    )
    assert classes.popular_classes(tables).first()["attendance_count"] == 1
    assert classes.popular_classes(tables, exact_pairs=True).first()["attendance_count"] == 2
    assert classes.location_trend(tables).first()["total_attendance"] == 1
    assert classes.location_trend(tables, exact_pairs=True).first()["total_attendance"] == 2


def test_leaderboard_ignores_checkins_and_fans_out_over_user_rows(make):
    tables = make(
        event=[
            ("1", "u1", "s1", "signup", "2025-04-02 01:00", None),
            ("2", "u1", "s1", "checkin", "2025-04-02 02:00", None),
            ("3", "u2", "s1", "signup", "2025-04-02 01:00", None),
            ("4", "u2", "s1", "cancel", "2025-04-02 02:00", None),
            ("5", "u1", "s3", "signup", "2025-05-01 00:00", None),
        ],
        attended=[("u1", "s2", "2025-04-30 23:59"), ("u1", "s4", "2025-05-01 00:00")],
        user=[("u1", "A", "B", None, None, None, None), ("u1", "A", "C", None, None, None, None)],
    )
    assert [tuple(r) for r in classes.leaderboard(tables).collect()] == [("u1", "A", "B", 2), ("u1", "A", "C", 2)]


def test_two_churn_boundaries(make):
    tables = make(
        attended=[("edge", "s", "2025-01-01 10:00"), ("gone", "s", "2024-12-01 10:00"), ("void", "s", None)],
        event=[("1", "new", "s", "signup", "2025-04-01 10:00", None)],
        user=[("gone", "A", "B", "a@b", None, None, None)],
    )
    as_of = dt.date(2025, 4, 2)
    summary = {r["churn_status"]: (r["user_count"], r["percentage"]) for r in users.churn_summary(tables, as_of).collect()}
    assert summary == {"Churned": (2, 50.0), "Active": (2, 50.0)}
    listed = [(r["user_id"], r["email"], r["days_inactive"]) for r in users.churned_users(tables, as_of).collect()]
    assert listed == [("gone", "a@b", 121)]


def test_inactivity_tiers(make):
    as_of = dt.date(2025, 3, 1)
    stream = [(str(d), f"u{d}", "view", str(as_of - dt.timedelta(days=d)) + " 23:00") for d in (14, 15, 30, 31)]
    found = [tuple(r)[2:] for r in users.inactivity_risk(make(stream=stream), as_of).collect()]
    assert found == [(31, "High Risk"), (30, "Medium Risk"), (15, "Medium Risk"), (14, "Low Risk")]


def test_engagement_divides_in_whole_numbers(make):
    stream = [(str(i), "u1", "view", f"2025-03-0{1 + i % 2} 10:00") for i in range(5)] + [("9", "u2", "view", "2025-03-01 10:00")]
    assert [tuple(r) for r in users.engagement(make(stream=stream), dt.date(2025, 3, 5)).collect()] == [("u1", 2, 5, 2)]


def test_ages(make):
    born = dt.date(1990, 6, 15)
    people = [(f"u{a}", None, None, None, None, a, born) for a in (24, 25, 34, 35, 44, 45)]
    people += [("dob", None, None, None, None, None, born), ("none", None, None, None, None, None, None)]
    people += [("two", None, None, None, None, 20, None), ("two", None, None, None, None, 50, None), ("u24", None, None, None, None, 24, None)]
    tables = make(user=people)
    before, after = dt.date(2025, 6, 14), dt.date(2025, 6, 15)
    assert [tuple(r) for r in users.age_distribution(tables, before).collect()] == [("25-34", 3), ("35-44", 2), ("45+", 2), ("<25", 2)]
    assert [tuple(r) for r in users.age_distribution(tables, after).collect()] == [("25-34", 2), ("35-44", 3), ("45+", 2), ("<25", 2)]


def test_leap_day_birthday(make):
    tables = make(user=[("u", None, None, None, None, None, dt.date(2000, 2, 29))])
    assert [tuple(r) for r in users.age_distribution(tables, dt.date(2025, 2, 27)).collect()] == [("<25", 1)]
    assert [tuple(r) for r in users.age_distribution(tables, dt.date(2025, 2, 28)).collect()] == [("25-34", 1)]


def test_genders(make):
    people = [(str(i), None, None, None, g, None, None) for i, g in enumerate(["MALE", "male", "Female", "unknown", None])]
    assert [tuple(r) for r in users.gender_distribution(make(user=people)).collect()] == [("Male", 2), ("Female", 1)]


def test_renewals_and_facilities(spark):
    tables = {
        "membership_renewals": spark.createDataFrame(
            [("a", "renewed", ts("2025-01-01")), ("a", "lapsed", ts("2025-01-01")), ("a", None, ts("2025-01-02")), ("b", "lapsed", ts("2020-01-01"))],
            "membership_type string, renewal_status string, renewal_date timestamp_ntz",
        ),
        "facility_usage": spark.createDataFrame(
            [("f", "F", dt.date(2025, 1, 3), ts("2025-01-03 07:30")), ("f", "F", dt.date(2024, 12, 1), ts("2024-12-01 07:30"))],
            "facility_id string, facility_name string, usage_date date, usage_time timestamp_ntz",
        ),
    }
    as_of = dt.date(2025, 1, 5)
    assert [tuple(r) for r in members.renewal_rate(tables, as_of).collect()] == [("a", 1, 3, 100 / 3)]
    assert [tuple(r) for r in members.facility_use(tables, as_of).collect()] == [("f", "F", 1)]
    assert [tuple(r) for r in members.facility_peak_hours(tables, as_of).collect()] == [(7, "f", "F", 1)]
    assert [tuple(r) for r in members.facility_trend(tables, as_of).collect()] == [(ts("2025-01-03"), "f", "F", 1)]


def test_catalog(make):
    tables = make(stream=[("1", "u", "view", "2025-01-01")])
    names = [n for c in catalog.get_query_categories() for n in catalog.get_queries_in_category(c)]
    assert len(names) == len(set(names)) == 24
    assert catalog.run_query(tables, "Basic Queries", "Total Event Count").first()["total_events"] == 1
    assert catalog.get_queries_in_category("nothing") == {}
    assert catalog.run_query(tables, "Basic Queries", "nothing") is None


def test_ad_hoc_sql(spark, make):
    tables = make(stream=[("1", "u", "view", "2025-01-01")])
    df = catalog.run_sql(spark, "SELECT event_type, count(*) AS n FROM my_events GROUP BY 1", {"my_events": tables["events"]})
    assert [tuple(r) for r in df.collect()] == [("view", 1)]


def test_results_do_not_depend_on_the_session_zone(spark, make):
    tables = make(stream=[("1", "u", "view", "2025-03-09 02:30"), ("2", "u", "view", "2025-03-08 23:30")])
    from turnstile.plans import events

    expected = [(ts("2025-03-08"), 1), (ts("2025-03-09"), 1)]
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        for other in ("UTC", "America/New_York", "Asia/Tokyo"):
            spark.conf.set("spark.sql.session.timeZone", other)
            assert [tuple(r) for r in events.daily_trends(tables, dt.date(2025, 3, 9)).collect()] == expected
            assert [tuple(r) for r in events.weekly_trends(tables, dt.date(2025, 3, 9)).collect()] == [(ts("2025-03-03"), 2)]
            assert {r[0] for r in events.hourly_distribution(tables, dt.date(2025, 3, 9)).collect()} == {2, 23}
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_attendance_fact(spark, rows):
    attendee = "attendees array<struct<email: string, user_id: string>>"
    schema = (
        "attendance_count bigint, class_datetime string, class_name string, instructor_name string, location_id string, "
        "session_id string, processed_time timestamp_ntz, processed_timestamp timestamp_ntz, " + attendee
    )

    def session(session_id, people, at="1746093600123"):
        return (len(people or []), at, "c", "i", "l", session_id, None, None, people)

    nested = spark.createDataFrame(
        [session("23", [("a@b", "1")]), session("3", [("c@d", "12"), ("e@f", None)]), session("x", None), session("y", [])], schema
    )
    expanded = warehouse.expanded_attendance(nested)
    assert rows(expanded, "session_id", "user_id") == [("23", "1"), ("3", None), ("3", "12")]
    fact = {(r["user_id"], r["session_id"]): r for r in warehouse.fact_class_attendance(expanded).collect()}
    assert fact["1", "23"]["attendance_id"] == fact["12", "3"]["attendance_id"] == fact["1", "23"]["attendance_id"].upper()
    assert fact[None, "3"]["attendance_id"] is None
    assert fact["1", "23"]["class_datetime"] == ts("2025-05-01 10:00:00")


def test_event_fact(spark, rows):
    schema = (
        "event_id string, user_id string, session_id string, event_type string, event_ts timestamp_ntz, location_id string, "
        "class_datetime string, processed_time timestamp_ntz, year int, month int, day int"
    )

    def event(event_id, kind, at, month=5, day=7):
        return (event_id, "u", "s", kind, None, "l", at, None, 2025, month, day)

    data = [event("1", "signup", "2025-05-01t10:00:00"), event("2", "signup", "unknown", 13), event(None, "signup", None), event("4", None, None)]
    fact = warehouse.fact_event(spark.createDataFrame(data, schema))
    assert rows(fact, "event_id", "class_datetime", "event_partition_date") == [
        ("1", ts("2025-05-01 10:00:00"), dt.date(2025, 5, 7)),
        ("2", None, None),
    ]


def test_dimensions_keep_all_rows_unless_asked(spark, rows):
    schema = "user_id string, first_name string, last_name string, gender string, email string, phone_number string, date_of_birth string, age int, city string, preferred_location_id string, created_at string"
    data = [("u", "A", None, None, None, None, "2000-01-01", None, None, None, "2025-01-01 00:00:00"), ("u", "B", None, None, None, None, "unknown", None, None, None, "2025-02-01 00:00:00")]
    people = spark.createDataFrame(data, schema)
    assert rows(warehouse.dim_user(people), "first_name", "date_of_birth") == [("A", dt.date(2000, 1, 1)), ("B", None)]
    assert rows(warehouse.dim_user(people, dedupe=True), "first_name") == [("B",)]
