import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from turnstile.operators.state import latest_state
from turnstile.plans.classes import untouched_signups
from turnstile.streaming.live import live_state, standing_signups

SCHEMA = "event_id string, user_id string, session_id string, event_type string, event_ts timestamp_ntz, class_datetime timestamp_ntz"


def at(hour):
    return None if hour is None else dt.datetime(2025, 4, 1, hour)


def events(spark, data):
    """Rows given as (event, user, session, type, hour)."""
    return spark.createDataFrame([(e, u, s, t, at(h), at(12)) for e, u, s, t, h in data], SCHEMA)


def test_type_is_tested_after_the_ranking(spark, rows):
    df = events(
        spark,
        [
            ("1", "u1", "s", "signup", 1),
            ("2", "u1", "s", "cancel", 2),
            ("3", "u2", "s", "cancel", 1),
            ("4", "u2", "s", "signup", 2),
            ("5", "u3", "s", "signup", 1),
            ("6", "u3", "s", "checkin", 2),
            ("7", "u4", "s", "signup", None),
            ("8", "u4", "s", "cancel", 1),
            ("9", "u5", "s", "cancel", 3),
            ("91", "u5", "s", "signup", 3),
        ],
    )
    assert rows(latest_state(df, ["event_ts"]), "user_id") == [("u2",), ("u5",)]
    without_checkins = latest_state(df, ["event_ts"], where=F.col("event_type").isin("signup", "cancel"))
    assert rows(without_checkins, "user_id") == [("u2",), ("u3",), ("u5",)]


def test_untouched_signups_equal_the_anti_join(spark, rows):
    df = events(
        spark,
        [
            ("1", "u1", "s", "cancel", 1),
            ("2", "u1", "s", "signup", 2),
            ("3", "u2", "s", "signup", 2),
            ("4", "u3", "s", None, 1),
            ("5", "u3", "s", "signup", 2),
            ("6", None, "s", "cancel", 1),
            ("7", None, "s", "signup", 2),
            ("8", "u4", None, "checkin", 1),
            ("9", "u4", None, "signup", 2),
        ],
    )
    touched = df.where(F.col("event_type").isin("checkin", "cancel"))
    anti = latest_state(df, ["event_ts"]).join(touched, ["user_id", "session_id"], "left_anti")
    one_pass = untouched_signups(df)
    expected = [(None, "s"), ("u2", "s"), ("u3", "s"), ("u4", None)]
    assert rows(anti, "user_id", "session_id") == expected
    assert rows(one_pass, "user_id", "session_id") == expected


event = st.tuples(
    st.sampled_from(["u1", "u2", None]),
    st.sampled_from(["s1", "s2", None]),
    st.sampled_from(["signup", "cancel", "checkin", "view", None]),
    st.one_of(st.none(), st.integers(0, 4)),
)


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(event, max_size=25))
def test_latest_state_against_brute_force(spark, data):
    numbered = [(f"{i:03d}", *e) for i, e in enumerate(data)]
    best = {}
    for e, u, s, t, h in numbered:
        rank = (h is not None, h or 0, e)
        if (u, s) not in best or rank > best[u, s][0]:
            best[u, s] = (rank, t)
    expected = {k for k, (_, t) in best.items() if t == "signup"}
    touched = {(u, s) for _, u, s, t, _ in numbered if t in ("checkin", "cancel") and u is not None and s is not None}
    df = events(spark, numbered)

    def pairs(result):
        found = [(r["user_id"], r["session_id"]) for r in result.collect()]
        assert len(found) == len(set(found))
        return set(found)

    assert pairs(latest_state(df, ["event_ts"])) == expected
    assert pairs(standing_signups(live_state(df))) == expected
    assert pairs(untouched_signups(df)) == expected - touched
