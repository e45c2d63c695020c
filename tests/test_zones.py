import datetime as dt

import pytest

from turnstile.functions import clock
from turnstile.plans import classes, events, users
from turnstile.sources import zones

SCHEMA = "event_id string, user_id string, session_id string, event_type string, event_ts timestamp_ntz, processed_time timestamp_ntz, year int, month int"


def row(i, at, month=None):
    return (str(i), f"u{i % 3}", f"s{i}", "signup", at, at, 2025, month or at.month)


ROWS = [row(i, dt.datetime(2025, m, d, 8)) for i, (m, d) in enumerate((m, d) for m in range(1, 7) for d in (1, 10, 20))]
LATE = [row(90, dt.datetime(2025, 1, 25), 5)]
NO_TIME = [("99", "u", "s", "signup", None, None, 2025, 7)]


@pytest.fixture
def path(spark, tmp_path):
    at = f"{tmp_path}/fact_event"
    zones.write_sorted(spark.createDataFrame(ROWS + LATE + NO_TIME, SCHEMA), at, ["year", "month"], "event_ts")
    return at


def months(df):
    """Months of the partitions that a frame would open."""
    return sorted({int(f.split("month=")[1].split("/")[0]) for f in df.inputFiles()})


def between(spark, path, start, end=None):
    at = lambda day: None if day is None else clock.moment(day)
    return zones.read_between(spark, path, "event_ts", at(start), at(end))


def test_only_partitions_that_can_hold_the_range(spark, path):
    assert months(between(spark, path, "2025-04-05", "2025-04-15")) == [4, 5]  # May holds an event of January and so overlaps
    assert months(between(spark, path, "2025-05-21")) == [6]
    assert months(between(spark, path, "2025-01-21", "2025-01-31")) == [5]
    assert months(between(spark, path, None, "2025-01-10")) == [1]
    assert months(between(spark, path, None, None)) == [1, 2, 3, 4, 5, 6, 7]
    nothing = between(spark, path, "2026-01-01")
    assert nothing.columns == SCHEMA.replace(",", "").split()[::2] and nothing.count() == 0


def test_a_map_out_of_date_costs_no_rows(spark, path):
    late = spark.createDataFrame([row(91, dt.datetime(2025, 6, 15), 2)], SCHEMA)
    late.write.mode("append").partitionBy("year", "month").parquet(path)
    found = between(spark, path, "2025-06-12", "2025-06-18")
    assert months(found) == [2, 6] and found.where("event_ts = '2025-06-15'").count() == 1
    zones.update_zones(spark, path, "event_ts")
    assert months(between(spark, path, "2025-06-12", "2025-06-18")) == [2, 6]
    assert months(between(spark, path, "2025-06-21", "2025-06-22")) == []
    assert months(between(spark, path, "2025-03-12", "2025-03-18")) == [2, 3, 5]


def test_only_changed_partitions_are_looked_into(spark, path, rows):
    assert {load for *_, load in rows(zones.read_zones(spark, path), "partition", "load")} == {1}
    zones.update_zones(spark, path, "event_ts")
    zones.write_sorted(spark.createDataFrame([row(92, dt.datetime(2025, 8, 1))], SCHEMA), path, ["year", "month"], "event_ts", dynamic=True)
    assert [load for *_, load in rows(zones.read_zones(spark, path), "partition", "load")] == [1] * 7 + [2]
    assert months(between(spark, path, "2025-07-15")) == [8]


def test_map_is_lost_or_stale_after_a_rewrite(spark, path):
    spark.createDataFrame(ROWS, SCHEMA).write.mode("overwrite").partitionBy("year", "month").parquet(path)
    assert months(between(spark, path, "2025-06-12", "2025-06-18")) == [1, 2, 3, 4, 5, 6]
    zones.update_zones(spark, path, "event_ts")
    assert months(between(spark, path, "2025-06-12", "2025-06-18")) == [6]


def test_files_are_sorted_by_time(spark, path):
    for place in {f.rsplit("/", 1)[0] for f in spark.read.parquet(path).inputFiles()}:
        for part in spark.read.parquet(place).inputFiles():
            times = [r.event_ts for r in spark.read.parquet(part).collect()]
            assert times == sorted(times, key=lambda t: (t is not None, t))


def test_odd_partition_names(spark, tmp_path):
    at = f"{tmp_path}/odd [x]"
    names = ["a b", "c=d", "e%2Ff", "g+h", "ü"]
    data = [(n, dt.datetime(2025, i + 1, 1)) for i, n in enumerate(names)]
    zones.write_sorted(spark.createDataFrame(data, "name string, event_ts timestamp_ntz"), at, ["name"], "event_ts")
    for i, name in enumerate(names):
        found = between(spark, at, f"2025-0{i + 1}-01", f"2025-0{i + 1}-02").collect()
        assert [(r["name"], r["event_ts"]) for r in found] == [(name, dt.datetime(2025, i + 1, 1))]


QUERIES = {
    "daily": lambda t: events.daily_trends(t, as_of="2025-06-20"),
    "hourly": lambda t: events.hourly_distribution(t, as_of="2025-06-20"),
    "weekly": lambda t: events.weekly_trends(t, as_of="2025-06-20", days=20),
    "users": lambda t: users.active_users(t, as_of="2025-06-20"),
    "types": lambda t: users.type_preferences(t, as_of="2025-06-20"),
    "engagement": lambda t: users.engagement(t, as_of="2025-06-20", min_days=0),
}


@pytest.mark.parametrize("name", QUERIES)
def test_queries_open_no_other_file(spark, path, rows, name):
    plain = {"events": spark.read.parquet(path)}
    tables = zones.zoned_tables(spark, {"other": plain["events"]}, {"events": path})
    found = QUERIES[name](tables)
    assert rows(found) == rows(QUERIES[name](plain)) and found.count() > 0
    assert months(found) in ([5, 6], [6]) and months(QUERIES[name](plain)) == [1, 2, 3, 4, 5, 6, 7]


def test_leaderboard_and_trend(spark, path, rows):
    attended = spark.createDataFrame([("u0", "s1", dt.datetime(2025, 4, 2))], "user_id string, session_id string, class_datetime timestamp_ntz")
    others = {
        "fact_class_attendance": attended,
        "dim_user_v3": spark.createDataFrame([(f"u{i}", "f", "l") for i in range(3)], "user_id string, first_name string, last_name string"),
        "dim_class_session": spark.createDataFrame([(f"s{i}", 2025, 4, "L") for i in range(9)], "session_id string, year int, month int, location_id string"),
        "dim_location": spark.createDataFrame([("L", "c", "n")], "location_id string, city string, location_name string"),
    }
    plain = others | {"fact_event": spark.read.parquet(path)}
    tables = zones.zoned_tables(spark, others, {"fact_event": path})
    for query in (lambda t: classes.leaderboard(t, month=dt.date(2025, 4, 1)), lambda t: classes.location_trend(t, year=2025)):
        assert rows(query(tables)) == rows(query(plain)) != []
    opened = tables.between("fact_event", "event_ts", clock.moment("2025-04-01"), clock.moment("2025-05-01"))
    assert months(opened) == [4, 5] and tables.between("dim_location", "x") is tables["dim_location"]
