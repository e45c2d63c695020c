import datetime as dt

import pytest

from turnstile.operators import clean
from turnstile.streaming import ingest, live

SCHEMA = "event_id string, event_type string, event_ts string"
GOOD = "2025-05-01T10:00:00"


@pytest.fixture
def paths(tmp_path):
    return ingest.IngestPaths(f"{tmp_path}/in", f"{tmp_path}/out", "non-pii")


@pytest.fixture
def put(spark, paths):
    def write(folder, data, schema=SCHEMA, mode="append"):
        spark.createDataFrame(data, schema).write.mode(mode).parquet(f"{paths.source}/non-pii/events/{folder}")

    return write


def run_batch(spark, paths, rows, schema=SCHEMA):
    outcome = ingest.ingest_pending(spark, paths, "events", clean.NON_PII, schema)
    return {unit.split("/")[-1]: what for unit, what in rows(outcome, "unit", "outcome")}


def run_stream(spark, paths, rows, schema=SCHEMA):
    ingest.start_ingest(spark, paths, "events", schema, clean.NON_PII).awaitTermination()


def result(spark, paths, rows):
    df = ingest.read_cleaned(spark, paths.cleaned("events"))
    return rows(df, "event_id", "event_type", "event_ts", "year", "month", "day")


AT = dt.datetime(2025, 5, 1, 10)


def test_batch_runs_are_incremental(spark, paths, put, rows):
    put("events_20250501", [("1", " Signup ", GOOD), ("1", " Signup ", GOOD), ("2", "cancel", "x")])
    put("events_20250502", [("1", " Signup ", GOOD)])
    put("events_2025", [("9", "a", GOOD)])
    put("events_20250503", [], mode="overwrite")
    assert run_batch(spark, paths, rows) == {
        "events_20250501": "loaded",
        "events_20250502": "loaded",
        "events_20250503": "loaded",
        "events_2025": "skipped",
    }
    expected = [("1", "signup", AT, 2025, 5, 1), ("1", "signup", AT, 2025, 5, 2), ("2", "cancel", None, 2025, 5, 1)]
    assert result(spark, paths, rows) == expected
    put("events_20250502", [("late", "a", GOOD)])
    assert run_batch(spark, paths, rows) == {"events_2025": "skipped"}
    put("other_20250504", [("4", "a", GOOD)])
    assert run_batch(spark, paths, rows) == {"events_2025": "skipped", "other_20250504": "loaded"}
    assert len(result(spark, paths, rows)) == 4


def test_failed_folder_is_isolated_and_retried(spark, paths, put, rows):
    for day in range(1, 6):
        put(f"events_2025050{day}", [(str(day), "a", GOOD)])
    put("events_20250503", [("3", "a", 1.5)], "event_id string, event_type string, event_ts double", "overwrite")
    outcome = run_batch(spark, paths, rows)
    assert [f for f, what in outcome.items() if what == "failed"] == ["events_20250503"]
    assert [r[0] for r in result(spark, paths, rows)] == ["1", "2", "4", "5"]
    put("events_20250503", [("3", "a", GOOD)], mode="overwrite")
    assert run_batch(spark, paths, rows) == {"events_20250503": "loaded"}
    assert [r[0] for r in result(spark, paths, rows)] == ["1", "2", "3", "4", "5"]


def test_repeat_after_a_crash_before_the_ledger(spark, paths, put, rows, monkeypatch):
    put("events_20250501", [("1", "a", GOOD)])

    def crash(*_):
        raise RuntimeError("lost")

    monkeypatch.setattr(ingest, "_add_to_ledger", crash)
    assert run_batch(spark, paths, rows) == {"events_20250501": "failed"}
    monkeypatch.undo()
    assert run_batch(spark, paths, rows) == {"events_20250501": "loaded"}
    assert [r[0] for r in result(spark, paths, rows)] == ["1"]


def test_stream_equals_batch(spark, paths, put, rows, tmp_path):
    other = ingest.IngestPaths(paths.source, f"{tmp_path}/out2", "non-pii")
    put("events_20250501", [("1", " Signup ", GOOD), ("1", " Signup ", GOOD), ("2", "cancel", "x")])
    put("events_20250502", [("1", " Signup ", GOOD)])
    put("events_2025", [("9", "a", GOOD)])
    for run in range(3):
        if run == 1:
            put("events_20250502", [("late", "a", GOOD)])
            put("other_20250501", [("4", "a", GOOD), ("1", " Signup ", GOOD)])
        run_stream(spark, paths, rows)
        if run == 0:
            run_batch(spark, other, rows)
        else:
            ingest.ingest_pending(spark, other, "events", clean.NON_PII, SCHEMA)
        assert result(spark, paths, rows) == result(spark, other, rows)
    assert len(result(spark, paths, rows)) == 5
    bad = spark.read.parquet(paths.quarantine("events"))
    assert rows(bad, "unit", "event_id", "reason") == [
        ("events_2025", "9", "folder name"),
        ("events_20250501", "2", "event_ts"),
        ("events_20250502", "late", "late"),
    ]


def test_stream_repeat_after_a_crash(spark, paths, put, rows, monkeypatch):
    put("events_20250501", [("1", "a", GOOD)])

    def crash(*_):
        raise RuntimeError("lost")

    monkeypatch.setattr(ingest, "_add_to_ledger", crash)
    with pytest.raises(Exception):
        run_stream(spark, paths, rows)
    monkeypatch.undo()
    put("events_20250502", [("2", "a", GOOD)])
    run_stream(spark, paths, rows)
    run_stream(spark, paths, rows)
    assert [r[0] for r in result(spark, paths, rows)] == ["1", "2"]


def test_stream_repeat_after_a_crash_behind_the_ledger(spark, paths, put, rows, monkeypatch):
    """The ledger already lists the folder, but the micro-batch is run again: nothing counts as late."""
    put("events_20250501", [("1", "a", GOOD)])
    add = ingest._add_to_ledger

    def add_and_crash(*args):
        add(*args)
        raise RuntimeError("lost")

    monkeypatch.setattr(ingest, "_add_to_ledger", add_and_crash)
    with pytest.raises(Exception):
        run_stream(spark, paths, rows)
    monkeypatch.undo()
    run_stream(spark, paths, rows)
    assert [r[0] for r in result(spark, paths, rows)] == ["1"]
    assert spark.read.schema("event_id string").parquet(paths.quarantine("events")).count() == 0


def test_pii_layout_keeps_day_as_data(spark, tmp_path, rows):
    paths = ingest.IngestPaths(f"{tmp_path}/in", f"{tmp_path}/out", "pii")
    people = spark.createDataFrame([("U1", " A@X "), ("U1", " A@X ")], "user_id string, email string")
    people.write.parquet(f"{paths.source}/pii/users/users_20250507")
    people.write.parquet(f"{paths.source}/pii/users/users")
    ingest.ingest_pending(spark, paths, "users", clean.PII).collect()
    df = ingest.read_cleaned(spark, paths.cleaned("users"))
    assert rows(df, "user_id", "email", "year", "month", "day") == [("u1", "a@x", 2025, 5, 1), ("u1", "a@x", 2025, 5, 7)]
    assert (tmp_path / "out" / "pii" / "users" / "year=2025" / "month=5" / "unit=users_20250507").is_dir()


def test_convert(spark, tmp_path, rows):
    raw = tmp_path / "raw" / "non-pii" / "events"
    raw.mkdir(parents=True)
    (raw / "a.1.csv").write_text("n,name\n1,x\n")
    (raw / "a.2.csv").write_text("n,name\n2,y\n")
    (raw / "b.JSON").write_text('{"n": 3, "name": "z"}\n')
    (raw / "c.xlsx").write_text("?")
    (raw / "c.csv").write_text("n,name\n4,w\n")
    (raw / "d.csv").write_text("name,n\nq,9\n")
    (raw / "none").write_text("?")
    (raw / "zero.csv").write_text("")
    source, target = f"{tmp_path}/raw", f"{tmp_path}/parquet"
    plan = ingest.conversion_plan(spark, source, target)
    assert {r["path"].rsplit("/", 1)[1]: r["action"] for r in plan.collect()} == {
        "a.1.csv": "convert",
        "a.2.csv": "exists",
        "b.JSON": "convert",
        "c.xlsx": "unsupported",
        "c.csv": "convert",
        "d.csv": "convert",
        "none": "unsupported",
    }
    assert {what for (what,) in rows(ingest.convert_pending(spark, source, target), "outcome")} == {"converted"}
    units = {u: spark.read.parquet(f"{target}/non-pii/events/unit={u}") for u in "abcd"}
    found = {u: rows(df, "n", "name") for u, df in units.items()}
    assert found == {"a": [(1, "x")], "b": [(3, "z")], "c": [(4, "w")], "d": [(9, "q")]}
    assert all(sorted(df.columns) == ["n", "name", "processed_time"] for df in units.values())
    assert ingest.convert_pending(spark, source, target).count() == 0


def test_convert_stream(spark, tmp_path, rows):
    raw = tmp_path / "raw"
    raw.mkdir()
    (raw / "a_20250501.csv").write_text("n,name\n1,x\n")
    out, check = f"{tmp_path}/out", f"{tmp_path}/check"
    for run in range(2):
        ingest.start_convert(spark, str(raw), out, "csv", "n int, name string", check).awaitTermination()
        if run == 0:
            (raw / "a_20250502.csv").write_text("n,name\n2,y\n")
    assert rows(spark.read.parquet(out), "unit", "n", "name") == [("a_20250501", 1, "x"), ("a_20250502", 2, "y")]


def test_isolation_visits_only_what_it_must():
    calls = []

    def load(names):
        calls.append(list(names))
        if "bad" in names:
            raise ValueError("no\nmore")

    assert ingest.run_isolated(["a", "b", "bad", "c"], load) == [("bad", "no")]
    assert calls == [["a", "b", "bad", "c"], ["a", "b"], ["bad", "c"], ["bad"], ["c"]]
    assert ingest.run_isolated([], load) == []


EVENTS = "event_id string, user_id string, session_id string, event_type string, event_ts timestamp_ntz"


def event(number, kind, at):
    return (str(number), "u", "s", kind, at)


def test_live_state_and_counts_follow_late_events(spark, tmp_path, rows):
    source = f"{tmp_path}/in"

    def add(*data):
        spark.createDataFrame(list(data), EVENTS).write.mode("append").parquet(source)

    def run(name, make, keys):
        stream = make(spark.readStream.schema(EVENTS).parquet(source))
        live.start_changelog(stream, f"{tmp_path}/{name}", f"{tmp_path}/{name}-check").awaitTermination()
        return live.read_changelog(spark, f"{tmp_path}/{name}", keys)

    add(event(2, "signup", dt.datetime(2025, 5, 5, 10)), event(1, "view", dt.datetime(2025, 5, 4, 9)))
    assert rows(run("state", live.live_state, ["user_id", "session_id"]), "event_type") == [("signup",)]
    monday, sunday = dt.datetime(2025, 5, 5), dt.datetime(2025, 5, 4)
    assert rows(run("days", live.live_daily, ["window_start"])) == [(sunday, 1), (monday, 1)]
    assert rows(run("weeks", live.live_weekly, ["window_start"])) == [(dt.datetime(2025, 4, 28), 1), (monday, 1)]
    add(event(3, "cancel", dt.datetime(2025, 5, 4, 8)))
    assert rows(live.standing_signups(run("state", live.live_state, ["user_id", "session_id"])), "event_type") == [("signup",)]
    assert rows(run("days", live.live_daily, ["window_start"])) == [(sunday, 2), (monday, 1)]
    hours = run("hours", live.live_hourly, ["window_start"])
    assert rows(live.hour_of_day_totals(hours)) == [(10, 1), (8, 1), (9, 1)]
    add(event(4, "cancel", dt.datetime(2025, 5, 6, 8)))
    assert rows(live.standing_signups(run("state", live.live_state, ["user_id", "session_id"]))) == []


def test_watermark_is_optional(spark, tmp_path, rows):
    source = f"{tmp_path}/in"
    spark.createDataFrame([event(1, "a", dt.datetime(2025, 5, 5, 10))], EVENTS).write.parquet(source)
    stream = spark.readStream.schema(EVENTS).parquet(source)
    counts = live.live_counts(stream, "1 hour", watermark="1 day")
    live.start_changelog(counts, f"{tmp_path}/log", f"{tmp_path}/check").awaitTermination()
    found = spark.read.parquet(f"{tmp_path}/log")
    assert rows(found, "window_start", "event_count") == [(dt.datetime(2025, 5, 5, 10), 1)]
