import datetime as dt

import pytest

from turnstile.operators import clean
from turnstile.streaming import folders, ingest

SCHEMA = "event_id string, event_type string, event_ts string"
GOOD = "2025-05-01T10:00:00"
AT = dt.datetime(2025, 5, 1, 10)


@pytest.fixture
def paths(tmp_path):
    return folders.FolderPaths(f"{tmp_path}/in", f"{tmp_path}/out", "non-pii")


@pytest.fixture
def put(spark, paths):
    def write(folder, data, schema=SCHEMA, mode="append", kind="events"):
        spark.createDataFrame(data, schema).coalesce(1).write.mode(mode).parquet(f"{paths.source}/non-pii/{kind}/{folder}")

    return write


@pytest.fixture
def batch(spark, paths):
    def run(schema=SCHEMA):
        rows = folders.ingest_folders(spark, paths, "events", clean.NON_PII, schema).collect()
        return {r["unit"].split("/")[-1]: (r["outcome"], r["rows_in"], r["rows_out"], r["removed"], r["rejected"]) for r in rows}

    return run


@pytest.fixture
def stream(spark, paths):
    def run(schema=SCHEMA):
        folders.start_folder_ingest(spark, paths, "events", clean.NON_PII, schema).awaitTermination()

    return run


@pytest.fixture
def ids(spark, paths, rows):
    return lambda: rows(ingest.read_cleaned(spark, paths.cleaned("events")), "event_id", "day")


@pytest.fixture
def rejected(spark, paths, rows):
    return lambda: rows(spark.read.schema("event_id string, unit string, reason string").parquet(paths.rejected("events")), "event_id", "unit", "reason")


def test_late_files_are_loaded_and_reported(put, batch, ids, rejected):
    put("events_20250501", [("1", " Signup ", GOOD), ("1", " Signup ", GOOD), ("2", "cancel", "x")])
    put("events_20250502", [("1", "a", GOOD)])
    assert batch() == {"events_20250501": ("loaded", 3, 2, 1, 1), "events_20250502": ("loaded", 1, 1, 0, 0)}
    assert batch() == {}
    # One file repeats a row that is there already.
    put("events_20250502", [("late", "a", GOOD), ("1", "a", GOOD)])
    assert batch() == {"events_20250502": ("loaded", 3, 2, 1, 0)}
    assert ids() == [("1", 1), ("1", 2), ("2", 1), ("late", 2)]
    assert rejected() == [("2", "events_20250501", "event_ts")]
    assert batch() == {}


def test_a_file_replaced_by_one_of_equal_size(put, batch, ids):
    put("events_20250501", [("1", "a", GOOD)])
    assert batch()["events_20250501"][0] == "loaded"
    put("events_20250501", [("2", "a", GOOD)], mode="overwrite")
    assert batch()["events_20250501"][:3] == ("loaded", 1, 1)
    assert ids() == [("2", 1)]


def test_rows_that_vanish_leave_an_empty_partition(put, batch, ids, rejected):
    put("events_20250501", [("1", "a", "x")])
    put("events_20250502", [("2", "a", GOOD)])
    batch()
    put("events_20250501", [], mode="overwrite")
    assert batch() == {"events_20250501": ("loaded", 0, 0, 0, 0)}
    assert ids() == [("2", 2)] and rejected() == []
    assert batch() == {}


def test_unreadable_names_are_set_aside_once(put, batch, rejected, spark, paths):
    put("events_2025", [("9", "a", GOOD), ("8", "a", GOOD)])
    assert batch() == {"events_2025": ("skipped", 2, 0, 2, 2)}
    assert rejected() == [("8", "events_2025", "folder name"), ("9", "events_2025", "folder name")]
    assert batch() == {}
    put("events_2025", [("7", "a", GOOD)])
    assert batch()["events_2025"] == ("skipped", 3, 0, 3, 3)


def test_failing_folder_is_tried_again(put, batch, ids):
    for day in range(1, 6):
        put(f"events_2025050{day}", [(str(day), "a", GOOD)])
    put("events_20250503", [("3", "a", 1.5)], "event_id string, event_type string, event_ts double", "overwrite")
    assert [name for name, line in batch().items() if line[0] == "failed"] == ["events_20250503"]
    assert [i for i, _ in ids()] == ["1", "2", "4", "5"]
    put("events_20250503", [("3", "a", GOOD)], mode="overwrite")
    assert batch() == {"events_20250503": ("loaded", 1, 1, 0, 0)}
    assert [i for i, _ in ids()] == ["1", "2", "3", "4", "5"]


def test_stream_after_batch_loads_nothing_twice(put, batch, stream, ids, spark, paths, rows):
    put("events_20250501", [("1", "a", GOOD)])
    put("events_20250502", [("2", "a", GOOD)])
    batch()
    put("events_20250502", [("late", "a", GOOD)])
    put("events_20250503", [("3", "a", GOOD)])
    stream()
    assert ids() == [("1", 1), ("2", 2), ("3", 3), ("late", 2)]
    lines = rows(spark.read.schema(folders.FOLDER_LEDGER).parquet(f"{paths.folder_ledger()}/events"), "unit", "load")
    assert [(u[-2:], n) for u, n in lines] == [("01", 1), ("02", 1), ("02", 2), ("03", 2)]
    put("events_20250501", [("later", "a", GOOD)])
    stream()
    assert ids()[-1] == ("later", 1) and batch() == {}


@pytest.mark.parametrize("where", ["before", "behind"])
def test_stream_repeats_after_a_crash(put, stream, ids, monkeypatch, where):
    put("events_20250501", [("1", "a", GOOD)])
    original = folders._load

    def crash(*args):
        if where == "behind":
            original(*args)
        raise RuntimeError("lost")

    monkeypatch.setattr(folders, "_load", crash)
    with pytest.raises(Exception):
        stream()
    monkeypatch.undo()
    put("events_20250501", [("2", "a", GOOD)])
    stream()
    stream()
    assert ids() == [("1", 1), ("2", 1)]


def test_category_isolates_types(spark, put, paths, rows, monkeypatch):
    put("events_20250501", [("1", "a", GOOD)])
    put("schedule_20250501", [("s1", "yoga")], "session_id string, class_name string", kind="schedule")
    put("users_20250501", [("u1", "x")], "user_id string, city string", kind="users")
    schemas = {"events": SCHEMA, "users": "no such type"}
    found = folders.ingest_category(spark, paths, clean.NON_PII, schemas)
    assert rows(found, "unit", "outcome", "rows_out") == [
        ("non-pii/events/events_20250501", "loaded", 1),
        ("non-pii/schedule/schedule_20250501", "loaded", 1),
        ("non-pii/users/users_20250501", "failed", None),
    ]
    assert [r["unit"] for r in folders.ingest_category(spark, paths, clean.NON_PII, schemas).collect()] == ["non-pii/users/users_20250501"]
    assert folders.ingest_category(spark, paths, clean.NON_PII, types=["users"]).first()["outcome"] == "loaded"
    assert folders.ingest_category(spark, paths, clean.NON_PII).count() == 0


def test_many_folders_in_jobs_of_bounded_size(put, batch, ids, monkeypatch):
    monkeypatch.setattr(folders, "FOLDERS_A_JOB", 2)
    for day in range(1, 6):
        put(f"events_2025050{day}", [(str(day), "a", GOOD)] * day)
    assert {name: line[1:3] for name, line in batch().items()} == {f"events_2025050{d}": (d, 1) for d in range(1, 6)}
    assert len(ids()) == 5


def test_odd_folder_names(put, batch, ids):
    put("events x=1_20250501", [("1", "a", GOOD)])
    put("events%41+[b]_20250502", [("2", "a", GOOD)])
    assert sorted(batch()) == ["events x=1_20250501", "events%41+[b]_20250502"] and len(ids()) == 2
    assert batch() == {}
    put("events x=1_20250501", [], mode="overwrite")
    assert batch()["events x=1_20250501"][:3] == ("loaded", 0, 0)
    assert ids() == [("2", 2)]
