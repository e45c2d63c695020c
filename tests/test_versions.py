import datetime as dt
import re

import pytest

from tests.conftest import plan_text
from turnstile.plans import historical
from turnstile.sources import versions
from turnstile.streaming import live


def numbers(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "n int")


def test_a_version_counts_from_its_pointer_on(spark, tmp_path, rows, monkeypatch):
    root = f"{tmp_path}/result"
    assert versions.read_current(spark, root) is None
    versions.publish(numbers(spark, 1), root)

    def crash(*_):
        raise RuntimeError("lost")

    monkeypatch.setattr(versions, "point", crash)
    with pytest.raises(RuntimeError):
        versions.publish(numbers(spark, 2), root)
    monkeypatch.undo()
    assert rows(versions.read_current(spark, root)) == [(1,)]
    reader = versions.read_current(spark, root)
    versions.publish(numbers(spark, 3), root)
    assert rows(reader) == [(1,)] and rows(versions.read_current(spark, root)) == [(3,)]


def test_kept_results(spark, tmp_path, rows):
    keep = lambda n, **more: rows(versions.keep_result(numbers(spark, n), str(tmp_path), "a", **more))
    assert keep(1) == keep(2) == [(1,)]
    assert keep(3, params={"year": 2024}) == [(3,)]
    assert keep(4, max_age=dt.timedelta(0)) == [(4,)] and keep(5, max_age=None) == [(4,)]
    assert keep(6, refresh=True) == keep(7) == [(6,)]


def test_old_versions_are_removed(spark, tmp_path, rows):
    root = f"{tmp_path}/result"
    for n in range(3):
        versions.publish(numbers(spark, n), root)
    versions.remove_old(spark, root)
    folders = lambda: sorted(p.name for p in (tmp_path / "result").glob("data-*"))
    assert len(folders()) == 3
    versions.remove_old(spark, root, dt.timedelta(0))
    assert folders() == [versions.current(spark, root)["folder"]]
    assert rows(versions.read_current(spark, root)) == [(2,)]
    assert spark.read.schema(versions.POINTER).parquet(versions.pointer_path(root)).count() == 1
    versions.publish(numbers(spark, 9), root)
    assert versions.current(spark, root)["number"] == 4


LOG = "user_id string, event_type string, version bigint"


def test_compaction_keeps_the_state(spark, tmp_path, rows, monkeypatch):
    path, keys = f"{tmp_path}/log", ["user_id"]

    def change(version, *data):
        frame = spark.createDataFrame([(*d, version) for d in data], LOG)
        frame.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("version").parquet(path)

    state = lambda: rows(live.read_state(spark, path, keys), "user_id", "event_type")
    change(0, ("a", "view"), ("b", "view"))
    live.compact_changelog(spark, path, keys)
    change(1, ("a", "signup"))
    assert state() == [("a", "signup"), ("b", "view")]

    def crash(*_):
        raise RuntimeError("lost")

    monkeypatch.setattr(versions, "point", crash)
    with pytest.raises(RuntimeError):
        live.compact_changelog(spark, path, keys)
    monkeypatch.undo()
    assert state() == [("a", "signup"), ("b", "view")]
    for _ in range(2):
        live.compact_changelog(spark, path, keys)
    assert versions.current(spark, live.base_path(path))["number"] == 2
    change(1, ("a", "signup"))  # a batch that is repeated
    change(2, ("c", "cancel"))
    assert state() == rows(live.read_changelog(spark, path, keys), "user_id", "event_type") == [("a", "signup"), ("b", "view"), ("c", "cancel")]
    (pruned,) = re.findall(r"PartitionFilters: \[(isnotnull[^\]]*)\]", plan_text(live.read_state(spark, path, keys)))
    assert re.search(r"version#\d+L? > 1", pruned)


def test_state_without_compaction(spark, tmp_path, rows):
    spark.createDataFrame([("a", "view", 0), ("a", "signup", 1)], LOG).write.partitionBy("version").parquet(f"{tmp_path}/log")
    assert rows(live.read_state(spark, f"{tmp_path}/log", ["user_id"])) == [("a", "signup")]


def test_historical_outcomes(spark, tmp_path, rows):
    users = "user_id string, first_name string, last_name string, email string, phone_number string, preferred_location_id string, created_at timestamp_ntz"
    data = [("u1", "A", "B", "A@x", "1", "9", dt.datetime(2025, 1, 1))]
    spark.createDataFrame(data, users).write.parquet(f"{tmp_path}/users")
    spark.createDataFrame([], users).write.parquet(f"{tmp_path}/none")
    run = lambda path, name="user_snapshot": historical.run_historical(spark, {name: f"{tmp_path}/{path}"}, f"{tmp_path}/out")
    assert rows(run("users"), "outcome", "written", "found", "ok") == [("written", 1, 1, True)]
    assert rows(run("none"), "outcome", "found", "ok") == [("empty", None, False)]
    missing, unknown = run("missing").first(), run("users", "people").first()
    assert (missing["outcome"], missing["ok"]) == ("failed", False) and "missing" in missing["message"]
    assert unknown["message"] == "no cleaner for people"
    assert historical.all_written(run("users")) and not historical.all_written(run("none"))
