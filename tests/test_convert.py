import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from turnstile.streaming import convert

STAMP = dt.datetime(2025, 5, 1)


@pytest.fixture
def raw(tmp_path):
    folder = tmp_path / "raw" / "non-pii" / "events"
    folder.mkdir(parents=True)
    return folder


@pytest.fixture
def run(spark, tmp_path):
    def convert_all(**options):
        report = convert.convert_files(spark, f"{tmp_path}/raw", f"{tmp_path}/out", stamp=F.lit(STAMP), **options).collect()
        assert len({r["file"] for r in report}) == len(report)
        return {r["file"].rsplit("/", 1)[-1]: (r["outcome"], r["rows_read"], r["rows_written"], r["rejected"]) for r in report}

    return convert_all


@pytest.fixture
def out(spark, tmp_path, rows):
    def read(*columns, kind="events", aside=False):
        path = f"{tmp_path}/out/{'_rejected/' if aside else ''}non-pii/{kind}"
        return rows(spark.read.option("mergeSchema", True).parquet(path), *columns)

    return read


def test_every_file_has_an_outcome(raw, run, out):
    names = ["k.1.csv", "k.2.csv", "my file.csv", "x=1.csv", "100%+[a].CSV", "plain.txt"]
    for i, name in enumerate(names):
        (raw / name).write_text(f"n,name\n{i},x\n{i},y\n")
    (raw / "j.json").write_text('{"n": 6, "name": "x"}\n')
    (raw / "nothing.csv").write_text("")  # no file to Spark's listings
    (raw / "header.csv").write_text("n,name\n")
    (raw / "c.xlsx").write_text("?")
    (raw / "none").write_text("?")
    converted = {name: ("converted", 2, 2, 0) for name in names}
    others = {"c.xlsx": ("unsupported", None, None, None), "none": ("unsupported", None, None, None)}
    assert run() == converted | others | {"j.json": ("converted", 1, 1, 0), "header.csv": ("converted", 0, 0, 0)}
    assert out("unit", "n") == sorted([(name, str(i)) for i, name in enumerate(names) for _ in range(2)] + [("j.json", "6")])
    again = run()
    assert {again[n][0] for n in [*names, "j.json", "header.csv"]} == {"exists"} and len(again) == 10


def test_headers_differ(raw, run, out):
    (raw / "a.csv").write_text("n,name\n1,x\n")
    (raw / "b.csv").write_text("name,n\ny,2\n")
    (raw / "c.csv").write_text("n,name,more\n3,z,m\n")
    assert {what[0] for what in run().values()} == {"converted"}
    assert out("n", "name", "more") == [("1", "x", None), ("2", "y", None), ("3", "z", "m")]


def test_types_do_not_follow_content(raw, run, out):
    (raw / "a.csv").write_text("code\n007\n")
    run()
    (raw / "b.csv").write_text("code\nabc\n")
    run()
    assert out("code") == [("007",), ("abc",)]


SCHEMA = "n int, at timestamp_ntz, name string"


def test_declared_types_and_rejected_rows(raw, run, out):
    (raw / "a.csv").write_text("name,n,at\nx,1,2025-05-01T10:00:00\ny,two,2025-05-01T10:00:00\nz,3,never\nw,4\n")
    (raw / "b.csv").write_text("n,extra\n5,e\n")
    (raw / "c.json").write_text('{"n": 6, "name": "j"}\n{"n": "x"}\n{broken\n')
    assert run(schemas={"non-pii/events": SCHEMA}) == {
        "a.csv": ("converted", 4, 1, 3), "b.csv": ("converted", 1, 1, 0), "c.json": ("converted", 3, 1, 2),
    }
    at = dt.datetime(2025, 5, 1, 10)
    assert out("n", "at", "name", "extra") == [(1, at, "x", None), (5, None, None, "e"), (6, None, "j", None)]
    assert out("unit", "reason", "raw", aside=True) == [
        ("a.csv", "at", '{"name":"z","n":"3","at":"never"}'), ("a.csv", "n", '{"name":"y","n":"two","at":"2025-05-01T10:00:00"}'),
        ("a.csv", "unreadable", "w,4"), ("c.json", "unreadable", '{"n": "x"}'), ("c.json", "unreadable", "{broken"),
    ]


def test_a_replaced_file_replaces_its_rows(raw, run, out):
    (raw / "a.csv").write_text("n\n1\nx\n")
    (raw / "b.csv").write_text("n\n7\n")
    schemas = {"non-pii/events": "n int"}
    assert run(schemas=schemas)["a.csv"] == ("converted", 2, 1, 1)
    (raw / "a.csv").write_text("n\n2\n3\n")
    assert run(schemas=schemas) == {"a.csv": ("converted", 2, 2, 0), "b.csv": ("exists", None, None, None)}
    assert out("n") == [(2,), (3,), (7,)] and out("raw", aside=True) == []
    (raw / "a.csv").write_text("n\n")
    assert run(schemas=schemas)["a.csv"] == ("converted", 0, 0, 0)
    assert out("n") == [(7,)]


def test_failing_file_is_isolated_and_tried_again(raw, run, out):
    for i in range(5):
        (raw / f"{i}.parquet").write_text("no parquet") if i == 3 else (raw / f"{i}.csv").write_text(f"n\n{i}\n")
    (raw / "4.parquet").write_text("neither")
    found = run()
    assert {n for n, what in found.items() if what[0] == "failed"} == {"3.parquet", "4.parquet"}
    assert run()["3.parquet"][0] == "failed"
    assert len(out("n")) == 4


def test_repeat_after_a_crash_before_the_ledger(raw, run, out, monkeypatch):
    (raw / "a.csv").write_text("n\n1\n")
    original = convert._convert

    def crash(*args):
        original(*args)
        raise RuntimeError("lost")

    monkeypatch.setattr(convert, "_convert", crash)
    assert run()["a.csv"][0] == "failed"
    monkeypatch.undo()
    assert run()["a.csv"] == ("converted", 1, 1, 0)
    assert out("n") == [("1",)]


def test_nested_json_and_orc(spark, tmp_path, raw, run, out):
    people = [{"session_id": "s1", "attendees": [{"email": "A@x", "user_id": "1"}]}, {"session_id": "s2", "attendees": None}]
    (raw / "a.jsonl").write_text("\n".join(map(json.dumps, people)))
    spark.createDataFrame([("s3",)], "session_id string").coalesce(1).write.orc(f"{tmp_path}/orc")
    (part,) = [f for f in os.listdir(tmp_path / "orc") if f.endswith(".orc")]
    os.rename(tmp_path / "orc" / part, raw / "b.orc")
    assert {what[:2] for what in run().values()} == {("converted", 2), ("converted", 1)}
    assert out("session_id", F.size("attendees").alias("n")) == [("s1", 1), ("s2", None), ("s3", None)]
