import datetime as dt

import pytest

from turnstile.plans.classes import in_months
from turnstile.session import scratch_path, shared_dir
from turnstile.sources import manifest, readers, sinks


@pytest.fixture
def people(spark):
    return spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "n int, name string")


def test_reader_follows_the_extension(spark, tmp_path, rows):
    (tmp_path / "a.CSV").write_text("n,name\n1,x\n2,y\n")
    (tmp_path / "b.txt").write_text("n,name\n1,x\n")
    (tmp_path / "c.jsonl").write_text('{"n": 1, "name": "x"}\n')
    (tmp_path / "d.json").write_text('{"n": 2, "name": "y"}\n')
    assert rows(readers.read_any(spark, f"{tmp_path}/a.CSV")) == [(1, "x"), (2, "y")]
    assert rows(readers.read_any(spark, f"{tmp_path}/b.txt")) == [(1, "x")]
    assert rows(readers.read_any(spark, f"{tmp_path}/c.jsonl")) == [(1, "x")]
    assert rows(readers.read_any(spark, f"{tmp_path}/d.json")) == [(2, "y")]
    assert readers.read_any(spark, f"{tmp_path}/e.xlsx") is None
    assert readers.read_any(spark, f"{tmp_path}/no_extension") is None
    assert rows(readers.read_csv(spark, f"{tmp_path}/b.txt", header=False)) == [("1", "x"), ("n", "name")]
    readers.register_file(spark, "user_upload", f"{tmp_path}/a.CSV")
    assert spark.sql("SELECT max(n) FROM user_upload").first()[0] == 2
    with pytest.raises(ValueError):
        readers.register_file(spark, "nothing", f"{tmp_path}/e.xlsx")


def test_manifest_skips_empty_files(spark, tmp_path, rows):
    folder = tmp_path / "non-pii" / "events" / "events_20250501"
    folder.mkdir(parents=True)
    (folder / "a.parquet").write_bytes(b"x")
    (folder / "b.parquet").write_bytes(b"")
    (tmp_path / "non-pii" / "events" / "unit=events_2025").mkdir()
    (tmp_path / "non-pii" / "events" / "unit=events_2025" / "c.parquet").write_bytes(b"x")
    files = manifest.file_manifest(spark, str(tmp_path))
    assert files.count() == 2
    found = manifest.units(files, manifest.STRICT_NAMING)
    assert rows(found, "category", "data_type", "folder", "unit", "day_text") == [
        ("non-pii", "events", "events_2025", "non-pii/events/events_2025", None),
        ("non-pii", "events", "events_20250501", "non-pii/events/events_20250501", "20250501"),
    ]


@pytest.mark.parametrize(
    "name, strict, lenient",
    [
        ("events_20250501", "20250501", "20250501"),
        ("events_20250501_x", "20250501", "20250501"),
        ("events_202505011", None, "20250501"),
        ("events_2025", None, None),
        ("events", None, "20250501"),
        ("events_", None, "20250501"),
        ("x_y_20250501", None, None),
    ],
)
def test_folder_names(spark, name, strict, lenient):
    df = spark.createDataFrame([(name,)], "f string")
    days = df.select(manifest.STRICT_NAMING.day_text(df.f), manifest.LENIENT_NAMING.day_text(df.f)).first()
    assert tuple(days) == (strict, lenient)


def test_materialized_result(spark, tmp_path, people, rows):
    root = str(tmp_path)
    assert rows(sinks.materialize(people, root, "My Result")) == rows(people)
    assert len([p for p in tmp_path.iterdir() if p.is_dir()]) == 1
    other = people.where("n = 1")
    assert rows(sinks.materialize(other, root, "My Result")) == rows(people)
    assert rows(sinks.materialize(other, root, "My Result", max_age=dt.timedelta(hours=1))) == rows(people)
    assert rows(sinks.materialize(other, root, "My Result", max_age=dt.timedelta(0))) == rows(other)
    assert rows(sinks.materialize(people, root, "My Result", refresh=True)) == rows(people)
    assert rows(sinks.materialize(other, root, "My Result", params={"n": 1})) == rows(other)
    assert rows(sinks.materialize(other, root, "my_result")) == rows(other)
    assert sinks.materialize(people.select("n"), root, "My Result").columns == ["n"]


def test_checked_write(spark, tmp_path, people, rows):
    path = f"{tmp_path}/out"
    assert rows(sinks.write_checked(people.repartition(3), path)) == [(path, 3, 3, True)]
    assert rows(sinks.write_checked(people.limit(0), path)) == [(path, 0, 0, True)]


def test_verified_paths(spark, tmp_path, people, rows):
    good, broken, missing = (f"{tmp_path}/{n}" for n in ("good", "broken", "missing"))
    sinks.overwrite(people, good)
    (tmp_path / "broken").mkdir()
    (tmp_path / "broken" / "x.parquet").write_bytes(b"not parquet")
    assert rows(sinks.verify_paths(spark, [good, broken, missing])) == [(broken, None, False), (good, 3, True), (missing, None, False)]


def test_partitioned_appends(spark, tmp_path):
    df = spark.createDataFrame([(1, 2025, 5, 1), (2, 2025, 5, 2)], "n int, year int, month int, day int")
    sinks.append_by_month(df, f"{tmp_path}/m")
    sinks.append_by_month(df, f"{tmp_path}/m")
    sinks.append_by_day(df, f"{tmp_path}/d")
    assert spark.read.parquet(f"{tmp_path}/m").count() == 4
    assert (tmp_path / "m" / "year=2025" / "month=5").is_dir()
    assert (tmp_path / "d" / "year=2025" / "month=5" / "day=2").is_dir()


def test_tables_and_views(spark, tmp_path, people, rows):
    table = sinks.create_table_as(people, "people_table", f"{tmp_path}/people", ["n"])
    assert rows(table.select("n", "name")) == rows(people)
    assert rows(sinks.create_view(people, "people_view")) == rows(people)
    listed = readers.catalog_tables(spark, ["people_table"], "default")
    assert rows(listed["people_table"].select("n", "name")) == rows(people)
    sinks.export_csv(people, f"{tmp_path}/csv")
    assert rows(readers.read_csv(spark, f"{tmp_path}/csv")) == rows(people)
    assert spark.sql("SELECT count(*) FROM people_table WHERE n = 2").first()[0] == 1


def test_shared_dir_comes_from_the_session(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    assert scratch_path(spark, "x").startswith(shared_dir(spark))
    assert scratch_path(spark, "x") != scratch_path(spark, "x")


def test_month_filter_prunes_partitions(spark, tmp_path):
    from tests.conftest import plan_text

    df = spark.createDataFrame([(1, 2025, m) for m in range(1, 7)], "n int, year int, month int")
    sinks.overwrite(df, f"{tmp_path}/p", partition_by=["year", "month"])
    text = plan_text(spark.read.parquet(f"{tmp_path}/p").where(in_months(2025, (4, 5))))
    filters = next(line for line in text.splitlines() if "PartitionFilters" in line)
    assert "month" in filters.split("PartitionFilters")[1].split("PushedFilters")[0]
