"""What every row of a folder pays for: names out of its path, and its event time."""

from pyspark.sql import functions as F

from tests.conftest import plan_text
from turnstile.functions import clock
from turnstile.operators import clean
from turnstile.sources import manifest
from turnstile.streaming import folders

TIMES = [
    "2024-01-02T03:04:05", "2024-01-02t03:04:05", "2024-01-02 03:04:05", "2024-01-02T03:04:05.123", "2024-1-2T03:04:05", "unknown", "",
    "+12024-01-02T03:04:05", "-2024-01-02T03:04:05", "02024-01-02T03:04:05", "2024-13-02T03:04:05", "2024-01-02T24:00:00",
    "2024-01-02T03:04:05Z", " 2024-01-02T03:04:05", "2024-01-02T03:04:05 ", "2024-02-30T00:00:00", "٢٠٢٤-01-02T03:04:05", "2024-01-02T03:04", None,
]
PATHS = ["file:/a/in/pii/users/users_1/p.parquet", "/c/t/f/x", "c/t/f/x", "t/f/x", "f/x", "x", "", "s3://h/c/t/unit=k.1.csv/p", "/c/t/unit=/p", "/unit=a/p"]


def test_shape_keeps_every_time_that_the_pattern_reads(spark):
    text = spark.createDataFrame([(t,) for t in TIMES], "t string")
    whole = F.try_to_timestamp("t", F.lit(clock.ISO_PATTERN)).cast(clock.NTZ)
    rows = text.select("t", clock.parse_iso(F.col("t")).cast("string").alias("got"), whole.cast("string").alias("want")).collect()
    assert [r["got"] for r in rows] == [r["want"] for r in rows]
    assert rows[0]["got"] and rows[1]["got"] and not rows[2]["got"]


def test_names_of_paths_are_those_of_the_patterns(spark):
    path = F.col("p")
    rows = spark.createDataFrame([(p,) for p in PATHS], "p string").select(
        "p",
        F.array(manifest.folder_of(path), manifest.type_of(path), manifest.category_of(path), manifest.file_name(path)).alias("got"),
        F.array(
            F.regexp_extract(path, r"/(?:unit=)?([^/]+)/[^/]+$", 1),
            F.regexp_extract(path, r"/([^/]+)/[^/]+/[^/]+$", 1),
            F.regexp_extract(path, r"/([^/]+)/[^/]+/[^/]+/[^/]+$", 1),
            F.regexp_extract(path, r"([^/]+)$", 1),
        ).alias("want"),
    )
    assert [(r["p"], r["got"]) for r in rows.collect()] == [(r["p"], r["want"]) for r in rows.collect()]


def test_rows_of_a_folder_run_no_pattern_over_their_path(spark, tmp_path):
    place = tmp_path / "in" / "pii" / "events" / "events_20240101"
    spark.createDataFrame([("1", "bad")], "event_id string, event_ts string").write.parquet(str(place))
    rows = folders.with_folder(spark.read.parquet(str(place)))
    assert "regexp" not in plan_text(rows) and "RLIKE" not in plan_text(rows)
    assert "RLIKE" not in plan_text(rows.select(F.lit(1).alias("i"), folders.FOLDER)).upper()
    assert rows.select(folders.FOLDER, folders.UNIT).first() == ("events_20240101", "pii/events/events_20240101")
    assert rows.select(folders.time_fault(rows, clean.NON_PII, "events")).first()[0] == "event_ts"
