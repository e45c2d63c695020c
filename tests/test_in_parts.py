"""Groupings over pairs hold as much in a task however large their input is."""

import pytest

from checks import queries as Q
from checks.adapters import read_test_table
from tests.conftest import plan_text
from turnstile.plans import classes
from turnstile.sources import manifest

SF = "/root/testdata/sf0.001"


def test_bytes_of_files_with_odd_names(spark, tmp_path):
    place = f"{tmp_path}/a b[1]%20+{{x}}"
    spark.range(10).coalesce(1).write.parquet(place)
    files = [p for p in (tmp_path / "a b[1]%20+{x}").iterdir() if p.name.startswith("part-")]
    assert manifest.input_bytes(spark.read.parquet(manifest.literal(place))) == sum(p.stat().st_size for p in files)
    assert manifest.input_bytes(spark.range(3)) == 0


@pytest.mark.parametrize("name", ["q19_location_trend", "q21_popular_classes"])
def test_parts_follow_the_input_and_leave_results_alone(spark, monkeypatch, name):
    small = [tuple(r) for r in Q.queries()[name](spark, SF).collect()]
    size = manifest.input_bytes(read_test_table(spark, SF, "lineitem"))
    monkeypatch.setattr(manifest, "SMALL_BYTES", 1)
    monkeypatch.setattr(manifest, "PART_BYTES", size // 7)
    dealt = Q.queries()[name](spark, SF)
    assert [tuple(r) for r in dealt.collect()] == small and small
    assert plan_text(dealt).count("REPARTITION_BY_NUM") >= 2


@pytest.mark.parametrize("name", ["q19_location_trend", "p06_pivot", "q21_popular_classes", "p02_top_classes"])
def test_large_session_dimensions_are_not_held_whole(spark, monkeypatch, name):
    monkeypatch.setattr(classes, "SENT_BYTES", 1 << 40)
    sent = Q.queries()[name](spark, SF)
    small = [tuple(r) for r in sent.collect()]
    monkeypatch.setattr(classes, "SENT_BYTES", 1)
    parted = Q.queries()[name](spark, SF)
    assert [tuple(r) for r in parted.collect()] == small and small
    assert "BroadcastHashJoin [session_id" in plan_text(sent)
    assert "BroadcastHashJoin [session_id" not in plan_text(parted) and "ShuffledHashJoin [session_id" in plan_text(parted)


def test_files_of_a_converted_folder_are_bounded(spark, monkeypatch, tmp_path):
    from turnstile.streaming import convert

    monkeypatch.setattr(convert, "ROWS_A_FILE", 10)
    spark.range(35).withColumnRenamed("id", "n").coalesce(1).write.option("header", True).csv(f"{tmp_path}/raw/d")
    convert.convert_files(spark, f"{tmp_path}/raw", f"{tmp_path}/out").collect()
    files = list((tmp_path / "out" / "d").rglob("part-*.parquet"))
    assert len(files) >= 4 and spark.read.parquet(f"{tmp_path}/out/d").count() == 35
