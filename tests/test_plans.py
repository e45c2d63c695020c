"""The physical plans that the design relies on."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from checks import adapters as A
from checks.queries import queries
from tests.conftest import plan_text
from turnstile.operators.clean import clean_non_pii
from turnstile.operators.state import latest_state, one_per_key
from turnstile.plans import classes, events, users, warehouse

SF = "/root/testdata/sf0.001"
EVENT = (
    "event_id string, user_id string, session_id string, event_type string, event_ts timestamp_ntz, "
    "class_datetime timestamp_ntz, processed_time timestamp_ntz, year int, month int, extra string"
)


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """Facts as the warehouse stores them."""
    root = str(tmp_path_factory.mktemp("stored"))
    at = dt.datetime(2025, 4, 3, 4)
    data = [(str(i), f"u{i % 3}", f"s{i % 2}", "signup", at, at, at, 2025, 1 + i % 12, "x") for i in range(24)]
    spark.createDataFrame(data, EVENT).write.partitionBy("year", "month").parquet(f"{root}/fact_event")
    attended = spark.createDataFrame([("a", "u1", "s1", at, "x")], "attendance_id string, user_id string, session_id string, class_datetime timestamp_ntz, extra string")
    attended.write.parquet(f"{root}/fact_class_attendance")
    return {name: spark.read.parquet(f"{root}/{name}") for name in ("fact_event", "fact_class_attendance")}


def scans(text):
    return [line for line in text.splitlines() if "FileScan" in line]


def test_best_row_is_chosen_before_the_shuffle(stored):
    for df in (latest_state(stored["fact_event"], ["event_ts"]), one_per_key(stored["fact_event"], ["user_id"])):
        text = plan_text(df)
        partial = text.index("Partial")
        assert text.index("WindowGroupLimit") < text.index("Exchange hashpartitioning") < partial


def test_one_scan_and_one_shuffle_instead_of_an_anti_join(stored):
    text = plan_text(classes.untouched_signups(stored["fact_event"].where(classes.in_months(2025, (4, 5)))))
    assert len(scans(text)) == 1 and text.count("Exchange") == 1 and "Join" not in text
    assert "partial_max_by" in text
    assert "month" in text.split("PartitionFilters: [")[1].split("]")[0]


def test_scans_read_what_they_need(stored):
    text = plan_text(users.last_activity(stored, ["event_ts"]))
    attended, event = (next(s for s in scans(text) if name in s) for name in ("fact_class_attendance", "fact_event"))
    assert "ReadSchema: struct<user_id:string,class_datetime:timestamp_ntz>" in attended
    assert "extra" not in event.split("ReadSchema")[1]
    assert "In(event_type, [" in event.replace("...", "[")


def test_time_ranges_reach_the_scan(stored):
    text = plan_text(classes.class_times(stored))
    attended = next(s for s in scans(text) if "fact_class_attendance" in s)
    assert "GreaterThanOrEqual(class_datetime,2025-01-01" in attended
    recent = plan_text(events.daily_trends({"events": stored["fact_event"]}, dt.date(2025, 5, 1)))
    assert "GreaterThanOrEqual(event_ts,2025-04-01" in recent


def test_cleaning_is_one_shuffle(stored):
    text = plan_text(clean_non_pii(stored["fact_event"], "events", "events_20250501"))
    assert text.count("Exchange") == 1 and "BatchEvalPython" not in text


def test_expanding_and_fact_building_need_no_shuffle(spark):
    inputs = A.warehouse_inputs(spark, SF)
    nested = inputs["nested_attendance"]
    stored_nested = spark.createDataFrame([], nested.schema)
    text = plan_text(warehouse.fact_class_attendance(warehouse.expanded_attendance(stored_nested)))
    assert "Exchange" not in text


@pytest.mark.parametrize("name", sorted(n for n in queries() if n[0] in "qpwrmc"))
def test_no_cross_join_and_no_python_in_any_query(spark, name):
    text = plan_text(queries()[name](spark, SF))
    for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas"):
        assert word not in text


def test_hot_session_is_split_in_the_join(spark):
    """A session that holds a third of all rows is read by several tasks, and nothing is lost."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    n = 60_000
    session = F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 500)
    attended = spark.range(0, n, 1, 8).select(
        F.concat(F.lit("u"), F.col("id")).alias("user_id"), F.concat(F.lit("s"), session).alias("session_id")
    )
    ids = spark.range(500).select(F.concat(F.lit("s"), F.col("id")).alias("session_id"), F.lit("Yoga").alias("class_name"), F.lit(2025).alias("year"))
    tables = {
        "fact_class_attendance": attended,
        "fact_event": spark.createDataFrame([], EVENT),
        "dim_class_session": ids,
    }
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        df = classes.popular_classes(tables)
        assert df.collect()[0]["attendance_count"] == n
        text = df._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin(skew=true)" in text
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_hot_pair_is_combined_before_the_shuffle(spark):
    """Half of the events belong to one pair; each map task sends one row of it."""
    hot = F.when(F.col("id") % 2 == 0, F.lit(0)).otherwise(F.col("id"))
    df = spark.range(0, 40_000, 1, 4).select(
        F.lpad(F.col("id").cast("string"), 6, "0").alias("event_id"),
        hot.cast("string").alias("user_id"),
        F.lit("s").alias("session_id"),
        F.lit("signup").alias("event_type"),
        F.timestamp_add("SECOND", F.col("id"), F.lit("2025-01-01 00:00:00").cast("timestamp_ntz")).alias("event_ts"),
    )
    state = latest_state(df, ["event_ts"])
    found = state.where("user_id = '0'").collect()
    assert state.count() == 20_001 and [r["event_id"] for r in found] == ["039998"]


def test_hot_folder_is_written_by_several_tasks(spark, tmp_path):
    from turnstile.sources import sinks

    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(size)
    folder = F.when(F.col("id") % 10 == 0, F.lit("cold")).otherwise(F.lit("hot"))
    df = spark.range(0, 200_000, 1, 8).select("id", folder.alias("unit"))
    try:
        spark.conf.set(size, "100KB")
        sinks.overwrite(df, str(tmp_path / "out"), partition_by=["unit"])
    finally:
        spark.conf.set(size, before)
    files = {unit: len(list((tmp_path / "out" / f"unit={unit}").glob("part-*"))) for unit in ("hot", "cold")}
    assert files["hot"] > 3 and files["cold"] <= 2
    assert spark.read.parquet(str(tmp_path / "out")).count() == 200_000
