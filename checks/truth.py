"""Checks that can fail: stored results whose source changes, second runs, whole tables, folders with other files."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import adapters as A
from checks.adapters import TEST_SCHEMAS, domain_tables, read_test_table
from turnstile.functions import clock
from turnstile.operators import clean, rollups
from turnstile.operators.state import PAIR
from turnstile.plans import classes, historical, users
from turnstile.session import scratch_path
from turnstile.sources import readers, versions
from turnstile.streaming import live

Runner = Callable[[SparkSession, str], DataFrame]


def counts(events: DataFrame) -> DataFrame:
    return events.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


def stored_counts(refresh: bool) -> Runner:
    """A result stored from half the events, then asked for again when there are more; a version without pointer lies by."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        root, events = scratch_path(spark, "results"), read_test_table(spark, sf_dir, "events")
        half = counts(events.where("event_id % 2 = 0"))
        versions.keep_result(half, root, "counts").count()
        place = versions.result_path(root, "counts", half.schema)
        counts(events.where("event_id % 3 = 0")).write.parquet(f"{place}/data-{'0' * 32}")
        return versions.keep_result(counts(events), root, "counts", refresh=refresh)

    return run


def compacted_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events in four deliveries, the change log compacted between them."""
    root, events = scratch_path(spark, "compacted"), read_test_table(spark, sf_dir, "events")
    for part in range(4):
        events.where(F.col("event_id") % 4 == part).write.mode("append").parquet(f"{root}/in")
        stream = A.event_columns(spark.readStream.schema(TEST_SCHEMAS["events"]).parquet(f"{root}/in"))
        live.start_changelog(live.live_state(stream), f"{root}/log", f"{root}/checkpoint").awaitTermination()
        if part in (1, 2):
            live.compact_changelog(spark, f"{root}/log", PAIR)
    return live.read_state(spark, f"{root}/log", PAIR)


def within_watermark(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events, all of them again, and copies of the older ones 400 days later: only the second delivery is dropped."""
    root = scratch_path(spark, "watermark")
    events = read_test_table(spark, sf_dir, "events").select("event_id", F.col("ts").alias("event_ts"))
    newest = events.agg(F.max("event_ts").alias("newest"))
    old = events.join(newest, F.col("event_ts") <= F.col("newest") - F.expr("INTERVAL 3 DAYS")).select(
        "event_id", (F.col("event_ts") + F.expr("INTERVAL 400 DAYS")).alias("event_ts")
    )
    for delivery in (events, events, old):
        delivery.write.mode("append").parquet(f"{root}/in")
        stream = spark.readStream.schema("event_id bigint, event_ts timestamp_ntz").parquet(f"{root}/in")
        live.start_append(live.without_copies(stream, "1 day"), f"{root}/out", f"{root}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{root}/out")


def second_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The historical job run again when one input is gone, one holds nothing and one has no cleaner."""
    root, tables = scratch_path(spark, "second"), domain_tables(spark, sf_dir)
    tables["dirty_schedule"].write.parquet(f"{root}/1/schedule")
    for run in (1, 2):
        tables["dirty_snapshot"].where(F.lit(run == 1)).write.parquet(f"{root}/{run}/users")
        inputs = {"schedule": f"{root}/{run}/schedule", "user_snapshot": f"{root}/{run}/users", "people": f"{root}/1/users"}
        report = historical.run_historical(spark, inputs, f"{root}/out").withColumn("run", F.lit(run))
        found = report if run == 1 else found.unionByName(report)  # noqa: F821
    return found.select("run", "name", "outcome", "found", "ok")


def with_other_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A folder that holds ORC files as well."""
    path = scratch_path(spark, "glob")
    customers = read_test_table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal")
    customers.write.parquet(path)
    customers.withColumn("c_name", F.lit("other")).write.mode("append").orc(path)
    return readers.read_parquet(spark, path, glob="*.parquet")


def attendee_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = domain_tables(spark, sf_dir)["nested_attendance"].drop("processed_timestamp")
    cleaned = clean.clean_historical_attendance(rows, clock.moment(A.STAMP))
    return cleaned.select("session_id", "instructor_name", F.explode("attendees").alias("a")).select("session_id", "instructor_name", "a.*")


def hot_churn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The churn list over a user dimension in which every tenth user has 20 rows, those users joined in parts."""
    tables = domain_tables(spark, sf_dir)
    copies = F.when(F.col("user_id").cast("bigint") % 10 == 0, 20).otherwise(1)
    number = F.explode(F.sequence(F.lit(1), copies)).alias("number")
    dim = tables["dim_user_v3"].select("*", number).withColumn("email", F.concat(F.col("number").cast("string"), F.lit("-"), F.col("email"))).drop("number")
    return users.churned_users({**tables, "dim_user_v3": dim}, as_of=A.USERS_AS_OF, hot_rows=10)


QUERIES: dict[str, Runner] = {
    "q22_hot_users": hot_churn,
    "k06_refreshed": stored_counts(True),
    "s10_kept": stored_counts(False),
    "t3_compacted": compacted_state,
    "t2_within_watermark": within_watermark,
    "k09_second_run": second_run,
    "p04_all_hours": lambda spark, sf_dir: rollups.day_periods(
        classes.class_times(domain_tables(spark, sf_dir), A.YEAR, A.MONTHS, A.CUTOVER), keep_empty=True
    ),
    "p09_some_years": lambda spark, sf_dir: rollups.of_year(
        read_test_table(spark, sf_dir, "orders").select("o_orderkey", F.year("o_orderdate").alias("year")), 1995
    ),
    "s06_other_files": with_other_files,
    "c27_contents": attendee_rows,
}

# Stated on top of the SQL of the plain churn list.
HOT_CHURN = """SELECT user_id, n || '-' || email AS email, last_activity_time, days_inactive
    FROM (SELECT *, unnest(range(1, CASE WHEN CAST(user_id AS BIGINT) % 10 = 0 AND email IS NOT NULL THEN 21 ELSE 2 END)) AS n FROM ({plain}))"""

SQL = {
    "k06_refreshed": "SELECT event_type, count(*) AS n FROM events GROUP BY event_type",
    "s10_kept": "SELECT event_type, count(*) AS n FROM events WHERE event_id % 2 = 0 GROUP BY event_type",
    "t3_compacted": """SELECT user_id, session_id, event_type, event_ts FROM t_raw_event
        QUALIFY row_number() OVER (PARTITION BY user_id, session_id
                                   ORDER BY event_ts DESC NULLS LAST, event_id DESC NULLS LAST) = 1""",
    "t2_within_watermark": """SELECT event_id, ts AS event_ts FROM events
        UNION ALL SELECT event_id, ts + INTERVAL 400 DAYS FROM events WHERE ts <= (SELECT max(ts) FROM events) - INTERVAL 3 DAYS""",
    "k09_second_run": """SELECT 1 AS run, 'schedule' AS name, 'written' AS outcome, count(*) AS found, true AS ok FROM part
        UNION ALL SELECT 1, 'user_snapshot', 'written', count(*), true FROM customer
        UNION ALL SELECT r, 'people', 'failed', NULL, false FROM (VALUES (1), (2)) v(r)
        UNION ALL SELECT 2, 'schedule', 'failed', NULL, false UNION ALL SELECT 2, 'user_snapshot', 'empty', NULL, false""",
    "p04_all_hours": """SELECT period, CAST(coalesce(sum(total_sessions), 0) AS BIGINT) AS total_sessions
        FROM (VALUES ('Early Morning (5-8)', 5, 8), ('Morning (9-11)', 9, 11), ('Noon (12-13)', 12, 13),
                     ('Afternoon (14-16)', 14, 16), ('Evening (17-20)', 17, 20), ('Night (21-23)', 21, 23)) p(period, a, b)
        LEFT JOIN r_hours ON class_hour BETWEEN a AND b
        GROUP BY period""",
    "p09_some_years": "SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS year FROM orders WHERE year(o_orderdate) = 1995",
    "s06_other_files": "SELECT c_custkey, c_name, c_acctbal FROM customer",
    "c27_contents": """SELECT session_id, coalesce(instructor_name, 'UNKNOWN') AS instructor_name, a.email AS email, a.user_id AS user_id
        FROM (SELECT session_id, instructor_name, unnest(attendees) AS a FROM t_nested)""",
}
