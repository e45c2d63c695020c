"""Registered queries on files and folders that arrive in parts, and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.adapters import domain_tables, read_test_table
from turnstile.operators import clean
from turnstile.session import scratch_path
from turnstile.streaming import convert, folders, ingest

Runner = Callable[[SparkSession, str], DataFrame]

DIRTY_EVENTS = """event_id string, user_id string, event_type string, event_ts string, location_id string,
    duration int, phone_number string"""
INGESTED = ("event_id", "event_type", "event_ts", "year", "month", "day")


def place_file(df: DataFrame, fmt: str, path: str, name: str) -> None:
    """``df`` as one file called ``name``: Spark chooses names itself, so its file is renamed."""
    spark, at = df.sparkSession, f"{path}/_parts-{fmt}"
    df.coalesce(1).write.mode("overwrite").options(header=True, ignoreNullFields=False).format(fmt).save(at)
    jvm = spark._jvm.org.apache.hadoop.fs
    files = jvm.Path(at).getFileSystem(spark._jsc.hadoopConfiguration())
    part = next(f.getPath() for f in files.listStatus(jvm.Path(at)) if f.getPath().getName().startswith("part-"))
    files.rename(part, jvm.Path(jvm.Path(path), name))
    files.delete(jvm.Path(at), True)


def number() -> Column:
    return F.col("event_id").cast("bigint")


def add_events(rows: DataFrame, paths: folders.FolderPaths, where: Column) -> None:
    """Those rows of the dirty events, more files in the folders of five days."""
    folder = F.concat(F.lit("events_2024010"), (1 + number() % 5).cast("string"))
    rows.where(where).withColumn("unit", folder).write.mode("append").partitionBy("unit").parquet(f"{paths.source}/non-pii/events")


def grown_folders(spark: SparkSession, sf_dir: str) -> folders.FolderPaths:
    """Half of every folder by a batch run, some more by a stream, the rest by a stream and a batch run again."""
    root = scratch_path(spark, "folders")
    paths = folders.FolderPaths(f"{root}/in", f"{root}/out", "non-pii")
    rows = domain_tables(spark, sf_dir)["dirty_events"]
    batch = lambda: folders.ingest_folders(spark, paths, "events", clean.NON_PII, DIRTY_EVENTS)
    stream = lambda: folders.start_folder_ingest(spark, paths, "events", clean.NON_PII, DIRTY_EVENTS).awaitTermination()
    part = number() % 4
    for where, run in ((part < 2, batch), (part == 2, stream), ((part == 3) & (number() % 5 < 3), stream), ((part == 3) & (number() % 5 >= 3), batch)):
        add_events(rows, paths, where)
        run()
    return paths


def late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.read_cleaned(spark, grown_folders(spark, sf_dir).cleaned("events")).select(*INGESTED)


def set_aside(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(grown_folders(spark, sf_dir).rejected("events")).select("event_id", "reason")


def report_of_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report of a second run, after every folder has grown but one."""
    root = scratch_path(spark, "report")
    paths = folders.FolderPaths(f"{root}/in", f"{root}/out", "non-pii")
    rows = domain_tables(spark, sf_dir)["dirty_events"]
    for where in ((number() % 2 == 0) | (number() % 5 == 0), (number() % 2 == 1) & (number() % 5 != 0)):
        add_events(rows, paths, where)
        report = folders.ingest_folders(spark, paths, "events", clean.NON_PII, DIRTY_EVENTS)
    return report.drop("message")


def category_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three types in one call: one is as declared, one has folders that are not, one declares what cannot be."""
    root = scratch_path(spark, "category")
    paths = folders.FolderPaths(f"{root}/in", f"{root}/out", "non-pii")
    tables = domain_tables(spark, sf_dir)
    add_events(tables["dirty_events"], paths, F.lit(True))
    schedule = tables["dirty_schedule"]
    schedule.write.parquet(f"{paths.source}/non-pii/schedule/schedule_20240101")
    schedule.select(F.col("session_id").cast("double").alias("session_id")).write.parquet(f"{paths.source}/non-pii/schedule/schedule_20240102")
    schedule.write.parquet(f"{paths.source}/non-pii/schedule/schedule")
    tables["dirty_users"].write.parquet(f"{paths.source}/non-pii/users/users_20240101")
    schemas = {"events": DIRTY_EVENTS, "schedule": schedule.schema, "users": "no type"}
    return folders.ingest_category(spark, paths, clean.NON_PII, schemas).select("unit", "outcome", "rows_in", "rows_out", "rejected")


NAMES = ("k.1.csv", "k.2.csv", "my file.csv", "x=1.csv", "j.json")


def named_files(spark: SparkSession, sf_dir: str, root: str) -> DataFrame:
    """Customers in files whose names share a stem or hold odd characters, and one file of a header only: both runs' report."""
    customers = read_test_table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    for i, name in enumerate(NAMES):
        place_file(customers.where(F.col("c_custkey") % 5 == i), name.rsplit(".", 1)[1], f"{root}/raw/people", name)
    place_file(customers.limit(0), "csv", f"{root}/raw/people", "none.csv")
    runs = [convert.convert_files(spark, f"{root}/raw", f"{root}/out").withColumn("run", F.lit(r)) for r in (1, 2)]
    return runs[0].unionByName(runs[1])


def full_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_path(spark, "names")
    named_files(spark, sf_dir, root).count()
    return spark.read.parquet(f"{root}/out/people").select("unit", F.col("c_custkey").cast("bigint").alias("c_custkey"), "c_name")


def outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = named_files(spark, sf_dir, scratch_path(spark, "outcomes"))
    return report.select("run", "file", "outcome", "rows_read", "rows_written", "rejected")


def csv_to_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw CSV through conversion with declared types to cleaned rows; the second delivery holds what the first did not:
    text under a numeric column and another order of columns."""
    root = scratch_path(spark, "csv")
    raw, converted = f"{root}/raw/events", f"{root}/typed"
    rows = domain_tables(spark, sf_dir)["dirty_events"].select("event_id", "event_type", "event_ts", "duration")
    paths = folders.FolderPaths(converted, f"{root}/out", "non-pii")
    schema = "event_id string, event_type string, event_ts string, duration int"
    bad = F.when(number() % 7 == 0, "n/a").otherwise(F.col("duration").cast("string"))
    deliveries = [
        (rows.where(number() % 2 == 0), "events_20240101.part.1.csv"),
        (rows.where(number() % 2 == 1).select("duration", "event_ts", "event_id", "event_type").withColumn("duration", bad), "events_20240102.csv"),
    ]
    for delivery, name in deliveries:
        place_file(delivery, "csv", raw, name)
        convert.convert_files(spark, f"{root}/raw", f"{converted}/non-pii", {"events": schema}).count()
        typed = f"{schema}, processed_time timestamp_ntz"
        folders.ingest_folders(spark, paths, "events", clean.NON_PII, typed).count()
    return ingest.read_cleaned(spark, paths.cleaned("events")).select("event_id", "event_type", "event_ts", "duration", "day")


QUERIES: dict[str, Runner] = {
    "t5_late_folder": late_rows,
    "t5_set_aside": set_aside,
    "c21_from_ingest": report_of_ingest,
    "i08_category": category_report,
    "i01_full_names": full_names,
    "i01_outcomes": outcomes,
    "i01_csv_to_clean": csv_to_clean,
}

UNIT_OF_EVENT = "'non-pii/events/events_2024010' || CAST(1 + CAST(event_id AS BIGINT) % 5 AS VARCHAR)"
FAULTY = "event_ts IS NOT NULL AND good_ts IS NULL"

SQL = {
    "t5_late_folder": """SELECT DISTINCT event_id, lower(trim(event_type)) AS event_type, good_ts AS event_ts,
          2024 AS year, 1 AS month, CAST(1 + CAST(event_id AS BIGINT) % 5 AS INTEGER) AS day
        FROM t_dirty_event""",
    "t5_set_aside": f"SELECT event_id, 'event_ts' AS reason FROM t_dirty_event WHERE {FAULTY}",
    "c21_from_ingest": f"""SELECT {UNIT_OF_EVENT} AS unit, 'loaded' AS outcome, count(*) AS rows_in,
          count(DISTINCT event_id) AS rows_out, count(*) - count(DISTINCT event_id) AS removed, count(*) FILTER ({FAULTY}) AS rejected
        FROM t_dirty_event WHERE CAST(event_id AS BIGINT) % 5 <> 0 GROUP BY 1""",
    "i08_category": f"""SELECT {UNIT_OF_EVENT} AS unit, 'loaded' AS outcome, count(*) AS rows_in,
          count(DISTINCT event_id) AS rows_out, count(*) FILTER ({FAULTY}) AS rejected FROM t_dirty_event GROUP BY 1
        UNION ALL SELECT 'non-pii/schedule/schedule_20240101', 'loaded', count(*), (SELECT count(*) FROM (SELECT DISTINCT * FROM t_dirty_schedule)), 0
          FROM t_dirty_schedule
        UNION ALL SELECT 'non-pii/schedule/schedule_20240102', 'failed', NULL, NULL, NULL
        UNION ALL SELECT 'non-pii/schedule/schedule', 'skipped', count(*), 0, count(*) FROM t_dirty_schedule
        UNION ALL SELECT 'non-pii/users/users_20240101', 'failed', NULL, NULL, NULL""",
    "i01_full_names": f"""SELECT {list(NAMES)}[c_custkey % 5 + 1] AS unit, c_custkey, c_name FROM customer""",
    "i01_outcomes": f"""SELECT 1 AS run, 'people/' || {list(NAMES)}[c_custkey % 5 + 1] AS file, 'converted' AS outcome,
          count(*) AS rows_read, count(*) AS rows_written, 0::BIGINT AS rejected FROM customer GROUP BY ALL
        UNION ALL SELECT 1, 'people/none.csv', 'converted', 0, 0, 0
        UNION ALL SELECT 2, 'people/' || unnest({[*NAMES, "none.csv"]}), 'exists', NULL, NULL, NULL""",
    "i01_csv_to_clean": """SELECT DISTINCT event_id, lower(trim(event_type)) AS event_type, good_ts AS event_ts,
          CAST(greatest(coalesce(duration, 0), 0) AS INTEGER) AS duration,
          CAST(1 + CAST(event_id AS BIGINT) % 2 AS INTEGER) AS day
        FROM t_dirty_event WHERE CAST(event_id AS BIGINT) % 2 = 0 OR CAST(event_id AS BIGINT) % 7 <> 0""",
}
