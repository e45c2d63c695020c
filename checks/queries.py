"""Every registered query: a callable of (spark, sf_dir) per key."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import adapters as A
from checks import loading, truth, zoned
from checks.adapters import TEST_SCHEMAS, domain_tables, read_test_table, warehouse_inputs
from turnstile.functions import clock, text
from turnstile.operators import clean, rollups
from turnstile.operators.state import CANCEL, CHECKIN, PAIR, SIGNUP, latest_state, one_per_key
from turnstile.plans import catalog, classes, events, historical, members, users, warehouse
from turnstile.session import scratch_path
from turnstile.sources import manifest, readers, sinks
from turnstile.streaming import ingest, live

Runner = Callable[[SparkSession, str], DataFrame]

# Names of the 25 locations of the test tables, lower-cased, for the SQL only.
LOCATIONS = [f"nation_{i}" for i in range(25)]


def over_domain(query: Callable[..., DataFrame], **params) -> Runner:
    return lambda spark, sf_dir: query(domain_tables(spark, sf_dir), **params)


def over_table(name: str, change: Callable[[DataFrame], DataFrame]) -> Runner:
    return lambda spark, sf_dir: change(domain_tables(spark, sf_dir)[name])


# ---- analytic queries ----

PERIOD = {"year": A.YEAR, "months": A.MONTHS, "cutover": A.CUTOVER}
class_days = over_domain(classes.class_days, **PERIOD)
class_times = over_domain(classes.class_times, **PERIOD)
location_trend = over_domain(classes.location_trend, year=A.YEAR)
leaderboard = over_domain(classes.leaderboard, month=A.BOARD_MONTH)
popular_classes = over_domain(classes.popular_classes, year=A.YEAR)
churned_users = over_domain(users.churned_users, as_of=A.USERS_AS_OF)
age_distribution = over_domain(users.age_distribution, as_of=A.USERS_AS_OF)

ANALYTIC: dict[str, Runner] = {
    "q01_total_events": over_domain(events.total_events),
    "q02_event_types": over_domain(events.event_types),
    "q03_recent_events": over_domain(events.recent_events),
    "q04_daily_trends": over_domain(events.daily_trends, as_of=A.EVENTS_AS_OF),
    "q05_hourly": over_domain(events.hourly_distribution, as_of=A.EVENTS_AS_OF),
    "q06_weekly_trends": over_domain(events.weekly_trends, as_of=A.EVENTS_AS_OF),
    "q07_class_days": class_days,
    "q08_class_times": class_times,
    "q09_active_users": over_domain(users.active_users, as_of=A.EVENTS_AS_OF),
    "q10_type_prefs": over_domain(users.type_preferences, as_of=A.EVENTS_AS_OF),
    "q11_engagement": over_domain(users.engagement, as_of=A.EVENTS_AS_OF),
    "q12_churn_summary": over_domain(users.churn_summary, as_of=A.USERS_AS_OF),
    "q13_class_attendance": over_domain(members.class_attendance, as_of=A.USERS_AS_OF),
    "q14_renewal_rate": over_domain(members.renewal_rate, as_of=A.ORDERS_AS_OF),
    "q15_inactivity_risk": over_domain(users.inactivity_risk, as_of=A.EVENTS_AS_OF),
    "q16_facility_usage": over_domain(members.facility_use, as_of=A.ORDERS_AS_OF),
    "q17_facility_peak": over_domain(members.facility_peak_hours, as_of=A.ORDERS_AS_OF),
    "q18_facility_trend": over_domain(members.facility_trend, as_of=A.ORDERS_AS_OF),
    "q19_location_trend": location_trend,
    "q20_leaderboard": leaderboard,
    "q21_popular_classes": popular_classes,
    "q22_churned_users": churned_users,
    "q23_age": age_distribution,
    "q24_gender": over_domain(users.gender_distribution),
    "q25_catalog": over_domain(
        lambda tables: catalog.run_query(tables, "User Behavior Analysis", "90-Day User Churn Analysis", as_of=A.USERS_AS_OF)
    ),
    "q26_ad_hoc_sql": lambda spark, sf_dir: catalog.run_sql(
        spark,
        "SELECT event_type, CAST(ts AS DATE) AS day, count(*) AS n FROM raw_input_events GROUP BY 1, 2",
        {"raw_input_events": read_test_table(spark, sf_dir, "events")},
    ),
}


# ---- roll-ups on query results ----


def on(base: Runner, change: Callable[[DataFrame], DataFrame]) -> Runner:
    return lambda spark, sf_dir: change(base(spark, sf_dir))


def numbers_of_text(df: DataFrame) -> DataFrame:
    rows = rollups.as_numbers(df.withColumn("duration", F.col("duration").cast("string")), ["duration", "date_of_birth"])
    return rows.groupBy("first_name").agg(
        F.count(F.lit(1)).alias("n"), F.sum("duration").alias("d"), F.count("date_of_birth").alias("readable")
    )


def pivot_of(tables: readers.Tables) -> DataFrame:
    return rollups.month_by_location(classes.location_trend(tables, year=A.YEAR), rollups.location_names(tables["dim_location"]))


ROLLUPS: dict[str, Runner] = {
    "p01_as_numbers": over_table("dirty_users", numbers_of_text),
    "p02_top_classes": on(popular_classes, lambda df: rollups.top(df, "attendance_count", "class_name", 5)),
    "p03_periods": on(class_times, rollups.day_periods),
    "p04_periods_zero": on(class_times, lambda df: rollups.day_periods(df.where("class_hour < 12"), keep_empty=True)),
    "p05_weekend": on(class_days, rollups.weekday_split),
    "p06_pivot": over_domain(pivot_of),
    "p07_location_totals": on(location_trend, lambda df: rollups.totals_by(df, "location_name")),
    "p08_city_totals": on(location_trend, lambda df: rollups.totals_by(df, "city")),
    "p09_of_year": on(location_trend, lambda df: rollups.of_year(df, A.YEAR)),
    "p10_age_order": on(age_distribution, rollups.in_order),
    "p11_share": on(class_times, lambda df: rollups.share_of_total(df, "total_sessions")),
    "p12_share_guard": on(
        age_distribution,
        lambda df: rollups.share_of_total(df.withColumn("total", F.when(F.col("age_group") != "45+", F.col("total"))), "total"),
    ),
    "p13_rank": on(leaderboard, rollups.ranked),
    "p14_churned_total": on(churned_users, rollups.row_total),
    "p15_histogram": on(churned_users, lambda df: rollups.histogram(df, "days_inactive")),
}


# ---- latest state, set operations, scalar functions ----


def signups_in_period(tables: readers.Tables) -> DataFrame:
    return latest_state(tables["fact_event"], ["event_ts"], where=classes.in_months(A.YEAR, A.MONTHS))


def anti_join(tables: readers.Tables) -> DataFrame:
    touched = tables["fact_event"].where(classes.in_months(A.YEAR, A.MONTHS) & F.col("event_type").isin(CHECKIN, CANCEL))
    return signups_in_period(tables).join(touched, list(PAIR), "left_anti").select(*PAIR, "event_id")


def text_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.col("c_name")
    return read_test_table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.lower(name).alias("low"),
        F.trim(F.concat(F.lit("  "), name, F.lit("  "))).alias("trimmed"),
        text.blank_for_t(F.lower("c_mktsegment")).alias("replaced"),
        text.digits_only(name).alias("digits"),
        F.substring(name, 1, 10).alias("head"),
        text.pair_key(name, F.col("c_mktsegment")).alias("joined"),
        F.lpad(F.col("c_nationkey").cast("string"), 3, "0").alias("padded"),
        F.upper(F.md5(name)).alias("hash"),
    )


def date_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    ts, as_of = F.col("ts"), clock.day(A.USERS_AS_OF)
    return read_test_table(spark, sf_dir, "events").select(
        "event_id",
        clock.start_of_day(ts).alias("day_start"),
        clock.start_of_week(ts).alias("week_start"),
        F.hour(ts).alias("hour_of_day"),
        F.year(ts).alias("y"),
        F.dayofweek(ts).alias("weekday"),
        clock.whole_days(ts, clock.moment(as_of)).alias("whole_days"),
        F.datediff(as_of, ts.cast("date")).alias("calendar_days"),
        clock.date_of_parts(F.year(ts), F.month(ts), F.day(ts)).alias("of_parts"),
        clock.from_epoch_millis(F.lit(1746093600123) + F.col("event_id") * 1000).alias("from_millis"),
    )


RELATIONAL: dict[str, Runner] = {
    "w1_latest_state": over_domain(lambda t: signups_in_period(t).select(*PAIR, "event_id", "event_ts")),
    "w1_by_processed_time": over_domain(
        lambda t: latest_state(
            t["fact_event"], ["processed_time"], F.col("event_type").isin(SIGNUP, CHECKIN, CANCEL), accept=None
        ).select(*PAIR, "event_id", "event_type")
    ),
    "w1_by_two_times": over_domain(
        lambda t: latest_state(
            t["fact_event"],
            ["event_ts", "processed_time"],
            classes.in_range("event_ts", A.BOARD_MONTH, A.CUTOVER) & F.col("event_type").isin(SIGNUP, CANCEL),
        ).select(*PAIR, "event_id")
    ),
    "r11_anti": over_domain(anti_join),
    "r25_union_distinct": over_domain(
        lambda t: t["fact_class_attendance"].select(*PAIR).union(t["fact_event"].select(*PAIR)).distinct()
    ),
    "f_text": text_functions,
    "f_casts": lambda spark, sf_dir: warehouse.build_warehouse(warehouse_inputs(spark, sf_dir))["combined_user_view"].select(
        "user_id",
        F.col("date_of_birth").try_cast("date").alias("born"),
        F.col("created_at").try_cast(clock.NTZ).alias("created"),
        F.coalesce(F.col("first_name").try_cast("bigint"), F.lit(-1).cast("bigint")).alias("number"),
    ),
    "f_dates": date_functions,
    "f_years": over_table(
        "dim_user_v3",
        lambda df: df.where(F.col("date_of_birth").isNotNull()).select(
            "user_id", clock.whole_years(F.col("date_of_birth"), clock.day(A.USERS_AS_OF)).alias("years")
        ),
    ),
    "f_math": lambda spark, sf_dir: read_test_table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.round("o_totalprice", 2).alias("rounded"),
        F.floor("o_totalprice").alias("floored"),
        F.call_function("div", F.col("o_custkey"), F.lit(7)).alias("quotient"),
    ),
}


# ---- warehouse ----


def built(name: str) -> Runner:
    return lambda spark, sf_dir: warehouse.build_warehouse(warehouse_inputs(spark, sf_dir))[name]


WAREHOUSE: dict[str, Runner] = {
    "m01_users": built("combined_user_view"),
    "m02_schedule": built("combined_schedule_view"),
    "m03_instructor": built("dim_instructor"),
    "m04_expand": built("expanded_class_attendance"),
    "m05_dim_user": built("dim_user_v3"),
    "m06_dim_class_session": built("dim_class_session"),
    "m07_dim_location": built("dim_location"),
    "m08_fact_attendance": built("fact_class_attendance"),
    "m09_fact_event": built("fact_event"),
}


# ---- cleaning ----


def dirty(name: str, **columns: Callable[[], Column]) -> Runner:
    """A projection of a dirty table: names to expressions, which need a running session."""
    return over_table(name, lambda df: df.select(*[make().alias(n) for n, make in columns.items()]))


def folder_days() -> list[Column]:
    """Day parts of a folder name under the strict rule with its fallback."""
    return [c.alias(n) for n, c in clean.day_parts(clean.NON_PII.day_text(F.col("folder"))).items()]


CLEANING: dict[str, Runner] = {
    "c01_drop_copies": over_table("dirty_events", clean.drop_copies),
    "c02_one_per_key": over_table(
        "dirty_schedule",
        lambda df: one_per_key(df, ["session_id"], ["processed_time"]).select("session_id", "class_name", "processed_time"),
    ),
    "c03_drop_empty": over_table("dirty_events", lambda df: clean.drop_empty(df.select("location_id", "phone_number"))),
    "c05_c07_lower_fill": over_table(
        "dirty_users",
        lambda df: clean.map_columns(df.select("user_id", "first_name", "gender"), text.lower_or_unknown, ["first_name", "gender"]),
    ),
    "c06_c08_trim_fill": over_table(
        "dirty_events",
        lambda df: clean.map_columns(df.select("event_id", "user_id", "location_id"), text.tidy_or_unknown, ["user_id", "location_id"]),
    ),
    "c09_defaults": over_table("dirty_schedule", lambda df: clean.fill_defaults(df, clean.SCHEDULE_DEFAULTS)),
    "c10_fill_text": over_table("dirty_events", clean.fill_text),
    "c11_trim_names": over_table(
        "dirty_schedule",
        lambda df: clean.trim_columns(df.select("session_id", "class_name", "instructor_name"), ["class_name", "instructor_name"]),
    ),
    "c12_c13_contact": dirty(
        "dirty_users",
        user_id=lambda: F.col("user_id"),
        email=lambda: text.tidy_email(F.col("email")),
        phone_number=lambda: text.digits_only(F.col("phone_number")),
    ),
    "c14_c15_duration": dirty(
        "dirty_events",
        event_id=lambda: F.col("event_id"),
        keep_null=lambda: clean.not_negative(F.col("duration")),
        no_null=lambda: clean.not_negative_or_null(F.col("duration")),
    ),
    "c16_c17_event_time": dirty(
        "dirty_events",
        event_id=lambda: F.col("event_id"),
        event_ts=lambda: clock.parse_iso(F.col("event_ts")),
        event_date=lambda: clock.parse_iso(F.col("event_ts")).cast("date"),
    ),
    "c18_default_times": dirty(
        "dirty_users",
        user_id=lambda: F.col("user_id"),
        registration_date=lambda: clock.parse_moment(F.lower("registration_date")),
        last_login=lambda: clock.parse_moment(F.lower("last_login")),
    ),
    "c20_day_parts": lambda spark, sf_dir: folder_names(spark, sf_dir).select("folder", *folder_days()),
    "c21_report": over_table("dirty_events", lambda df: clean.cleaning_report(df, clean.drop_copies(df))),
    "c22_unreadable": over_table("dirty_events", lambda df: clean.unreadable(df, "event_ts").select("event_id", "event_ts")),
    "c23_clean_pii": over_table(
        "dirty_users", lambda df: clean.clean_pii(df, "users", "users_20240115", clock.moment(A.STAMP))
    ),
    "c24_clean_nonpii": over_table(
        "dirty_events", lambda df: clean.clean_non_pii(df, "events", "events_20240115", clock.moment(A.STAMP))
    ),
    "c25_schedule": over_table("dirty_schedule", clean.clean_historical_schedule),
    "c26_users": over_table("dirty_snapshot", clean.clean_historical_users),
    "c27_attendance": over_table(
        "nested_attendance",
        lambda df: clean.clean_historical_attendance(df.drop("processed_timestamp"), clock.moment(A.STAMP)).withColumn(
            "attendees", F.size("attendees")
        ),
    ),
}


# ---- files in and out ----

CUSTOMER = ("c_custkey", "c_name", "c_acctbal")


def round_trip(fmt: str, read: Callable[[SparkSession, str], DataFrame], columns=CUSTOMER, **options) -> Runner:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        path = scratch_path(spark, f"round-trip-{fmt}")
        read_test_table(spark, sf_dir, "customer").write.format(fmt).options(**options).save(path)
        return read(spark, path).select(F.col("c_custkey").cast("bigint").alias("c_custkey"), *columns[1:])

    return run


def every_extension(spark: SparkSession, sf_dir: str) -> DataFrame:
    root, nation, found = scratch_path(spark, "extensions"), read_test_table(spark, sf_dir, "nation"), None
    for extension, fmt in readers.FORMAT_BY_EXTENSION.items():
        path = f"{root}/nation.{extension.upper()}"
        nation.write.format(fmt).options(**({"header": True} if fmt == "csv" else {})).save(path)
        rows = readers.read_any(spark, path).select(
            F.lit(extension).alias("format"), "n_name", F.col("n_regionkey").cast("int").alias("n_regionkey")
        )
        found = rows if found is None else found.unionAll(rows)
    return found


def manifest_of_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "manifest")
    read_test_table(spark, sf_dir, "events").write.partitionBy("event_type").parquet(path)
    files = manifest.file_manifest(spark, path, "*.parquet")
    return files.agg(
        F.count_distinct(manifest.folder_of(F.col("path"))).alias("folders"), (F.min("length") > 0).alias("all_sized")
    )


def daily_folders(spark: SparkSession, sf_dir: str) -> str:
    """The events as dated folders; returns the source root."""
    root = scratch_path(spark, "folders")
    unit = F.date_format("ts", "'events_'yyyyMMdd").alias("unit")
    read_test_table(spark, sf_dir, "events").select("event_id", unit).write.partitionBy("unit").parquet(f"{root}/non-pii/events")
    return root


def found_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.units(manifest.file_manifest(spark, daily_folders(spark, sf_dir)), manifest.STRICT_NAMING)


def registered_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = {name: (lambda n=name: read_test_table(spark, sf_dir, n)) for name in ("nation", "region")}
    for name, build in tables.items():
        sinks.create_view(build(), f"listed_{name}")
    listed = readers.catalog_tables(spark, ["listed_nation", "listed_region"])
    joined = listed["listed_nation"].join(listed["listed_region"], F.col("n_regionkey") == F.col("r_regionkey"))
    return joined.groupBy("r_name").agg(F.count(F.lit(1)).alias("n"))


def user_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{scratch_path(spark, 'user-file')}/mine.csv"
    sinks.export_csv(read_test_table(spark, sf_dir, "customer"), path)
    readers.register_file(spark, "my_customers", path)
    return spark.sql("SELECT c_mktsegment, count(*) AS n FROM my_customers GROUP BY c_mktsegment")


def stored_popular_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_path(spark, "results")
    sinks.materialize(popular_classes(spark, sf_dir), root, "Popular Classes")
    return sinks.materialize(popular_classes(spark, sf_dir), root, "Popular Classes")


def orders_again(spark: SparkSession, sf_dir: str, write: Callable[[DataFrame, str], None], read_format: str) -> DataFrame:
    path, orders = scratch_path(spark, "overwrite"), read_test_table(spark, sf_dir, "orders")
    for _ in range(2):
        write(orders, path)
    rows = spark.read.format(read_format).load(path)
    return rows.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"), F.sum("o_custkey").alias("keys"))


def appended_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "append-month")
    at = F.col("o_orderdate")
    rows = read_test_table(spark, sf_dir, "orders").withColumns({"year": F.year(at), "month": F.month(at), "day": F.day(at)})
    for _ in range(2):
        sinks.append_by_month(rows, path)
    return spark.read.parquet(path).groupBy("year", "month").agg(F.count("day").alias("n"))


def appended_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "append-day")
    at = F.col("ts")
    sinks.append_by_day(
        read_test_table(spark, sf_dir, "events").withColumns({"year": F.year(at), "month": F.month(at), "day": F.day(at)}), path
    )
    return spark.read.parquet(path).groupBy("year", "month", "day").agg(F.count(F.lit(1)).alias("n"))


def stored_event_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "tables")
    fact = warehouse.build_warehouse(warehouse_inputs(spark, sf_dir))["fact_event"]
    name = "fact_event_" + path[-12:]
    stored = sinks.create_table_as(fact, name, f"{path}/fact_event", ["year", "month"])
    return stored.groupBy("year", "month").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("user_id").alias("users"))


def exported_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, trend = scratch_path(spark, "export"), location_trend(spark, sf_dir)
    sinks.export_csv(trend, path)
    return readers.read_csv(spark, path, schema=trend.schema, header=True)


def checked_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sinks.write_checked(read_test_table(spark, sf_dir, "lineitem"), scratch_path(spark, "checked")).drop("path")


def verified(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The historical job over two inputs and a missing one."""
    root, tables = scratch_path(spark, "verify"), domain_tables(spark, sf_dir)
    tables["dirty_schedule"].write.parquet(f"{root}/in/schedule")
    tables["dirty_snapshot"].write.parquet(f"{root}/in/users")
    inputs = {"schedule": f"{root}/in/schedule", "user_snapshot": f"{root}/in/users", "class_attendance": f"{root}/in/none"}
    checks = historical.clean_historical(spark, inputs, f"{root}/out")
    return checks.select(F.substring_index("path", "/", -1).alias("name"), "n", "ok")


def viewed_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    view = sinks.create_view(domain_tables(spark, sf_dir)["fact_event"], "fact_event_view")
    return view.groupBy("month").agg(F.count(F.lit(1)).alias("n"))


FILES: dict[str, Runner] = {
    "s01_by_extension": every_extension,
    "s02_csv": round_trip("csv", readers.read_csv, ("c_custkey", "c_name", "c_nationkey", "c_acctbal"), header=True),
    "s03_json": round_trip("json", readers.read_json),
    "s04_parquet": round_trip("parquet", readers.read_parquet),
    "s05_orc": round_trip("orc", readers.read_orc),
    "s06_glob": round_trip("parquet", lambda spark, path: readers.read_parquet(spark, path, glob="*.parquet")),
    "s07_manifest": manifest_of_types,
    "s08_units": lambda spark, sf_dir: found_units(spark, sf_dir).drop("unit", "location"),
    "s09_catalog_table": registered_tables,
    "s10_stored_result": stored_popular_classes,
    "s11_user_file": user_file,
    "k01_overwrite_parquet": lambda spark, sf_dir: orders_again(spark, sf_dir, sinks.overwrite, "parquet"),
    "k02_overwrite": lambda spark, sf_dir: orders_again(spark, sf_dir, lambda df, p: sinks.overwrite(df, p, "orc"), "orc"),
    "k03_append_month": appended_months,
    "k04_append_day": appended_days,
    "k05_table_as": stored_event_fact,
    "k06_materialize": stored_popular_classes,
    "k07_export_csv": exported_trend,
    "k08_write_checked": checked_lines,
    "k09_verify_paths": verified,
    "k10_views": viewed_months,
}


# ---- ingest and streams ----

DIRTY_EVENTS = """event_id string, user_id string, event_type string, event_ts string, location_id string,
    duration int, phone_number string"""
INGESTED = ("event_id", "event_type", "event_ts", "year", "month", "day")


def event_folder(event_id: Column) -> Column:
    return F.concat(F.lit("events_2024010"), (1 + event_id.cast("bigint") % 5).cast("string"))


def write_event_folders(spark: SparkSession, sf_dir: str, root: str, days: Column) -> None:
    """Dirty events as dated folders, those whose number modulo five satisfies ``days``."""
    rows = domain_tables(spark, sf_dir)["dirty_events"]
    kept = rows.where(days).withColumn("unit", event_folder(F.col("event_id")))
    kept.write.mode("append").partitionBy("unit").parquet(f"{root}/non-pii/events")


def day_number() -> Column:
    return F.col("event_id").cast("bigint") % 5


def converted(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_path(spark, "convert")
    customers = read_test_table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    customers.where("c_custkey % 2 = 0").write.option("header", True).csv(f"{root}/raw/csv")
    customers.where("c_custkey % 2 = 1").write.json(f"{root}/raw/json")
    for _ in range(2):
        ingest.convert_pending(spark, f"{root}/raw", f"{root}/parquet")
    rows = [
        spark.read.parquet(f"{root}/parquet/{d}").select(
            F.lit(d).alias("dir"), F.col("c_custkey").cast("bigint").alias("c_custkey"), "c_name"
        )
        for d in ("csv", "json")
    ]
    return rows[0].unionAll(rows[1])


def pending_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = found_units(spark, sf_dir)
    ledger = found.agg(F.min("unit").alias("unit"))
    return manifest.pending(found, ledger).select("unit")


def folder_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    day, kind = F.date_format("ts", "yyyyMMdd"), F.col("event_type")
    folder = (
        F.when(kind == "click", F.concat(F.lit("events_"), day))
        .when(kind == "view", F.concat(F.lit("events_"), F.substring(day, 1, 4)))
        .when(kind == "error", F.concat(F.lit("other_"), day))
        .when(kind == "signup", F.concat(F.lit("events_"), day, F.lit("_x")))
        .otherwise("events")
    )
    names = read_test_table(spark, sf_dir, "events").select(folder.alias("folder")).distinct()
    return names.select(
        "folder",
        manifest.STRICT_NAMING.day_text(F.col("folder")).alias("strict_day"),
        manifest.LENIENT_NAMING.day_text(F.col("folder")).alias("lenient_day"),
    )


def batch_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_path(spark, "ingest-batch")
    paths = ingest.IngestPaths(f"{root}/in", f"{root}/out", "non-pii")
    for days in (day_number() < 3, day_number() >= 3):
        write_event_folders(spark, sf_dir, paths.source, days)
        ingest.ingest_pending(spark, paths, "events", clean.NON_PII, DIRTY_EVENTS)
    return ingest.read_cleaned(spark, paths.cleaned("events")).select(*INGESTED)


def lenient_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data from one dated folder and one without a date."""
    root = scratch_path(spark, "ingest-pii")
    paths = ingest.IngestPaths(f"{root}/in", f"{root}/out", "pii")
    people = domain_tables(spark, sf_dir)["dirty_users"]
    folder = F.when(F.col("user_id").cast("bigint") % 2 == 0, "users_20240107").otherwise("users")
    people.withColumn("unit", folder).write.partitionBy("unit").parquet(f"{paths.source}/pii/users")
    ingest.ingest_pending(spark, paths, "users", clean.PII, people.schema)
    return ingest.read_cleaned(spark, paths.cleaned("users")).select("user_id", "email", "phone_number", "year", "month", "day")


def ledger_with_empty_folder(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_path(spark, "ingest-empty")
    paths = ingest.IngestPaths(f"{root}/in", f"{root}/out", "non-pii")
    write_event_folders(spark, sf_dir, paths.source, F.lit(True))
    none = domain_tables(spark, sf_dir)["dirty_events"].where("event_id is null")
    none.write.parquet(f"{paths.source}/non-pii/events/events_20240109")
    ingest.ingest_pending(spark, paths, "events", clean.NON_PII, DIRTY_EVENTS)
    return manifest.read_ledger(spark, paths.ledger("events")).select("unit")


def copies_in_two_folders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rows, with copies, in two folders of one micro-batch: one of each per folder stays."""
    root = scratch_path(spark, "ingest-copies")
    paths = ingest.IngestPaths(f"{root}/in", f"{root}/out", "non-pii")
    rows = domain_tables(spark, sf_dir)["dirty_events"]
    for folder in ("events_20240108", "events_20240109"):
        rows.write.parquet(f"{paths.source}/non-pii/events/{folder}")
    ingest.start_ingest(spark, paths, "events", DIRTY_EVENTS, clean.NON_PII).awaitTermination()
    return ingest.read_cleaned(spark, paths.cleaned("events")).select("event_id", "day")


def isolated_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One folder holds another type under ``event_ts``, one carries no date."""
    root = scratch_path(spark, "isolation")
    paths = ingest.IngestPaths(f"{root}/in", f"{root}/out", "non-pii")
    write_event_folders(spark, sf_dir, paths.source, F.lit(True))
    rows = domain_tables(spark, sf_dir)["dirty_events"]
    rows.withColumn("event_ts", F.lit(1.5)).write.parquet(f"{paths.source}/non-pii/events/events_20240106")
    rows.write.parquet(f"{paths.source}/non-pii/events/events")
    return ingest.ingest_pending(spark, paths, "events", clean.NON_PII, DIRTY_EVENTS).select("unit", "outcome")


def stream_ingest(spark: SparkSession, sf_dir: str) -> ingest.IngestPaths:
    """Three runs: three folders, then two more, then nothing new."""
    root = scratch_path(spark, "ingest-stream")
    paths = ingest.IngestPaths(f"{root}/in", f"{root}/out", "non-pii")
    for days in (day_number() < 3, day_number() >= 3, F.lit(False)):
        write_event_folders(spark, sf_dir, paths.source, days)
        ingest.start_ingest(spark, paths, "events", DIRTY_EVENTS, clean.NON_PII).awaitTermination()
    return paths


def streamed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.read_cleaned(spark, stream_ingest(spark, sf_dir).cleaned("events")).select(*INGESTED)


def quarantined_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(stream_ingest(spark, sf_dir).quarantine("events")).select("event_id", "reason")


def event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    stream = spark.readStream.schema(TEST_SCHEMAS["events"]).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    return A.event_columns(stream)


def live_result(make: Callable[[DataFrame], DataFrame], keys: list[str]) -> Runner:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        root = scratch_path(spark, "live")
        changes = make(event_stream(spark, sf_dir))
        live.start_changelog(changes, f"{root}/log", f"{root}/checkpoint").awaitTermination()
        return live.read_changelog(spark, f"{root}/log", keys)

    return run


STREAMS: dict[str, Runner] = {
    "i01_convert": converted,
    "i02_ledger_anti": pending_units,
    "i03_ingest_batch": batch_ingest,
    "i04_folder_names": folder_names,
    "i05_lenient_ingest": lenient_ingest,
    "i06_empty_unit": ledger_with_empty_folder,
    "i07_isolation": isolated_failures,
    "t1_ingest": streamed_rows,
    "t2_copies_per_folder": copies_in_two_folders,
    "t3_state": live_result(live.live_state, list(PAIR)),
    "t4_daily": live_result(live.live_daily, ["window_start"]),
    "t4_hourly": on(live_result(live.live_hourly, ["window_start"]), live.hour_of_day_totals),
    "t4_weekly": live_result(live.live_weekly, ["window_start"]),
    "t5_quarantine": quarantined_rows,
}


def queries() -> dict[str, Runner]:
    return {**ANALYTIC, **ROLLUPS, **RELATIONAL, **WAREHOUSE, **CLEANING, **FILES, **STREAMS, **loading.QUERIES, **zoned.QUERIES, **truth.QUERIES}
