"""Domain tables derived from the test tables.

Only integer arithmetic and portable expressions are used, so that ``checks/oracle.py`` can state the
same tables independently in SQL.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from turnstile.functions import clock, text
from turnstile.sources.manifest import in_parts
from turnstile.sources.readers import Tables

YEAR = 2024
MONTHS = (1, 2)
CUTOVER = dt.date(2024, 2, 1)
BOARD_MONTH = dt.date(2024, 1, 1)
EVENTS_AS_OF = dt.date(2024, 1, 31)
USERS_AS_OF = dt.date(2024, 4, 5)
ORDERS_AS_OF = dt.date(2001, 8, 1)
STAMP = "2024-03-01 00:00:00"

# Declared, so that planning a query opens no file.
TEST_SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


def read_test_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TEST_SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def hours_after(start: str, hours: Column) -> Column:
    return F.timestamp_add("HOUR", hours.cast("int"), clock.moment(start))


def key(c: str) -> Column:
    return F.col(c).cast("string")


def pick(number: Column, *values) -> Column:
    """The value at ``number``; a ``None`` is a null."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), number.cast("int") + 1)


def iso(ts: str, separator: str = "T") -> Column:
    return F.date_format(ts, f"yyyy-MM-dd'{separator}'HH:mm:ss")


def event_columns(events: DataFrame) -> DataFrame:
    """Events under their domain names; works on a batch and on a stream."""
    kind = F.col("event_type")
    return events.select(
        key("event_id").alias("event_id"),
        key("user_id").alias("user_id"),
        F.regexp_extract("props", "([0-9]+)", 1).alias("session_id"),
        F.when(kind == "purchase", "checkin").when(kind == "error", "cancel").otherwise(kind).alias("event_type"),
        F.col("ts").alias("event_ts"),
        F.timestamp_add("HOUR", (F.col("event_id") % 5).cast("int"), F.col("ts")).alias("processed_time"),
        F.year("ts").alias("year"),
        F.month("ts").alias("month"),
        F.day("ts").alias("day"),
    )


def domain_tables(spark: SparkSession, sf_dir: str) -> Tables:
    def table(name: str) -> DataFrame:
        return read_test_table(spark, sf_dir, name)

    def dim_location() -> DataFrame:
        nation, region = table("nation"), table("region")
        joined = nation.join(region, nation.n_regionkey == region.r_regionkey)
        return joined.select(key("n_nationkey").alias("location_id"), F.col("n_name").alias("location_name"), F.col("r_name").alias("city"))

    def dim_class_session() -> DataFrame:
        p = F.col("p_partkey")
        rows = table("part").select(
            p.cast("string").alias("session_id"),
            F.col("p_brand").alias("class_code"),
            F.col("p_name").alias("class_name"),
            F.col("p_size").alias("instructor_id"),
            (p % 25).cast("string").alias("location_id"),
            hours_after("2024-01-01 00:00:00", p * 7 % 2160).alias("class_datetime"),
            (30 + 15 * (F.col("p_size") % 4)).alias("duration_mins"),
        )
        return rows.select("*", F.year("class_datetime").alias("year"), F.month("class_datetime").alias("month"))

    def dim_user_v3() -> DataFrame:
        k = F.col("c_custkey")
        birth = F.date_add(F.lit("1960-01-01").cast("date"), (k * 37 % 16000).cast("int"))
        return table("customer").select(
            k.cast("string").alias("user_id"),
            F.col("c_name").alias("first_name"),
            F.col("c_mktsegment").alias("last_name"),
            F.concat(F.lower("c_name"), F.lit("@example.com")).alias("email"),
            pick(k % 5, "male", "MALE", "female", "Female", "unknown").alias("gender"),
            F.when(k % 3 != 0, (16 + k % 50).cast("int")).alias("age"),
            F.when(k % 4 != 0, birth).alias("date_of_birth"),
        )

    def fact_class_attendance() -> DataFrame:
        lines, orders = in_parts(table("lineitem"), "l_orderkey"), table("orders").select("o_orderkey", "o_custkey")
        user, session = key("o_custkey"), key("l_partkey")
        return lines.join(orders, lines.l_orderkey == orders.o_orderkey).select(
            text.attendance_key(user, session).alias("attendance_id"),
            user.alias("user_id"),
            session.alias("session_id"),
            (F.col("l_partkey") % 25).cast("string").alias("location_id"),
            hours_after("2023-01-01 00:00:00", F.col("l_orderkey") * 7919 % 11000).alias("class_datetime"),
        )

    def raw_events() -> DataFrame:
        return event_columns(table("events"))

    def fact_event() -> DataFrame:
        """The fact carries place and time of its session, as stored facts do; no join is needed.

        Session numbers of events lie below 100, within the sessions of every test size.
        """
        session = F.col("session_id").cast("bigint")
        return tables["raw_events"].withColumns(
            {
                "location_id": (session % 25).cast("string"),
                "class_datetime": hours_after("2024-01-01 00:00:00", session * 7 % 2160),
            }
        )

    def events() -> DataFrame:
        return table("events").select(
            key("event_id").alias("event_id"), key("user_id").alias("user_id"), "event_type", F.col("ts").alias("event_ts")
        )

    def class_attendance() -> DataFrame:
        """Flat form."""
        sessions = tables["dim_class_session"].select("session_id", F.col("class_code").alias("class_id"), "class_name")
        attended = tables["fact_class_attendance"].select("session_id", "user_id", F.col("class_datetime").cast("date").alias("class_date"))
        return attended.join(sessions, "session_id").drop("session_id")

    def nested_attendance() -> DataFrame:
        supplier = key("l_suppkey")
        attendee = F.struct(
            F.concat(F.lit("u"), supplier, F.lit("@example.com")).alias("email"), supplier.alias("user_id")
        )
        order = F.col("l_orderkey")
        sessions = table("lineitem").groupBy(order).agg(F.collect_list(attendee).alias("attendees"))
        return sessions.select(
            order.cast("string").alias("session_id"),
            F.concat(F.lit("Class "), (order % 10).cast("string")).alias("class_name"),
            F.when(order % 4 != 0, F.concat(F.lit("Coach "), (order % 7).cast("string"))).alias("instructor_name"),
            (order % 25).cast("string").alias("location_id"),
            F.size("attendees").cast("bigint").alias("attendance_count"),
            ((1672531200 + order * 7919 % 11000 * 3600) * 1000).cast("string").alias("class_datetime"),
            clock.moment(STAMP).alias("processed_time"),
            clock.moment(STAMP).alias("processed_timestamp"),
            "attendees",
        )

    def membership_renewals() -> DataFrame:
        return table("orders").select(
            F.col("o_orderpriority").alias("membership_type"),
            F.when(F.col("o_orderstatus") == "F", "renewed").otherwise("lapsed").alias("renewal_status"),
            F.col("o_orderdate").alias("renewal_date"),
        )

    def facility_usage() -> DataFrame:
        lines, suppliers = table("lineitem"), table("supplier").select("s_suppkey", "s_name")
        return lines.join(suppliers, lines.l_suppkey == suppliers.s_suppkey).select(
            key("l_suppkey").alias("facility_id"),
            F.col("s_name").alias("facility_name"),
            F.col("l_shipdate").cast("date").alias("usage_date"),
            F.timestamp_add("HOUR", (F.col("l_orderkey") % 24).cast("int"), F.col("l_shipdate")).alias("usage_time"),
        )

    # ---- inputs of the cleaning jobs: copies, nulls, blanks, mixed case, unreadable text ----

    def with_copies(df: DataFrame, number: str, every: int) -> DataFrame:
        """Each ``every``-th row once more, as an exact copy."""
        return df.unionAll(df.where(F.col(number).cast("bigint") % every == 0))

    def dirty_users() -> DataFrame:
        k = F.col("c_custkey")
        spaced = F.concat(F.lit("  "), F.upper("c_name"), F.lit("@Example.COM "))
        phone = F.concat(F.lit("(415) "), (5550000 + k % 9999).cast("string"), F.lit(" ext"))
        created = F.timestamp_add("HOUR", (k * 11 % 9000).cast("int"), clock.moment("2023-01-01 08:30:00"))
        rows = table("customer").select(
            k.cast("string").alias("user_id"),
            F.when(k % 7 == 0, None).when(k % 7 == 1, "").otherwise(F.concat(F.lit(" "), F.col("c_name"))).alias("first_name"),
            F.col("c_mktsegment").alias("last_name"),
            F.when(k % 5 != 0, spaced).alias("email"),
            F.when(k % 6 != 0, phone).alias("phone_number"),
            F.when(k % 4 != 0, F.date_add(F.lit("1960-01-01").cast("date"), (k * 37 % 16000).cast("int")).cast("string")).alias("date_of_birth"),
            pick(k % 5, "male", "MALE", "female", "Female", None).alias("gender"),
            (k % 25).cast("string").alias("preferred_location_id"),
            F.date_format(created, "yyyy-MM-dd'T'HH:mm:ss").alias("created_at"),
            F.when(k % 2 == 0, F.date_format(created, "yyyy-MM-dd'T'HH:mm:ss"))
            .otherwise(F.date_format(created, "yyyy-MM-dd HH:mm:ss"))
            .alias("registration_date"),
            pick(k % 3, "2024-02-03 04:05:06", "not a time", None).alias("last_login"),
            pick(k % 4, -5, None, 0, 30).alias("duration"),
        )
        return with_copies(rows, "user_id", 10)

    def dirty_events() -> DataFrame:
        e = F.col("event_id")
        when_text = (
            F.when(e % 11 == 0, iso("ts", " "))
            .when(e % 13 == 0, "unknown")
            .when(e % 17 == 0, None)
            .when(e % 19 == 0, F.lower(iso("ts")))
            .when(e % 23 == 0, F.concat(iso("ts"), F.lit(".123")))
            .otherwise(iso("ts"))
        )
        rows = table("events").select(
            e.cast("string").alias("event_id"),
            F.when(e % 9 == 0, "  ").otherwise(key("user_id")).alias("user_id"),
            F.when(e % 6 == 0, F.concat(F.lit(" "), F.upper("event_type"), F.lit(" "))).otherwise(F.col("event_type")).alias("event_type"),
            when_text.alias("event_ts"),
            pick(e % 4, "", None, " Room A ", "room a").alias("location_id"),
            pick(e % 4, -5, None, 0, 30).alias("duration"),
            pick(e % 3, "(415) 555-0100", None, "n/a").alias("phone_number"),
        )
        return with_copies(rows, "event_id", 10)

    def dirty_schedule() -> DataFrame:
        """Every third session twice, with a later processing time and other values."""
        p = F.col("p_partkey")
        first = table("part").select(
            p.cast("string").alias("session_id"),
            F.when(p % 5 != 0, F.col("p_brand")).alias("class_code"),
            F.when(p % 7 != 0, F.concat(F.lit("  "), F.col("p_name"), F.lit(" "))).alias("class_name"),
            F.when(p % 4 != 0, F.col("p_size")).alias("instructor_id"),
            F.when(p % 6 != 0, F.concat(F.lit(" Coach "), F.col("p_size").cast("string"))).alias("instructor_name"),
            F.when(p % 8 != 0, (p % 25).cast("string")).alias("loc_id"),
            F.when(p % 9 != 0, F.col("p_type")).alias("city"),
            F.when(p % 10 != 0, F.concat(F.col("p_type"), F.lit(" "))).alias("location_name"),
            F.when(p % 3 != 0, 30 + 15 * (F.col("p_size") % 4)).alias("duration_mins"),
            hours_after("2024-01-01 00:00:00", p % 100).alias("processed_time"),
        )
        again = first.where(F.col("session_id").cast("bigint") % 3 == 0).withColumns(
            {
                "class_name": F.concat(F.col("class_name"), F.lit("(moved)")),
                "processed_time": F.timestamp_add("HOUR", F.lit(5), F.col("processed_time")),
            }
        )
        return first.unionAll(again)

    def dirty_snapshot() -> DataFrame:
        k = F.col("c_custkey")
        first = table("customer").select(
            k.cast("string").alias("user_id"),
            F.when(k % 7 != 0, F.col("c_name")).alias("first_name"),
            F.when(k % 5 != 0, F.col("c_mktsegment")).alias("last_name"),
            F.when(k % 6 != 0, F.concat(F.lit(" "), F.col("c_name"), F.lit("@Example.COM"))).alias("email"),
            F.when(k % 4 != 0, F.concat(F.lit("+1 415-"), (5550000 + k % 9999).cast("string"))).alias("phone_number"),
            F.when(k % 3 != 0, (k % 25).cast("string")).alias("preferred_location_id"),
            hours_after("2023-01-01 00:00:00", k * 11 % 9000).alias("created_at"),
        )
        again = first.where(F.col("user_id").cast("bigint") % 4 == 0).withColumn(
            "created_at", F.timestamp_add("HOUR", F.lit(9), F.col("created_at"))
        )
        return first.unionAll(again)

    # ---- inputs of the warehouse build ----

    def user_snapshot() -> DataFrame:
        k = F.col("c_custkey")
        return table("customer").where(k % 2 == 0).select(
            k.cast("string").alias("user_id"),
            F.col("c_name").alias("first_name"),
            F.col("c_mktsegment").alias("last_name"),
            F.concat(F.lower("c_name"), F.lit("@example.com")).alias("email"),
            (5550000 + k % 9999).cast("string").alias("phone_number"),
            F.when(k % 4 != 0, F.date_add(F.lit("1960-01-01").cast("date"), (k * 37 % 16000).cast("int"))).alias("date_of_birth"),
            pick(k % 5, "male", "MALE", "female", "Female", "unknown").alias("gender"),
            F.lit("UNKNOWN").alias("city"),
            (k % 25).cast("string").alias("preferred_location_id"),
            hours_after("2023-01-01 00:00:00", k * 11 % 9000).alias("created_at"),
            (16 + k % 50).cast("int").alias("age"),
            F.length("c_name").alias("full_name_length"),
        )

    def stream_users() -> DataFrame:
        k = F.col("c_custkey")
        created = hours_after("2023-06-01 00:00:00", k * 13 % 5000)
        return table("customer").where(k % 2 == 1).select(
            k.cast("string").alias("user_id"),
            F.lower("c_name").alias("first_name"),
            F.lower("c_mktsegment").alias("last_name"),
            F.concat(F.lower("c_name"), F.lit("@example.com")).alias("email"),
            (5550000 + k % 9999).cast("string").alias("phone_number"),
            F.when(k % 3 == 0, "unknown").otherwise(F.date_add(F.lit("1960-01-01").cast("date"), (k * 37 % 16000).cast("int")).cast("string")).alias("date_of_birth"),
            F.lower(pick(k % 5, "male", "MALE", "female", "Female", "unknown")).alias("gender"),
            F.lit("unknown").alias("city"),
            (k % 25).cast("string").alias("preferred_location_id"),
            F.when(k % 5 == 0, "unknown").otherwise(F.date_format(created, "yyyy-MM-dd HH:mm:ss")).alias("created_at"),
            clock.moment(STAMP).alias("processed_time"),
            clock.moment(STAMP).alias("processed_timestamp"),
            (1 + k % 28).cast("int").alias("day"),
            F.lit("users").alias("partition_0"),
            F.lit(2024).alias("year"),
            (1 + k % 3).cast("int").alias("month"),
        )

    def schedule_parts(even: bool) -> DataFrame:
        p = F.col("p_partkey")
        rows = table("part").where(p % 2 == (0 if even else 1))
        return rows.withColumn("at", hours_after("2024-01-01 00:00:00", p * 7 % 2160))

    def schedule() -> DataFrame:
        p, at = F.col("p_partkey"), F.col("at")
        return schedule_parts(True).select(
            p.cast("string").alias("session_id"),
            clock.start_of_day(at).alias("date"),
            F.date_format(at, "HH:mm:ss").alias("time"),
            at.alias("datetime"),
            F.col("p_brand").alias("class_code"),
            F.col("p_name").alias("class_name"),
            F.when(p % 10 == 0, F.lit(-1)).otherwise(F.col("p_size")).alias("instructor_id"),
            F.concat(F.lit("Coach "), F.col("p_size").cast("string")).alias("instructor_name"),
            (p % 25).cast("string").alias("loc_id"),
            F.col("p_type").alias("city"),
            F.concat(F.lit("Hall "), (p % 25).cast("string")).alias("location_name"),
            (1 + p % 52).cast("int").alias("week_number"),
            F.year(at).alias("year"),
            F.month(at).alias("month"),
            F.date_format(at, "EEEE").alias("day_of_week"),
            F.dayofweek(at).isin(1, 7).alias("is_weekend"),
            (30 + 15 * (F.col("p_size") % 4)).alias("duration_mins"),
            clock.moment(STAMP).alias("processed_time"),
        )

    def stream_schedule() -> DataFrame:
        p, at = F.col("p_partkey"), F.col("at")
        stamp = F.date_format(at, "yyyy-MM-dd't'HH:mm:ss")
        return schedule_parts(False).select(
            p.cast("string").alias("session_id"),
            F.when(p % 9 == 0, "unknown").otherwise(stamp).alias("date"),
            F.date_format(at, "HH:mm:ss.SSS").alias("time"),
            F.when(p % 7 == 0, "unknown").otherwise(stamp).alias("datetime"),
            F.lower("p_brand").alias("class_code"),
            F.lower("p_name").alias("class_name"),
            F.when(p % 5 == 0, "unknown").otherwise(F.col("p_size").cast("string")).alias("instructor_id"),
            F.concat(F.lit("coach "), F.col("p_size").cast("string")).alias("instructor_name"),
            (p % 25).cast("string").alias("loc_id"),
            F.lower("p_type").alias("city"),
            F.concat(F.lit("hall "), (p % 25).cast("string")).alias("location_name"),
            (1 + p % 52).cast("string").alias("week_number"),
            F.year(at).cast("string").alias("year"),
            F.month(at).cast("string").alias("month"),
            F.lower(F.date_format(at, "EEEE")).alias("day_of_week"),
            F.when(F.dayofweek(at).isin(1, 7), "true").otherwise("false").alias("is_weekend"),
            (30 + 15 * (F.col("p_size") % 4)).cast("string").alias("duration_mins"),
            F.when(p % 11 == 0, "unknown").otherwise(stamp).alias("release_timestamp"),
            clock.moment(STAMP).alias("processed_time"),
        )

    def cleaned_events() -> DataFrame:
        """Cleaned stream events as the event fact reads them."""
        e = F.col("event_id").cast("bigint")
        at = hours_after("2024-01-01 00:00:00", F.col("session_id").cast("bigint") * 7 % 2160)
        class_text = F.when(e % 13 == 0, "unknown").otherwise(F.date_format(at, "yyyy-MM-dd't'HH:mm:ss"))
        return tables["raw_events"].select(
            F.when(e % 101 != 0, F.col("event_id")).alias("event_id"),
            "user_id",
            "session_id",
            F.when(e % 103 != 0, F.col("event_type")).alias("event_type"),
            "event_ts",
            (F.col("session_id").cast("bigint") % 25).cast("string").alias("location_id"),
            class_text.alias("class_datetime"),
            "processed_time",
            "year",
            "month",
            "day",
        )

    builders = {
        name: build
        for name, build in locals().items()
        if callable(build) and name not in ("table", "with_copies", "schedule_parts")
    }
    tables = Tables(builders)
    return tables


def warehouse_inputs(spark: SparkSession, sf_dir: str) -> Tables:
    """The domain tables under the names that the warehouse build expects."""
    tables = domain_tables(spark, sf_dir)
    return tables.with_tables(
        class_attendance=lambda: tables["nested_attendance"], events=lambda: tables["cleaned_events"]
    )
