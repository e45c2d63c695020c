"""Q-13, Q-14, Q-16 … Q-18: flat class attendance, renewals and facility use."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turnstile.functions import clock
from turnstile.plans.events import TableMap, count_per


def class_attendance(tables: TableMap, as_of: clock.DayLike = None, days: int = 30, limit: int = 20) -> DataFrame:
    """Q-13: distinct users per class."""
    recent = tables["class_attendance"].where(F.col("class_date") >= F.date_sub(clock.day(as_of), days))
    counts = recent.groupBy("class_id", "class_name").agg(F.count_distinct("user_id").alias("attendance_count"))
    ties = [F.asc_nulls_last("class_id"), F.asc_nulls_last("class_name")]
    return counts.orderBy(F.desc("attendance_count"), *ties).limit(limit)


def renewal_rate(tables: TableMap, as_of: clock.DayLike = None, days: int = 90) -> DataFrame:
    """Q-14: renewed share per membership type, in percent."""
    recent = tables["membership_renewals"].where(F.col("renewal_date") >= clock.days_before(as_of, days))
    counts = recent.groupBy("membership_type").agg(
        F.count_if(F.col("renewal_status") == "renewed").alias("renewed"), F.count(F.lit(1)).alias("total")
    )
    rate = F.col("renewed").cast("double") * 100 / F.col("total")
    return counts.withColumn("renewal_rate", rate).orderBy(F.desc("renewal_rate"), F.asc_nulls_last("membership_type"))


def _recent_use(tables: TableMap, as_of: clock.DayLike, days: int) -> DataFrame:
    return tables["facility_usage"].where(F.col("usage_date") >= F.date_sub(clock.day(as_of), days))


def facility_use(tables: TableMap, as_of: clock.DayLike = None, days: int = 30) -> DataFrame:
    """Q-16."""
    counts = count_per(_recent_use(tables, as_of, days), "facility_id", "facility_name", alias="usage_count")
    ties = [F.asc_nulls_last("facility_id"), F.asc_nulls_last("facility_name")]
    return counts.orderBy(F.desc("usage_count"), *ties)


def facility_peak_hours(tables: TableMap, as_of: clock.DayLike = None, days: int = 14) -> DataFrame:
    """Q-17."""
    hour = F.hour("usage_time").alias("hour_of_day")
    counts = count_per(_recent_use(tables, as_of, days), hour, "facility_id", "facility_name", alias="usage_count")
    order = [F.asc_nulls_last("facility_id"), F.desc("usage_count"), F.asc_nulls_last("hour_of_day")]
    return counts.orderBy(*order, F.asc_nulls_last("facility_name"))


def facility_trend(tables: TableMap, as_of: clock.DayLike = None, days: int = 30) -> DataFrame:
    """Q-18."""
    day = clock.start_of_day(F.col("usage_date")).alias("day")
    counts = count_per(_recent_use(tables, as_of, days), day, "facility_id", "facility_name", alias="usage_count")
    return counts.orderBy(F.asc_nulls_last("facility_id"), F.asc_nulls_last("day"), F.asc_nulls_last("facility_name"))
