"""Q-09 … Q-12, Q-15, Q-22 … Q-24: activity, churn and demographics of users."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from turnstile.functions import clock
from turnstile.operators.joins import left_join_hot
from turnstile.operators.state import CANCEL, CHECKIN, SIGNUP, latest_state
from turnstile.plans.events import TableMap, count_per, since


def active_users(tables: TableMap, as_of: clock.DayLike = None, days: int = 30, limit: int = 20) -> DataFrame:
    """Q-09."""
    counts = count_per(since(tables, as_of, days), "user_id", alias="activity_count")
    return counts.orderBy(F.desc("activity_count"), F.asc_nulls_last("user_id")).limit(limit)


def type_preferences(tables: TableMap, as_of: clock.DayLike = None, days: int = 30, limit: int = 100) -> DataFrame:
    """Q-10."""
    counts = count_per(since(tables, as_of, days), "user_id", "event_type", alias="type_count")
    order = [F.asc_nulls_last("user_id"), F.desc("type_count"), F.asc_nulls_last("event_type")]
    return counts.orderBy(*order).limit(limit)


def engagement(
    tables: TableMap, as_of: clock.DayLike = None, days: int = 30, min_days: int = 1, limit: int | None = 20
) -> DataFrame:
    """Q-11: events per active day in whole numbers, for users active on more than ``min_days`` days.

    Events are counted per user and day first; the second step then adds at most one row per day.
    """
    per_day = count_per(since(tables, as_of, days), "user_id", F.col("event_ts").cast("date").alias("day"))
    per_user = per_day.groupBy("user_id").agg(
        F.count("day").alias("active_days"), F.sum("event_count").alias("total_events")
    )
    rate = F.call_function("div", F.col("total_events"), F.col("active_days"))
    busy = per_user.where(F.col("active_days") > min_days).withColumn("events_per_day", rate)
    ordered = busy.orderBy(F.desc("events_per_day"), F.asc_nulls_last("user_id"))
    return ordered if limit is None else ordered.limit(limit)


def inactivity_risk(tables: TableMap, as_of: clock.DayLike = None, limit: int = 100) -> DataFrame:
    """Q-15: calendar days since the last event, in three tiers."""
    last = tables["events"].groupBy("user_id").agg(F.max("event_ts").alias("last_activity_date"))
    inactive = F.datediff(clock.day(as_of), F.col("last_activity_date").cast("date"))
    risk = (
        F.when(F.col("days_inactive") > 30, "High Risk").when(F.col("days_inactive") > 14, "Medium Risk").otherwise("Low Risk")
    )
    rows = last.withColumn("days_inactive", inactive).withColumn("churn_risk", risk)
    return rows.orderBy(F.desc_nulls_last("days_inactive"), F.asc_nulls_last("user_id")).limit(limit)


def last_activity(tables: TableMap, order: Sequence[str]) -> DataFrame:
    """Latest confirmed attendance or standing signup per user.

    The maximum ignores repeats, so both sources are simply added up; each map task sends one row
    per user.
    """
    counted = F.col("event_type").isin(SIGNUP, CHECKIN, CANCEL)
    signups = latest_state(tables["fact_event"], order, where=counted)
    attended = tables["fact_class_attendance"].select("user_id", F.col("class_datetime").alias("activity_time"))
    both = attended.unionAll(signups.select("user_id", F.col("event_ts").cast(clock.NTZ).alias("activity_time")))
    return both.groupBy("user_id").agg(F.max("activity_time").alias("last_activity_time"))


def churn_summary(tables: TableMap, as_of: clock.DayLike = None, days: int = 90) -> DataFrame:
    """Q-12: users and percentage per status. The window runs over the two status rows only."""
    lapsed = F.col("last_activity_time") < clock.days_before(as_of, days)
    status = F.when(lapsed, "Churned").otherwise("Active").alias("churn_status")
    counts = count_per(last_activity(tables, ["processed_time"]), status, alias="user_count")
    whole = F.sum("user_count").over(Window.partitionBy())
    share = F.round(F.col("user_count").cast("double") * 100 / whole, 2)
    return counts.withColumn("percentage", share).orderBy(F.desc("user_count"), "churn_status")


def churned_users(tables: TableMap, as_of: clock.DayLike = None, days: int = 90, hot_rows: int | None = None) -> DataFrame:
    """Q-22: every user without activity for more than ``days`` completed days, with e-mail if known.

    For a user dimension that keeps duplicates and in which one user can hold a large share of the rows, ``hot_rows``
    says from how many rows on a user is joined in parts.
    """
    inactive = clock.whole_days(F.col("last_activity_time"), clock.moment(clock.day(as_of)))
    gone = last_activity(tables, ["event_ts"]).withColumn("days_inactive", inactive).where(F.col("days_inactive") > days)
    emails = tables["dim_user_v3"].select("user_id", "email")
    joined = gone.join(emails, "user_id", "left") if hot_rows is None else left_join_hot(gone, emails, "user_id", hot_rows)
    rows = joined.select("user_id", "email", "last_activity_time", "days_inactive")
    return rows.orderBy(F.desc("days_inactive"), F.asc_nulls_last("user_id"), F.asc_nulls_last("email"))


def _age_group(age: Column) -> Column:
    return (
        F.when(age < 25, "<25").when(age.between(25, 34), "25-34").when(age.between(35, 44), "35-44").otherwise("45+")
    )


def age_distribution(tables: TableMap, as_of: clock.DayLike = None) -> DataFrame:
    """Q-23: distinct (user, age) pairs per age group, ordered by the label's text."""
    known = F.col("age").isNotNull() | F.col("date_of_birth").isNotNull()
    age = F.coalesce("age", clock.whole_years(F.col("date_of_birth"), clock.day(as_of)))
    ages = tables["dim_user_v3"].where(known).select("user_id", age.alias("final_age")).distinct()
    return count_per(ages, _age_group(F.col("final_age")).alias("age_group"), alias="total").orderBy("age_group")


def gender_distribution(tables: TableMap) -> DataFrame:
    """Q-24."""
    gender = F.lower("gender")
    label = F.initcap(gender).alias("standardized_gender")
    counts = count_per(tables["dim_user_v3"].where(gender.isin("male", "female")), label, alias="total")
    return counts.orderBy(F.desc("total"), "standardized_gender")
