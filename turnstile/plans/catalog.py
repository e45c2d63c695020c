"""Q-25, Q-26: queries by category and name, and ad-hoc SQL."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession

from turnstile.plans import classes, events, members, users

Query = Callable[..., DataFrame]

# The category and query names that dashboards look queries up by.
CATALOG: dict[str, dict[str, Query]] = {
    "Basic Queries": {
        "Total Event Count": events.total_events,
        "Event Type Distribution": events.event_types,
        "Recent Event List": events.recent_events,
    },
    "Time Analysis": {
        "Daily Event Trends": events.daily_trends,
        "Hourly Event Distribution": events.hourly_distribution,
        "Weekly Event Trends": events.weekly_trends,
        "Most Popular Class Days": classes.class_days,
        "Most Popular Class Times": classes.class_times,
    },
    "User Behavior Analysis": {
        "Active User Ranking": users.active_users,
        "User Event Type Preferences": users.type_preferences,
        "User Engagement": users.engagement,
        "90-Day User Churn Analysis": users.churn_summary,
    },
    "Member Analysis": {
        "课程出勤率": members.class_attendance,
        "会员续订率": members.renewal_rate,
        "会员流失预测": users.inactivity_risk,
    },
    "Facility Usage Analysis": {
        "设施使用率": members.facility_use,
        "设施高峰时段": members.facility_peak_hours,
        "设施使用趋势": members.facility_trend,
    },
    "Location Analysis": {
        "门店出勤趋势": classes.location_trend,
    },
    "Leaderboard Queries": {
        "User Class Engagement Leaderboard (April 2025)": classes.leaderboard,
    },
    "Feature Reports": {
        "Popular Classes": classes.popular_classes,
        "Churned Users": users.churned_users,
        "Age Distribution": users.age_distribution,
        "Gender Distribution": users.gender_distribution,
    },
}


def get_query_categories() -> list[str]:
    return list(CATALOG)


def get_queries_in_category(category: str) -> dict[str, Query]:
    """Queries of a category; an unknown category has none."""
    return CATALOG.get(category, {})


def get_query(category: str, query_name: str) -> Query | None:
    return get_queries_in_category(category).get(query_name)


def run_query(tables: Mapping[str, DataFrame], category: str, query_name: str, **params) -> DataFrame | None:
    """The named query over ``tables``; ``None`` for an unknown name."""
    query = get_query(category, query_name)
    return query(tables, **params) if query else None


def run_sql(spark: SparkSession, sql: str, tables: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """Q-26: SQL over the session catalogue, with ``tables`` visible by name."""
    for name, df in (tables or {}).items():
        df.createOrReplaceTempView(name)
    return spark.sql(sql)
