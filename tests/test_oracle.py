"""Every registered query against its independent SQL on the smallest test data."""

import pytest

from checks.compare import compare, duck
from checks.oracle import oracle_sql
from checks.queries import queries

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_sql():
    assert set(queries()) == set(oracle_sql())


@pytest.mark.parametrize("name", list(queries()))
def test_same_result(spark, con, name):
    assert compare(spark, con, SF, name) == ""


def test_other_session_zone(spark, con):
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        for name in ("q04_daily_trends", "q05_hourly", "q06_weekly_trends", "q08_class_times", "q12_churn_summary", "q22_churned_users", "f_dates", "m08_fact_attendance", "m09_fact_event"):
            assert compare(spark, con, SF, name) == "", name
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
