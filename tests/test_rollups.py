import numpy as np
import pytest

from turnstile.operators import rollups


@pytest.fixture
def hours(spark):
    data = [(0, 100), (4, 100), (5, 1), (8, 2), (9, 4), (23, 8)]
    return spark.createDataFrame(data, "class_hour int, total_sessions bigint")


def test_day_periods(hours, rows):
    expected = [("Early Morning (5-8)", 3), ("Morning (9-11)", 4), ("Night (21-23)", 8)]
    assert rows(rollups.day_periods(hours)) == expected
    kept = rollups.day_periods(hours, keep_empty=True)
    empty = [("Noon (12-13)", 0), ("Afternoon (14-16)", 0), ("Evening (17-20)", 0)]
    assert rows(kept) == sorted(expected + empty)
    assert sum(n for _, n in expected) <= 215


def test_weekday_split(spark, rows):
    df = spark.createDataFrame([(1, 5), (7, 6), (2, 1), (6, 2), (None, 9)], "weekday int, total_sessions bigint")
    assert rows(rollups.weekday_split(df)) == [("Weekday (Mon-Fri)", 3), ("Weekend (Sat-Sun)", 11)]
    assert rows(rollups.weekday_split(df.where("weekday = 1"), labels=rollups.SHORT_LABELS)) == [("Weekdays", 0), ("Weekend", 5)]


def test_pivot_and_totals(spark, rows):
    data = [(1, "a", "x", 5), (1, "b", "x", 6), (2, "a", "x", 7)]
    df = spark.createDataFrame(data, "month int, location_name string, city string, total_attendance bigint")
    assert rows(rollups.month_by_location(df)) == [(1, 5, 6), (2, 7, 0)]
    assert rows(rollups.month_by_location(df, ["b", "c"])) == [(1, 6, 0), (2, 0, 0)]
    assert [tuple(r) for r in rollups.totals_by(df, "location_name").collect()] == [("a", 12), ("b", 6)]
    assert [tuple(r) for r in rollups.totals_by(df, "city").collect()] == [("x", 18)]


def test_category_order(spark):
    df = spark.createDataFrame([("45+",), ("odd",), ("<25",), ("35-44",), ("25-34",)], "age_group string")
    assert [r[0] for r in rollups.in_order(df).collect()] == ["<25", "25-34", "35-44", "45+", "odd"]


def test_shares(spark, rows):
    df = spark.createDataFrame([("a", 1), ("b", 2), ("c", None)], "k string, total bigint")
    assert rows(rollups.share_of_total(df, "total"), "k", "share") == [("a", 33.3), ("b", 66.7)]
    assert rows(rollups.share_of_total(df.where("k = 'c'"), "total")) == []
    zero = spark.createDataFrame([("a", 0)], "k string, total bigint")
    assert rows(rollups.share_of_total(zero, "total")) == []


def test_rank(spark):
    data = [("u1", "A", "B", 3), ("u2", "C", "D", 9), ("u3", "E", "F", 3)]
    df = spark.createDataFrame(data, "user_id string, first_name string, last_name string, total_classes_attended bigint")
    board = rollups.ranked(df, n=2)
    assert board.columns == ["Rank", "First Name", "Last Name", "Classes Attended"]
    assert [tuple(r) for r in board.orderBy("Rank").collect()] == [(1, "C", "D", 9), (2, "A", "B", 3)]


@pytest.mark.parametrize("values", [[91, 95, 100, 191, 191], [7, 7, 7], [0, 1, 2, 3, 10, 10], [1.5, 2.25, 9.75]])
def test_histogram_like_numpy(spark, values):
    df = spark.createDataFrame([(float(v),) for v in values] + [(None,)], "x double")
    found = [tuple(r) for r in rollups.histogram(df, "x").orderBy("bin").collect()]
    counts, edges = np.histogram(values, bins=10)
    assert [n for *_, n in found] == counts.tolist()
    assert [b for b, *_ in found] == list(range(1, 11))
    assert np.allclose([s for _, s, _, _ in found] + [found[-1][2]], edges)


def test_top_numbers_and_total(spark, rows):
    df = spark.createDataFrame([("a", "1"), ("b", "x"), ("c", "3")], "k string, n string")
    numbers = rollups.as_numbers(df, ["n"])
    assert rows(numbers) == [("a", 1.0), ("b", None), ("c", 3.0)]
    assert [r[0] for r in rollups.top(numbers, "n", "k", 2).collect()] == ["c", "a"]
    assert rows(rollups.row_total(df)) == [(3,)]
    assert rows(rollups.of_year(spark.createDataFrame([(2024,), (2025,)], "year int"), 2025)) == [(2025,)]
