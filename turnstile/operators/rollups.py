"""P-1 … P-15: what a dashboard derives from a query result."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from turnstile.functions import text

# Day periods with their first and last hour.
DAY_PERIODS = {
    "Early Morning (5-8)": (5, 8),
    "Morning (9-11)": (9, 11),
    "Noon (12-13)": (12, 13),
    "Afternoon (14-16)": (14, 16),
    "Evening (17-20)": (17, 20),
    "Night (21-23)": (21, 23),
}
# Weekday groups (1 is Sunday) under both sets of labels, and the order of age groups.
WORKDAYS = (2, 3, 4, 5, 6)
WEEKEND = (1, 7)
LONG_LABELS = ("Weekday (Mon-Fri)", "Weekend (Sat-Sun)")
SHORT_LABELS = ("Weekdays", "Weekend")
AGE_ORDER = ("<25", "25-34", "35-44", "45+")


def as_numbers(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """P-1."""
    return df.withColumns({c: text.lenient_number(F.col(c)) for c in columns})


def top(df: DataFrame, by: str, label: str, n: int = 10) -> DataFrame:
    """P-2."""
    return df.orderBy(F.desc_nulls_last(by), F.asc(label)).limit(n)


def _sums_as_rows(df: DataFrame, label: str, value: str, parts: Sequence[tuple[str, Column]]) -> DataFrame:
    """One global aggregation with a filtered sum per part, turned into one row per part.

    ``n`` says how many rows fell into the part. No join and no shuffle by label is needed.
    """
    sums = [F.sum(F.when(test, F.col(value))).alias(f"s{i}") for i, (_, test) in enumerate(parts)]
    counts = [F.count(F.when(test, F.lit(1))).alias(f"n{i}") for i, (_, test) in enumerate(parts)]
    rows = F.array(
        *[
            F.struct(F.lit(name).alias(label), F.col(f"s{i}").alias(value), F.col(f"n{i}").alias("n"))
            for i, (name, _) in enumerate(parts)
        ]
    )
    return df.agg(*sums, *counts).select(F.inline(rows))


def day_periods(df: DataFrame, hour: str = "class_hour", value: str = "total_sessions", keep_empty: bool = False) -> DataFrame:
    """P-3, P-4: totals per day period. Hours 0-4 belong to none.

    Periods without a row are dropped, or kept with 0 when ``keep_empty`` is set.
    """
    parts = [(name, F.col(hour).between(first, last)) for name, (first, last) in DAY_PERIODS.items()]
    sums = _sums_as_rows(df, "period", value, parts)
    if not keep_empty:
        sums = sums.where(F.col("n") > 0)
    return sums.select("period", F.coalesce(value, F.lit(0)).alias(value))


def weekday_split(
    df: DataFrame, weekday: str = "weekday", value: str = "total_sessions", labels: tuple[str, str] = LONG_LABELS
) -> DataFrame:
    """P-5: Monday to Friday against the weekend; both rows always exist."""
    parts = [(labels[0], F.col(weekday).isin(*WORKDAYS)), (labels[1], F.col(weekday).isin(*WEEKEND))]
    sums = _sums_as_rows(df, "period", value, parts)
    return sums.select("period", F.coalesce(value, F.lit(0)).alias(value))


def location_names(dim_location: DataFrame) -> list[str | None]:
    """Every name of the dimension in the form of the trend (lower case, null too), for :func:`month_by_location`."""
    names = dim_location.select(F.lower("location_name").alias("name")).distinct()
    return [row["name"] for row in names.orderBy(F.asc_nulls_last("name")).collect()]


def month_by_location(df: DataFrame, locations: Sequence[str] | None = None, value: str = "total_attendance") -> DataFrame:
    """P-6: one row per month, one column per location, 0 where nothing happened.

    Naming the ``locations`` saves the job that looks them up and keeps these alone: rows of any other
    location are left out, so a whole report takes :func:`location_names` or no names. Without names Spark
    raises rather than cut the list when there are more than ``spark.sql.pivotMaxValues``.
    """
    pivoted = df.groupBy("month").pivot("location_name", list(locations) if locations else None).agg(F.sum(value))
    return pivoted.na.fill(0)


def totals_by(df: DataFrame, key: str, value: str = "total_attendance") -> DataFrame:
    """P-7, P-8."""
    total = F.sum(value).alias(value)
    return df.groupBy(key).agg(total).orderBy(F.desc_nulls_last(value), F.asc_nulls_last(key))


def of_year(df: DataFrame, year: int) -> DataFrame:
    """P-9."""
    return df.where(F.col("year") == year)


def in_order(df: DataFrame, column: str = "age_group", order: Sequence[str] = AGE_ORDER) -> DataFrame:
    """P-10: sort by a given order of categories; unknown categories come last."""
    place = F.array_position(F.array(*[F.lit(v) for v in order]), F.col(column))
    return df.orderBy(F.when(place > 0, place).asc_nulls_last(), F.asc(column))


def share_of_total(df: DataFrame, value: str, alias: str = "share") -> DataFrame:
    """P-11, P-12: percentage of the whole, one decimal.

    Rows without a value are dropped, and nothing is returned unless the whole is positive. The whole
    is a scalar subquery, so the rows stay distributed (a window over everything would not).
    """
    rows = df.na.drop(subset=[value])
    whole = rows.agg(F.sum(value).cast("double").alias("whole")).scalar()
    return rows.where(whole > 0).withColumn(alias, F.round(F.col(value).cast("double") * 100 / whole, 1))


def ranked(df: DataFrame, by: str = "total_classes_attended", tie: str = "user_id", n: int = 20) -> DataFrame:
    """P-13: leaderboard with its rank column and display names.

    Only the ``n`` rows of the board itself are numbered, so the single-partition window stays small.
    """
    order = [F.desc_nulls_last(by), F.asc(tie)]
    board = df.orderBy(*order).limit(n)
    return board.select(
        F.row_number().over(Window.orderBy(*order)).alias("Rank"),
        F.col("first_name").alias("First Name"),
        F.col("last_name").alias("Last Name"),
        F.col(by).alias("Classes Attended"),
    )


def row_total(df: DataFrame, alias: str = "total") -> DataFrame:
    """P-14."""
    return df.agg(F.count(F.lit(1)).alias(alias))


def histogram(df: DataFrame, column: str, bins: int = 10) -> DataFrame:
    """P-15: equal-width bins between minimum and maximum, the last one closed, empty ones kept.

    When all values are equal the range is widened by one half to each side. Values are counted once
    per distinct value first, so the second pass over them is small; only the at most ``bins`` filled
    bins are ever gathered in one row.
    """
    value = F.col(column).cast("double")
    values = df.where(value.isNotNull()).groupBy(value.alias("v")).agg(F.count(F.lit(1)).alias("c"))
    low, high = F.min("v"), F.max("v")
    half = F.when(low == high, 0.5).otherwise(0.0)
    ends = values.agg(F.struct((low - half).alias("lo"), (high + half).alias("hi")).alias("ends")).scalar()
    lo, width = F.col("lo"), F.col("hi") - F.col("lo")
    place = F.least(F.floor((F.col("v") - lo) * bins / width), F.lit(bins - 1))
    placed = values.select("v", "c", ends.alias("ends")).select("v", "c", "ends.lo", "ends.hi")
    filled = placed.groupBy("lo", "hi", place.alias("place")).agg(F.sum("c").alias("n"))
    by_place = F.map_from_entries(F.collect_list(F.struct("place", "n"))).alias("by_place")
    whole = filled.groupBy("lo", "hi").agg(by_place)
    i = F.col("i")
    return whole.select("*", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("i")).select(
        (i + 1).alias("bin"),
        (lo + width * i / bins).alias("bin_start"),
        (lo + width * (i + 1) / bins).alias("bin_end"),
        F.coalesce(F.try_element_at("by_place", i.cast("bigint")), F.lit(0)).alias("n"),
    )
