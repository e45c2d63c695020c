"""C-1 … C-27: cleaning steps and the five composite cleaners.

A composite collects one expression per column and applies all of them in a single projection after
the duplicate removal, so a cleaner costs one shuffle whatever the number of columns.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from turnstile.functions import clock, text
from turnstile.operators.state import one_per_key
from turnstile.sources.manifest import LENIENT_NAMING, STRICT_NAMING, FolderNaming

# Defaults of the historical tables.
SCHEDULE_DEFAULTS = {
    "class_code": "UNKNOWN",
    "class_name": "UNKNOWN",
    "instructor_id": -1,
    "instructor_name": "UNKNOWN",
    "loc_id": "UNKNOWN",
    "city": "UNKNOWN",
    "location_name": "UNKNOWN",
    "duration_mins": 0,
}
USER_DEFAULTS = {
    "first_name": "UNKNOWN",
    "last_name": "UNKNOWN",
    "email": "UNKNOWN",
    "phone_number": "UNKNOWN",
    "preferred_location_id": "UNKNOWN",
}
# Time columns per data type, and the day used when a strict name carries none.
TIME_COLUMNS = {"schedule": ("start_time", "end_time"), "users": ("registration_date", "last_login")}
NO_DAY = "20250101"


def drop_copies(df: DataFrame) -> DataFrame:
    """C-1: exact copies, compared before any normalisation. Copies collapse in the map tasks first."""
    return df.dropDuplicates()


def drop_empty(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """C-3: rows whose columns are all null."""
    return df.na.drop(how="all", subset=list(columns) if columns else None)


def text_columns(df: DataFrame) -> list[str]:
    """C-4."""
    return [field.name for field in df.schema.fields if isinstance(field.dataType, StringType)]


def map_columns(df: DataFrame, change: Callable[[Column], Column], columns: Sequence[str]) -> DataFrame:
    """Apply one expression to many columns in one projection."""
    return df.select(*[change(F.col(c)).alias(c) if c in columns else F.col(c) for c in df.columns])


def fill_defaults(df: DataFrame, defaults: Mapping[str, str | int]) -> DataFrame:
    """C-9: typed default per column; a name that is not in the frame raises."""
    return df.na.fill(dict(defaults))


def fill_text(df: DataFrame, value: str = text.HISTORICAL_FILL) -> DataFrame:
    """C-10: all text columns; other types and arrays stay."""
    return df.na.fill(value)


def trim_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """C-11."""
    return map_columns(df, F.trim, columns)


def not_negative(c: Column) -> Column:
    """C-14: negative becomes 0, null stays."""
    return F.when(c < 0, F.lit(0)).otherwise(c)


def not_negative_or_null(c: Column) -> Column:
    """C-15: negative or null becomes 0."""
    return F.greatest(F.coalesce(c, F.lit(0)), F.lit(0))


def day_parts(day_text: Column) -> dict[str, Column]:
    """C-20: year, month and day out of eight digits."""
    spans = {"year": (1, 4), "month": (5, 2), "day": (7, 2)}
    return {name: F.substring(day_text, *span).cast("int") for name, span in spans.items()}


@dataclass(frozen=True)
class StreamProfile:
    """One variant of the stream cleaner."""

    text_rule: Callable[[Column], Column]
    duration_rule: Callable[[Column], Column]
    tidy_email: bool
    naming: FolderNaming
    partition_by: tuple[str, ...]
    no_day: str | None
    type_is_first_token: bool

    def base_type(self, data_type: str) -> str:
        """What a type folder holds: its whole name, or the part before the first underscore."""
        return data_type.split("_")[0] if self.type_is_first_token else data_type

    def day_text(self, folder: Column) -> Column:
        parsed = self.naming.day_text(folder)
        return parsed if self.no_day is None else F.coalesce(parsed, F.lit(self.no_day))


# C-23: personal data. C-24: everything else.
PII = StreamProfile(text.lower_or_unknown, not_negative, True, LENIENT_NAMING, ("year", "month"), None, True)
NON_PII = StreamProfile(
    text.tidy_or_unknown, not_negative_or_null, False, STRICT_NAMING, ("year", "month", "day"), NO_DAY, False
)


def clean_stream(
    df: DataFrame,
    profile: StreamProfile,
    data_type: str,
    folder: Column | str,
    stamp: Column | None = None,
    scope: Sequence[str] = (),
) -> DataFrame:
    """C-23, C-24: clean rows that came from dated folders.

    ``folder`` is the folder name, as a literal or as a column; ``scope`` names bookkeeping columns
    (such as the unit a row came from): they take part in the duplicate test but are not cleaned.
    """
    scope = list(scope)
    data = [c for c in df.columns if c not in scope]
    rows = drop_empty(drop_copies(df), data)

    texts = set(text_columns(df)) - set(scope)
    out = {c: profile.text_rule(F.col(c)) if c in texts else F.col(c) for c in data}
    if data_type == "events" and "event_ts" in out:
        out["event_ts"] = clock.event_time(out["event_ts"], df.schema["event_ts"].dataType)
        out["event_date"] = out["event_ts"].cast("date")
    for name in TIME_COLUMNS.get(data_type, ()):
        if name in out:
            out[name] = clock.parse_moment(out[name])
    out["processed_timestamp"] = (F.current_timestamp() if stamp is None else stamp).cast(clock.NTZ)
    day_text = profile.day_text(F.lit(folder) if isinstance(folder, str) else folder)
    out.update(day_parts(day_text))
    if "duration" in out:
        out["duration"] = profile.duration_rule(out["duration"])
    if "email" in out and profile.tidy_email:
        out["email"] = text.tidy_email(out["email"])
    if "phone_number" in out:
        out["phone_number"] = text.digits_only(out["phone_number"])
    return rows.select(*scope, *[c.alias(name) for name, c in out.items()])


def clean_pii(df: DataFrame, data_type: str, folder: Column | str, stamp: Column | None = None) -> DataFrame:
    """C-23."""
    return clean_stream(df, PII, data_type, folder, stamp)


def clean_non_pii(df: DataFrame, data_type: str, folder: Column | str, stamp: Column | None = None) -> DataFrame:
    """C-24."""
    return clean_stream(df, NON_PII, data_type, folder, stamp)


def clean_historical_schedule(df: DataFrame) -> DataFrame:
    """C-25. Of several rows per session the one processed last wins."""
    prefer = [c for c in ("processed_time",) if c in df.columns]
    unique = fill_defaults(one_per_key(df, ["session_id"], prefer), SCHEDULE_DEFAULTS)
    return trim_columns(unique, ["class_name", "instructor_name", "location_name"])


def clean_historical_users(df: DataFrame) -> DataFrame:
    """C-26. Of several rows per user the one created last wins."""
    prefer = [c for c in ("created_at",) if c in df.columns]
    unique = fill_defaults(one_per_key(df, ["user_id"], prefer), USER_DEFAULTS)
    changed = {"email": F.lower("email"), "phone_number": text.digits_only(F.col("phone_number"))}
    return unique.select(*[changed[c].alias(c) if c in changed else F.col(c) for c in unique.columns])


def clean_historical_attendance(df: DataFrame, stamp: Column | None = None) -> DataFrame:
    """C-27."""
    stamp = F.current_timestamp() if stamp is None else stamp
    return fill_text(drop_copies(df)).withColumn("processed_timestamp", stamp.cast(clock.NTZ))


def unreadable(df: DataFrame, column: str, parse: Callable[[Column], Column] = clock.parse_iso) -> DataFrame:
    """C-22: rows whose ``column`` holds text that does not parse."""
    return df.where(F.col(column).isNotNull() & parse(F.col(column)).isNull())


def cleaning_report(raw: DataFrame, cleaned: DataFrame) -> DataFrame:
    """C-21: rows in, rows out and rows removed, in one job."""
    counted = raw.select(F.lit(1).alias("i"), F.lit(0).alias("o")).unionAll(
        cleaned.select(F.lit(0).alias("i"), F.lit(1).alias("o"))
    )
    total = lambda c: F.coalesce(F.sum(c), F.lit(0))
    return counted.agg(total("i").alias("rows_in"), total("o").alias("rows_out")).withColumn(
        "removed", F.col("rows_in") - F.col("rows_out")
    )
