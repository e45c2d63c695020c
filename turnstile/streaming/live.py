"""T-3, T-4: live latest state and live event counts.

Both keep partial results per key, so a hot key costs one state row. Changed rows are appended in
update mode as parquet, numbered by batch; readers take the newest version per key. Nothing is kept in
driver memory.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from turnstile.functions.clock import NTZ
from turnstile.operators.state import PAIR, SIGNUP, latest_by, newest_first
from turnstile.sources import versions

VERSION = "version"
# Windows of seven days are counted from 1970-01-01, a Thursday; the first Monday is four days later.
MONDAY = "4 days"


def live_state(
    events: DataFrame,
    payload: Sequence[str] = ("event_type", "event_ts"),
    order: Sequence[str] = ("event_ts", "event_id"),
    keys: Sequence[str] = PAIR,
) -> DataFrame:
    """T-3: latest ``payload`` per key; the aggregate form of W-1, which streams can maintain."""
    latest = F.max_by(F.struct(*payload), F.struct(*order)).alias("latest")
    return events.groupBy(*keys).agg(latest).select(*keys, "latest.*")


def standing_signups(state: DataFrame) -> DataFrame:
    """Test of the event type, after the latest state is known."""
    return state.where(F.col("event_type") == SIGNUP)


def live_counts(events: DataFrame, every: str, start: str | None = None, watermark: str | None = None) -> DataFrame:
    """T-4: events per clock window.

    Without a ``watermark`` no late event is ever dropped; the state is one row per window. With one,
    Spark forgets windows older than it, and later events for them are lost. Watermarks need zoned
    times, so a session with one should run in UTC, the library's default.
    """
    rows = events
    if watermark:
        rows = rows.withColumn("event_ts", F.col("event_ts").cast("timestamp_ltz")).withWatermark("event_ts", watermark)
    window = F.window("event_ts", every, startTime=start)
    counts = rows.groupBy(window.alias("w")).agg(F.count(F.lit(1)).alias("event_count"))
    return counts.select(F.col("w.start").cast(NTZ).alias("window_start"), "event_count")


def live_daily(events: DataFrame, watermark: str | None = None) -> DataFrame:
    return live_counts(events, "1 day", None, watermark)


def live_hourly(events: DataFrame, watermark: str | None = None) -> DataFrame:
    """Per clock hour; :func:`hour_of_day_totals` adds them up."""
    return live_counts(events, "1 hour", None, watermark)


def live_weekly(events: DataFrame, watermark: str | None = None) -> DataFrame:
    return live_counts(events, "7 days", MONDAY, watermark)


def hour_of_day_totals(hourly: DataFrame) -> DataFrame:
    return hourly.groupBy(F.hour("window_start").alias("hour_of_day")).agg(F.sum("event_count").alias("event_count"))


def start_changelog(changes: DataFrame, path: str, checkpoint: str, continuous: str | None = None) -> StreamingQuery:
    """Append the rows that each batch changed; repeating a batch replaces its own rows."""

    def save(rows: DataFrame, batch: int) -> None:
        (
            rows.withColumn(VERSION, F.lit(batch).cast("bigint"))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(VERSION)
            .parquet(path)
        )

    trigger = {"processingTime": continuous} if continuous else {"availableNow": True}
    writer = changes.writeStream.outputMode("update").foreachBatch(save).option("checkpointLocation", checkpoint)
    return writer.trigger(**trigger).start()


def read_changelog(spark: SparkSession, path: str, keys: Sequence[str]) -> DataFrame:
    """Newest version of every key."""
    rows = spark.read.parquet(path)
    order: list[Column] = newest_first(VERSION)
    return latest_by(rows, keys, order).drop(VERSION)


def base_path(path: str) -> str:
    """Where the compacted part of a change log lies."""
    return f"{path.rstrip('/')}_base"


def read_state(spark: SparkSession, path: str, keys: Sequence[str]) -> DataFrame:
    """Newest version of every key: the compacted base and the changes behind it.

    The base's pointer says up to which batch it goes, and the condition on the batch is one on partitions: changes
    that the base holds are not opened, so reading costs the number of keys and the changes since the last compaction.
    """
    line = versions.current(spark, base_path(path))
    changes = spark.read.parquet(path)
    if line is None:
        return latest_by(changes, keys, newest_first(VERSION)).drop(VERSION)
    base = versions.read_current(spark, base_path(path)).select(*changes.columns)
    both = base.unionByName(changes.where(F.col(VERSION) > line["upto"]))
    return latest_by(both, keys, newest_first(VERSION)).drop(VERSION)


def compact_changelog(spark: SparkSession, path: str, keys: Sequence[str]) -> None:
    """Fold the changes so far into a new base.

    May run beside the stream: batches that finish meanwhile are behind the new base. A batch that is repeated later
    writes the same rows under its number again, which the base holds already.
    """
    line = versions.current(spark, base_path(path))
    changes = spark.read.parquet(path)
    behind = changes if line is None else changes.where(F.col(VERSION) > line["upto"])
    upto = behind.agg(F.max(VERSION)).first()[0]
    if upto is None:
        return
    rows = behind.where(F.col(VERSION) <= upto)
    if line is not None:
        rows = versions.read_current(spark, base_path(path)).select(*changes.columns).unionByName(rows)
    versions.publish(latest_by(rows, keys, newest_first(VERSION)), base_path(path), upto)


def without_copies(events: DataFrame, within: str, keys: Sequence[str] = ("event_id",), time: str = "event_ts") -> DataFrame:
    """T-2 for continuous sources: of rows with equal ``keys`` and times at most ``within`` apart the first stays.

    The state holds the keys of that span only. Copies further apart count as new rows, and rows older than the newest
    time by more than ``within`` are dropped as late; folders, whose rows have no such bound, use the form that works
    per folder. Watermarks need zoned times, so the session should run in UTC.
    """
    zoned = events.withColumn(time, F.col(time).cast("timestamp_ltz")).withWatermark(time, within)
    return zoned.dropDuplicatesWithinWatermark(list(keys)).withColumn(time, F.col(time).cast(NTZ))


def start_append(rows: DataFrame, path: str, checkpoint: str, continuous: str | None = None) -> StreamingQuery:
    """Append a stream's rows as parquet, exactly once."""
    trigger = {"processingTime": continuous} if continuous else {"availableNow": True}
    writer = rows.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
    return writer.trigger(**trigger).start()
