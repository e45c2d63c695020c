"""I-1 … I-7, T-1, T-2, T-5: new folders in, cleaned and partitioned parquet out.

Layout: ``<source>/<category>/<type>/<type>_<YYYYMMDD>/*.parquet`` is cleaned into
``<target>/<category>/<type>/year=Y/month=M[/day=D]/unit=<folder>``. Rows land in the partition of
their *folder* date, however late they are.

A folder owns its ``unit=`` partition and a load replaces exactly the partitions of the folders it
holds, so a load that is repeated after a crash leaves the same result. Finished folders are listed in
a ledger, which is written last.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from turnstile.functions import clock
from turnstile.operators.clean import PII, StreamProfile, clean_stream
from turnstile.schemas import LEDGER
from turnstile.sources.manifest import (
    category_of,
    file_manifest,
    folder_of,
    pending,
    read_ledger,
    type_of,
    units,
)
from turnstile.sources.readers import FORMAT_BY_EXTENSION, READERS
from turnstile.sources.sinks import observed, spread

UNIT = "_unit"
FOLDER = "_folder"
LATE = "_late"


def _replace_folders(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> int:
    """Write ``df``, replacing what an earlier attempt left in the partitions of its folders.

    Returns the number of rows, observed in the writing stage.
    """
    columns, seen = [*partition_by, "unit"], Observation()
    (
        spread(df.withColumnRenamed(FOLDER, "unit"), columns)
        .observe(seen, F.count(F.lit(1)).alias("written"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*columns)
        .parquet(path)
    )
    return observed(seen).get("written", 0)


def _add_to_ledger(finished: DataFrame, path: str) -> None:
    """Listing a folder twice does no harm: the ledger is only ever used in an anti join."""
    finished.write.mode("append").parquet(path)


def read_cleaned(spark: SparkSession, path: str) -> DataFrame:
    """Cleaned rows of one type without the bookkeeping column."""
    return spark.read.parquet(path).drop("unit")


def with_unit(df: DataFrame) -> DataFrame:
    """Name the dated folder each row was read from."""
    path = F.col("_metadata.file_path")
    unit = F.concat_ws("/", category_of(path), type_of(path), folder_of(path))
    return df.select("*", folder_of(path).alias(FOLDER), unit.alias(UNIT))


def clean_units(rows: DataFrame, profile: StreamProfile, data_type: str, stamp: Column | None = None) -> DataFrame:
    """T-2: clean rows of many folders at once; copies are removed within their own folder only."""
    return clean_stream(rows, profile, profile.base_type(data_type), F.col(FOLDER), stamp, scope=[UNIT, FOLDER])


def rejection(rows: DataFrame, profile: StreamProfile, data_type: str) -> Column:
    """T-5: why a row is set aside, null for a row without fault.

    ``late`` marks files that arrived in a folder after it was loaded, ``folder name`` a name that
    cannot be read, ``event_ts`` an event time that does not parse (such rows are loaded as well).
    """
    reason = F.when(F.col(LATE), "late").when(~profile.naming.is_valid(F.col(FOLDER)), "folder name")
    if profile.base_type(data_type) == "events" and "event_ts" in rows.columns:
        text = F.lower(F.trim("event_ts"))
        reason = reason.when(F.col("event_ts").isNotNull() & clock.event_time(text, rows.schema["event_ts"].dataType).isNull(), "event_ts")
    return reason


@dataclass(frozen=True)
class IngestPaths:
    """Where one category of folders is read from and where its results go."""

    source: str
    target: str
    category: str

    def folders(self, data_type: str) -> str:
        return f"{self.source}/{self.category}/{data_type}/*"

    def cleaned(self, data_type: str) -> str:
        return f"{self.target}/{self.category}/{data_type}"

    def ledger(self, data_type: str) -> str:
        return f"{self.target}/_ledger/{self.category}/{data_type}"

    def quarantine(self, data_type: str) -> str:
        return f"{self.target}/_quarantine/{self.category}/{data_type}"

    def checkpoint(self, data_type: str) -> str:
        return f"{self.target}/_checkpoint/{self.category}/{data_type}"


def _load_batch(
    rows: DataFrame, batch: int, paths: IngestPaths, profile: StreamProfile, data_type: str, stamp: Column | None
) -> None:
    """Clean, quarantine and ledger the rows of one micro-batch."""
    number = F.lit(batch).cast("bigint").alias("batch")
    valid = rows.where(~F.col(LATE) & profile.naming.is_valid(F.col(FOLDER))).drop(LATE)
    cleaned = clean_units(valid, profile, data_type, stamp).drop(UNIT)
    _replace_folders(cleaned, paths.cleaned(data_type), profile.partition_by)
    reasons = rows.select("*", rejection(rows, profile, data_type).alias("reason"), number)
    rejected = reasons.where(F.col("reason").isNotNull()).drop(UNIT, LATE)
    _replace_folders(rejected, paths.quarantine(data_type), ["batch"])
    _add_to_ledger(valid.select(F.col(UNIT).alias("unit"), number).distinct(), paths.ledger(data_type))


def start_ingest(
    spark: SparkSession,
    paths: IngestPaths,
    data_type: str,
    schema: StructType | str,
    profile: StreamProfile = PII,
    stamp: Column | None = None,
    continuous: str | None = None,
) -> StreamingQuery:
    """T-1: ingest what is new, exactly once, restartable from its checkpoint.

    Runs until everything present is loaded, or forever with ``continuous`` as trigger interval. A
    folder counts as complete when first seen: files that arrive in it later go to quarantine. Folders
    are never split over batches, because copies are removed per folder.
    """
    stream = (
        spark.readStream.schema(schema)
        .option("pathGlobFilter", "*.parquet")
        .parquet(paths.folders(data_type))
        .transform(with_unit)
    )

    def load(batch_rows: DataFrame, batch: int) -> None:
        ledger = read_ledger(batch_rows.sparkSession, paths.ledger(data_type))
        earlier = ledger.where(F.col("batch") < batch).select(F.col("unit").alias(UNIT)).distinct()
        marked = batch_rows.join(earlier.withColumn(LATE, F.lit(True)), UNIT, "left")
        rows = marked.withColumn(LATE, F.col(LATE).isNotNull()).persist()
        try:
            _load_batch(rows, batch, paths, profile, data_type, stamp)
        finally:
            rows.unpersist()

    writer = stream.writeStream.foreachBatch(load).option("checkpointLocation", paths.checkpoint(data_type))
    trigger = {"processingTime": continuous} if continuous else {"availableNow": True}
    return writer.trigger(**trigger).start()


def run_isolated(names: Sequence[str], load: Callable[[Sequence[str]], None]) -> list[tuple[str, str]]:
    """I-7: load all names together; where that fails, halve until the failing ones stand alone.

    Returns the failures as (name, message). Good names cost one job as long as nothing fails.
    """
    names = list(names)
    if not names:
        return []
    try:
        load(names)
        return []
    except Exception as error:
        if len(names) == 1:
            return [(names[0], str(error).splitlines()[0])]
        middle = len(names) // 2
        return run_isolated(names[:middle], load) + run_isolated(names[middle:], load)


def ingest_pending(
    spark: SparkSession,
    paths: IngestPaths,
    data_type: str,
    profile: StreamProfile = PII,
    schema: StructType | str | None = None,
    stamp: Column | None = None,
) -> DataFrame:
    """I-2 … I-7 as a batch job: load the folders that the ledger does not list.

    Returns one row per folder that was looked at: ``loaded``, ``skipped`` for a name that cannot be
    read, or ``failed``. Skipped and failed folders are not ledgered, so they are tried again; empty
    folders are. Only folder names come to the driver.
    """
    ledger_path = paths.ledger(data_type)
    ledger = read_ledger(spark, ledger_path)
    files = file_manifest(spark, f"{paths.source}/{paths.category}/{data_type}", "*.parquet")
    new = pending(units(files, profile.naming), ledger).select("unit", "location", "day_text").collect()
    unit_at = {row["location"]: row["unit"] for row in new}

    def load(locations: Sequence[str]) -> None:
        reader = spark.read.schema(schema) if schema is not None else spark.read.option("mergeSchema", True)
        rows = with_unit(reader.option("pathGlobFilter", "*.parquet").parquet(*locations))
        cleaned = clean_units(rows, profile, data_type, stamp).drop(UNIT)
        _replace_folders(cleaned, paths.cleaned(data_type), profile.partition_by)
        _add_to_ledger(spark.createDataFrame([(unit_at[at], -1) for at in locations], LEDGER), ledger_path)

    failures = dict(run_isolated(sorted(row["location"] for row in new if row["day_text"]), load))
    outcome = [
        (row["unit"], "failed" if row["location"] in failures else "loaded" if row["day_text"] else "skipped",
         failures.get(row["location"]))
        for row in new
    ]
    return spark.createDataFrame(outcome, "unit string, outcome string, message string")


def _stem(path: Column) -> Column:
    """File name up to its first dot."""
    return F.substring_index(F.regexp_extract(path, r"([^/]+)$", 1), ".", 1)


def _with_target(files: DataFrame, root: str) -> DataFrame:
    """Directory below ``root`` and stem of each file: the two name its target."""
    below = F.substring_index("path", root.rstrip("/") + "/", -1)
    return files.select("path", F.regexp_extract(below, r"^(.*)/[^/]+$", 1).alias("dir"), _stem(F.col("path")).alias("stem"))


def _converted(spark: SparkSession, target: str) -> DataFrame:
    """Targets that exist already."""
    try:
        files = file_manifest(spark, target, "*.parquet")
    except AnalysisException:
        return spark.createDataFrame([], "dir string, stem string")
    below = F.substring_index("path", target.rstrip("/") + "/", -1)
    parts = r"^(.*)/unit=([^/]+)/[^/]+$"
    return files.select(
        F.regexp_extract(below, parts, 1).alias("dir"), F.regexp_extract(below, parts, 2).alias("stem")
    ).distinct()


def conversion_plan(spark: SparkSession, source: str, target: str) -> DataFrame:
    """I-1: what is to be done with each raw file.

    ``convert`` goes to one file per target: the first by name of those a reader knows. ``exists``
    marks the files whose target is there already or taken by another one.
    """
    name = F.regexp_extract("path", r"([^/]+)$", 1)
    extension = F.when(name.contains("."), F.lower(F.substring_index(name, ".", -1))).otherwise("")
    formats = F.create_map(*[F.lit(part) for pair in FORMAT_BY_EXTENSION.items() for part in pair])
    files = _with_target(file_manifest(spark, source), source).withColumn("format", F.try_element_at(formats, extension))
    target_key = ["dir", "stem"]
    known = files.where(F.col("format").isNotNull())
    taken = known.groupBy(*target_key).agg(F.min("path").alias("first"))
    done = _converted(spark, target).withColumn("done", F.lit(True))
    free = F.col("done").isNull() & (F.col("path") == F.col("first"))
    action = F.when(F.col("format").isNull(), "unsupported").when(free, "convert").otherwise("exists")
    rows = files.join(taken, target_key, "left").join(done, target_key, "left")
    return rows.select("path", "dir", "stem", "format", action.alias("action"))


def convert_pending(spark: SparkSession, source: str, target: str, stamp: Column | None = None) -> DataFrame:
    """I-1: raw files to parquet, each into ``<target>/<dir>/unit=<name before the first dot>``.

    New files of one directory and format share a schema and are converted by one job, so the number
    of jobs follows the directories, not the files. Only the names of new files come to the driver,
    where the readers need them. Returns one row per new file: ``converted``, ``mismatch`` when the
    written rows were not all found again (K-8), or ``failed``.
    """
    groups: dict[tuple[str, str], dict[str, str]] = {}
    for row in conversion_plan(spark, source, target).where(F.col("action") == "convert").collect():
        groups.setdefault((row["dir"], row["format"]), {})[row["path"]] = row["stem"]

    outcome = []
    for (directory, fmt), stem_of in sorted(groups.items()):
        lost: list[str] = []

        def load(paths: Sequence[str], fmt=fmt, out=f"{target}/{directory}", stem_of=stem_of, lost=lost) -> None:
            unit = _stem(F.col("_metadata.file_path")).alias(FOLDER)
            now = (F.current_timestamp() if stamp is None else stamp).cast(clock.NTZ).alias("processed_time")
            written = _replace_folders(READERS[fmt](spark, paths).select("*", now, unit), out)
            back = spark.read.schema("unit string").parquet(out)
            if back.where(F.col("unit").isin([stem_of[p] for p in paths])).count() != written:
                lost.extend(paths)

        failures = dict(run_isolated(sorted(stem_of), load))
        for path in stem_of:
            what = "failed" if path in failures else "mismatch" if path in lost else "converted"
            outcome.append((path, what, failures.get(path)))
    return spark.createDataFrame(outcome, "path string, outcome string, message string")


def start_convert(
    spark: SparkSession,
    source: str,
    target: str,
    fmt: str,
    schema: StructType | str,
    checkpoint: str,
    continuous: str | None = None,
) -> StreamingQuery:
    """I-1 as a stream over one raw directory: every new file once, with a declared schema."""
    options = {"header": True} if fmt == "csv" else {}
    rows = spark.readStream.format(fmt).schema(schema).options(**options).load(source)
    unit = _stem(F.col("_metadata.file_path")).alias("unit")
    converted = rows.select("*", F.current_timestamp().cast(clock.NTZ).alias("processed_time"), unit)
    trigger = {"processingTime": continuous} if continuous else {"availableNow": True}
    return (
        converted.writeStream.format("parquet")
        .partitionBy("unit")
        .option("path", target)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )
