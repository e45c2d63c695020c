"""I-2, I-3, I-7, T-1, T-5, C-21, S-8: folders that grow, loaded whole and reported one by one.

The ledger keeps the *version* of every folder that was loaded: its number of files, their bytes, the newest change and
a fingerprint over names, sizes and times. A run compares what lies in the folders with it and loads again, whole, each
folder whose version differs, into the ``unit=`` partition that the folder owns. So a file that arrives late is loaded,
copies are removed against the rows that came before it, and nothing is set aside for being late. Batch runs and streams
share the ledger and its meaning: a stream only tells which folders were touched, and one that is up to date is left alone.

A version is taken before its rows are read. A file that arrives in between is loaded as well, perhaps twice: the next
run sees another version and replaces the partition once more. A run that ends before it has written its ledger lines is
repeated, with the same result. Two runs over one category must not overlap.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from turnstile.functions import clock
from turnstile.operators.clean import PII, StreamProfile, clean_stream
from turnstile.sources.manifest import FolderNaming, category_of, file_manifest, folder_of, literal, row_path, type_of
from turnstile.sources.sinks import ROWS_A_FILE, observed, spread
from turnstile.streaming.ingest import FOLDER, UNIT, IngestPaths, run_isolated

VERSION = ("files", "bytes", "newest", "fingerprint")
FOLDER_LEDGER = """unit string, files bigint, bytes bigint, newest timestamp, fingerprint bigint,
    outcome string, rejected bigint, load bigint"""
REPORT = """unit string, outcome string, rows_in bigint, rows_out bigint, removed bigint, rejected bigint, message string"""
# Folders loaded by one job, so that a long backlog neither makes one huge job nor a plan of thousands of counters.
FOLDERS_A_JOB = 32

DATED = "_dated"  # what a folder's day is read from
FAULT = "_fault"  # why a row is set aside

Schemas = Mapping[str, StructType | str]


@dataclass(frozen=True)
class FolderPaths(IngestPaths):
    """As :class:`IngestPaths`, with one ledger a category and rejected rows by folder."""

    def category_root(self) -> str:
        return f"{self.source}/{self.category}"

    def folder_ledger(self) -> str:
        """Ledger of the category: a folder of its own for each type, as types are loaded side by side."""
        return f"{self.target}/_folders/{self.category}"

    def rejected(self, data_type: str) -> str:
        return f"{self.target}/_rejected/{self.category}/{data_type}"


def dated_name(path: Column) -> Column:
    """The name a folder's day is read from: for the partition of a converted file, its name up to the first dot."""
    whole = folder_of(path)
    converted = F.substring_index(path, "/", -2).startswith("unit=") & (whole != "unit=")
    return F.when(converted, F.substring_index(whole, ".", 1)).otherwise(whole)


def folder_versions(files: DataFrame) -> DataFrame:
    """One row per dated folder: where it lies and the version its files make up."""
    path = F.col("path")
    located = files.select(
        F.concat_ws("/", category_of(path), type_of(path), folder_of(path)).alias("unit"),
        type_of(path).alias("data_type"), folder_of(path).alias("folder"), dated_name(path).alias("dated"), F.regexp_extract(path, r"^(.*)/[^/]+$", 1).alias("location"),
        F.col("length"), F.col("modificationTime"), F.xxhash64("path", "length", "modificationTime").alias("print"),
    )
    return located.groupBy("unit", "data_type", "folder", "dated", "location").agg(
        F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"), F.max("modificationTime").alias("newest"),
        F.bit_xor("print").alias("fingerprint"),
    )


def read_versions(spark: SparkSession, path: str) -> DataFrame:
    """The last version of every folder in the ledger; a ledger that does not exist yet is an empty one."""
    try:
        lines = spark.read.schema(FOLDER_LEDGER).option("recursiveFileLookup", True).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        lines = spark.createDataFrame([], FOLDER_LEDGER)
    last = F.max_by(F.struct(*[c for c in lines.columns if c not in ("unit", "load")]), "load").alias("last")
    return lines.groupBy("unit").agg(last, F.max("load").alias("load")).select("unit", "last.*", "load")


def changed_folders(versions: DataFrame, ledger: DataFrame) -> DataFrame:
    """Folders that the ledger does not list in this version; ``was_rejected`` is null for a folder never seen."""
    was = ledger.select("unit", *[F.col(c).alias(f"was_{c}") for c in (*VERSION, "rejected")])
    same = [F.col(c).eqNullSafe(F.col(f"was_{c}")) for c in VERSION]
    rows = versions.join(was, "unit", "left")
    return rows.where(~(same[0] & same[1] & same[2] & same[3])).select(*versions.columns, "was_rejected")


def with_folder(df: DataFrame) -> DataFrame:
    """Name the dated folder each row was read from."""
    path = row_path()
    unit = F.concat_ws("/", category_of(path), type_of(path), folder_of(path))
    return df.select("*", folder_of(path).alias(FOLDER), dated_name(path).alias(DATED), unit.alias(UNIT))


def row_fault(rows: DataFrame, profile: StreamProfile, data_type: str) -> Column:
    """T-5: why a row of a folder is set aside, null for a row without fault.

    ``folder name`` marks a name that cannot be read, ``event_ts`` an event time that does not parse (such rows are
    loaded as well).
    """
    unreadable = time_fault(rows, profile, data_type)
    return F.when(~profile.naming.is_valid(F.col(DATED)), "folder name").otherwise(unreadable)


def time_fault(rows: DataFrame, profile: StreamProfile, data_type: str) -> Column:
    """:func:`row_fault` for rows of folders whose names are known to be readable."""
    if profile.base_type(data_type) != "events" or "event_ts" not in rows.columns:
        return F.lit(None).cast("string")
    text = F.lower(F.trim("event_ts"))
    missing = clock.event_time(text, rows.schema["event_ts"].dataType).isNull()
    return F.when(F.col("event_ts").isNotNull() & missing, "event_ts")


def replace_units(df: DataFrame, path: str, partition_by: Sequence[str], folders: Sequence[str], known: bool) -> list[int]:
    """Replace the partitions of ``folders`` by the rows of ``df`` and count those of each folder while writing.

    With ``known``, a folder that was loaded before and has no row now is emptied as well: dynamic overwrite leaves
    partitions alone for which no row arrives.
    """
    columns, seen = [*partition_by, "unit"], Observation()
    counts = [F.count_if(F.col("unit") == name).alias(f"n{i}") for i, name in enumerate(folders)]
    (
        spread(df.withColumnRenamed(FOLDER, "unit"), columns)
        .observe(seen, *counts)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("maxRecordsPerFile", ROWS_A_FILE)
        .partitionBy(*columns)
        .parquet(path)
    )
    written = [observed(seen).get(f"n{i}", 0) for i in range(len(folders))]
    gone = [name for name, n in zip(folders, written, strict=True) if not n]
    if known and gone:
        empty_partitions(df.drop(FOLDER, *partition_by), path, gone)
    return written


def empty_partitions(like: DataFrame, path: str, folders: Sequence[str]) -> None:
    spark = like.sparkSession
    held = spark.read.schema("unit string").parquet(path).where(F.col("unit").isin(list(folders)))
    places = held.select(F.regexp_extract(row_path(), r"^(.*)/[^/]+$", 1).alias("at")).distinct()
    for at in sorted(row["at"] for row in places.collect()):
        spark.createDataFrame([], like.schema).coalesce(1).write.mode("overwrite").parquet(at)


def _load(
    spark: SparkSession, paths: FolderPaths, data_type: str, found: Sequence[Row], profile: StreamProfile,
    schema: StructType | str | None, stamp: Column | None,
) -> list[tuple]:
    """Load some folders of one type by one job; a second one only for folders that hold rejected rows.

    Rows in and rejected rows are observed where the files are read, rows out where they are written. After the loss of
    an executor Spark may count rows read again a second time; rows out are counted once.
    """
    folders, dated = [row["folder"] for row in found], [row["dated"] for row in found]
    reader = spark.read.schema(schema) if schema is not None else spark.read.option("mergeSchema", True)
    rows = with_folder(reader.option("pathGlobFilter", "*.parquet").parquet(*[literal(row["location"]) for row in found]))
    named = all(profile_accepts(spark, profile.naming, dated))
    # Judged once a row, not once for every folder that is counted.
    fault = (time_fault if named else row_fault)(rows, profile, data_type)
    rows = rows.select("*", fault.alias(FAULT))
    bad_row, of, seen = F.col(FAULT).isNotNull(), F.col(FOLDER), Observation()
    counts = [
        measure.alias(f"{kind}{i}")
        for i, name in enumerate(folders)
        for kind, measure in (("in", F.count_if(of == name)), ("bad", F.count_if((of == name) & bad_row)))
    ]
    known = any(row["was_rejected"] is not None for row in found)
    if named:
        base, scope = profile.base_type(data_type), [UNIT, FOLDER, DATED]
        cleaned = clean_stream(rows.observe(seen, *counts).drop(FAULT), profile, base, F.col(DATED), stamp, scope).drop(UNIT, DATED)
        out = replace_units(cleaned, paths.cleaned(data_type), profile.partition_by, folders, known)
        read, bad = ([observed(seen).get(f"{kind}{i}", 0) for i in range(len(folders))] for kind in ("in", "bad"))
    else:
        out, read, bad = [0] * len(folders), [None] * len(folders), [1] * len(folders)
    faulty = [row for row, n in zip(found, bad, strict=True) if n or row["was_rejected"]]
    if faulty:
        names = [row["folder"] for row in faulty]
        rejected = rows.where(of.isin(names) & bad_row).withColumnRenamed(FAULT, "reason").drop(UNIT, DATED)
        set_aside = dict(zip(names, replace_units(rejected, paths.rejected(data_type), (), names, known)))
        bad = [set_aside.get(name, 0) for name in folders]
        read = [n if n is not None else b for n, b in zip(read, bad)]
    outcome = "loaded" if named else "skipped"
    return [(row["unit"], outcome, i, o, b) for row, i, o, b in zip(found, read, out, bad, strict=True)]


def profile_accepts(spark: SparkSession, naming: FolderNaming, folders: Sequence[str]) -> list[bool]:
    """Which folder names can be read; the rule is a column expression, so a table of the names is asked."""
    names = spark.createDataFrame([(i, name) for i, name in enumerate(folders)], "i int, name string")
    return [row["ok"] for row in names.select("i", naming.is_valid(F.col("name")).alias("ok")).orderBy("i").collect()]


def load_folders(
    spark: SparkSession, paths: FolderPaths, data_type: str, found: Sequence[Row], load: int, profile: StreamProfile = PII,
    schema: StructType | str | None = None, stamp: Column | None = None,
) -> list[tuple]:
    """Load changed folders of one type, in jobs of at most ``FOLDERS_A_JOB``; failing folders are singled out.

    Returns rows of the report and adds the versions of all folders but the failed ones to the ledger.
    """
    found = sorted(found, key=lambda row: row["unit"])
    row_of = {row["unit"]: row for row in found}
    accepted = profile_accepts(spark, profile.naming, [row["dated"] for row in found])
    results: dict[str, tuple] = {}
    failures: dict[str, str] = {}

    def attempt(names: Sequence[str]) -> None:
        done = _load(spark, paths, data_type, [row_of[n] for n in names], profile, schema, stamp)
        lines = [(*[row_of[unit][c] for c in ("unit", *VERSION)], outcome, bad, load) for unit, outcome, _, _, bad in done]
        spark.createDataFrame(lines, FOLDER_LEDGER).coalesce(1).write.mode("append").parquet(f"{paths.folder_ledger()}/{data_type}")
        results.update({line[0]: line for line in done})

    for kind in (True, False):
        names = [row["unit"] for row, ok in zip(found, accepted, strict=True) if ok == kind]
        for at in range(0, len(names), FOLDERS_A_JOB):
            failures.update(run_isolated(names[at : at + FOLDERS_A_JOB], attempt))
    report = []
    for unit in row_of:
        if unit in failures:
            report.append((unit, "failed", None, None, None, None, failures[unit]))
        else:
            _, outcome, read, out, bad = results[unit]
            report.append((unit, outcome, read, out, read - out, bad, None))
    return report


def _next_load(ledger: DataFrame) -> int:
    return (ledger.agg(F.max("load")).first()[0] or 0) + 1


def ingest_category(
    spark: SparkSession, paths: FolderPaths, profile: StreamProfile = PII, schemas: Schemas | None = None,
    stamp: Column | None = None, types: Sequence[str] | None = None, parallel: int = 4, glob: str = "*",
) -> DataFrame:
    """Load what is new or has changed in every type of a category and report one row per folder looked into.

    ``types`` restricts the run; else the folders tell which types there are (S-8). ``glob`` restricts the folder names,
    for example to this month's, so that a long history is not listed again. Up to ``parallel`` types are loaded at
    once; a type that fails as a whole does not keep the others from being loaded. Folders are listed without opening a
    file, and only names of folders with another version come to the driver.
    """
    files = file_manifest(spark, f"{paths.category_root()}/*/{glob}", "*.parquet")
    ledger = read_versions(spark, paths.folder_ledger())
    versions = folder_versions(files)
    if types is not None:
        versions = versions.where(F.col("data_type").isin(list(types)))
    of_type: dict[str, list[Row]] = {}
    for row in changed_folders(versions, ledger).collect():
        of_type.setdefault(row["data_type"], []).append(row)
    load = _next_load(ledger)

    def run(data_type: str) -> list[tuple]:
        found = of_type[data_type]
        try:
            return load_folders(spark, paths, data_type, found, load, profile, (schemas or {}).get(data_type), stamp)
        except Exception as error:
            message = str(error).splitlines()[0]
            return [(row["unit"], "failed", None, None, None, None, message) for row in found]

    with ThreadPoolExecutor(max_workers=max(1, parallel)) as pool:
        report = [line for lines in pool.map(run, sorted(of_type)) for line in lines]
    return spark.createDataFrame(report, REPORT)


def ingest_folders(
    spark: SparkSession, paths: FolderPaths, data_type: str, profile: StreamProfile = PII,
    schema: StructType | str | None = None, stamp: Column | None = None, glob: str = "*",
) -> DataFrame:
    """:func:`ingest_category` for one type."""
    schemas = {data_type: schema} if schema is not None else None
    return ingest_category(spark, paths, profile, schemas, stamp, [data_type], 1, glob)


def start_folder_ingest(
    spark: SparkSession, paths: FolderPaths, data_type: str, profile: StreamProfile = PII,
    schema: StructType | str | None = None, stamp: Column | None = None, continuous: str | None = None, files_per_batch: int = 10_000,
) -> StreamingQuery:
    """T-1: the same as a stream: every new file has its whole folder loaded again, unless the ledger is up to date.

    The stream carries file names only; no row is kept between batches. ``files_per_batch`` bounds a batch: a folder
    that two batches share is loaded by each.
    """
    touched = (
        spark.readStream.schema("_none boolean")  # no column is read
        .option("pathGlobFilter", "*.parquet")
        .option("maxFilesPerTrigger", files_per_batch)
        .parquet(paths.folders(data_type))
        .select(F.regexp_extract(row_path(), r"^(.*)/[^/]+$", 1).alias("location"))
    )

    def load(batch: DataFrame, _: int) -> None:
        session = batch.sparkSession
        locations = [row["location"] for row in batch.distinct().collect()]
        if not locations:
            return
        ledger = read_versions(session, paths.folder_ledger())
        files = session.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load([literal(at) for at in locations])
        versions = folder_versions(files.select("path", "length", "modificationTime").where(F.col("length") > 0))
        found = changed_folders(versions, ledger).collect()
        report = load_folders(session, paths, data_type, found, _next_load(ledger), profile, schema, stamp) if found else []
        failed = [line for line in report if line[1] == "failed"]
        if failed:  # the batch is repeated; the folders that were loaded are up to date then
            raise RuntimeError(f"{failed[0][0]}: {failed[0][-1]}")

    writer = touched.writeStream.foreachBatch(load).option("checkpointLocation", f"{paths.checkpoint(data_type)}-folders")
    trigger = {"processingTime": continuous} if continuous else {"availableNow": True}
    return writer.trigger(**trigger).start()
