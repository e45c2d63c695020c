"""I-1, K-8, S-2, T-5: raw files to typed parquet, every file accounted for.

Each raw file goes to a partition that bears its full name, ``<target>/<dir>/unit=<name>``, so ``k.1.csv`` and ``k.2.csv``
are two. The ledger is keyed by the file's whole path below the source and holds its length and time of change: a file
that is replaced is converted again. A run returns one outcome for every file it sees, whatever that is; files without a byte
are no files to Spark's listings (S-7).

Types never depend on content. CSV values are text, by each file's own header; JSON values are text unless a schema is
declared; parquet and ORC carry their types. A schema declared for a directory is applied by column name with casts. Rows
that no reader can take apart, or that hold a value the declared type cannot, are not converted but set aside in
``<target>/_rejected/<dir>`` as text, with the reason: as they came, or as JSON where a reader did take them apart.

Files of one directory and format are converted together. Rows per file are counted on both sides, in the raw files and
in what was written, by two grouped counts over all files of a job.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StringType, StructType

from turnstile.functions import clock
from turnstile.schemas import struct_of
from turnstile.sources.manifest import file_name, literal, row_path
from turnstile.sources.readers import FORMAT_BY_EXTENSION
from turnstile.sources.sinks import ROWS_A_FILE, observed, spread
from turnstile.streaming.folders import empty_partitions
from turnstile.streaming.ingest import run_isolated

FILE_LEDGER = "file string, length bigint, changed timestamp, outcome string, load bigint"
FILE_REPORT = "file string, outcome string, rows_read bigint, rows_written bigint, rejected bigint, message string"
UNIT, CORRUPT, REASON = "unit", "_corrupt", "_reason"
FILES_A_JOB = 500


def below(root: str) -> Column:
    return F.substring_index(F.col("path"), root.rstrip("/").split("://")[-1].removeprefix("file:") + "/", -1)


def read_file_ledger(spark: SparkSession, target: str) -> DataFrame:
    """Last outcome of every file; no ledger yet is an empty one."""
    try:
        lines = spark.read.schema(FILE_LEDGER).parquet(f"{target}/_files")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        lines = spark.createDataFrame([], FILE_LEDGER)
    last = F.max_by(F.struct("length", "changed", "outcome", "load"), "load").alias("last")
    return lines.groupBy("file").agg(last).select("file", "last.*")


def file_plan(spark: SparkSession, source: str, target: str) -> DataFrame:
    """What is to be done with each raw file: ``convert``, ``exists`` or ``unsupported``; no file is opened."""
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(source)
    name = file_name(F.col("path"))
    extension = F.when(name.contains("."), F.lower(F.substring_index(name, ".", -1))).otherwise("")
    formats = F.create_map(*[F.lit(part) for pair in FORMAT_BY_EXTENSION.items() for part in pair])
    files = listed.select(
        "path", below(source).alias("file"), F.regexp_extract(below(source), r"^(.*)/[^/]+$", 1).alias("dir"), name.alias("name"),
        "length", F.col("modificationTime").alias("changed"), F.try_element_at(formats, extension).alias("format"),
    )
    ledger = read_file_ledger(spark, target).select("file", F.col("length").alias("was_length"), F.col("changed").alias("was_changed"))
    same = F.col("length").eqNullSafe(F.col("was_length")) & F.col("changed").eqNullSafe(F.col("was_changed"))
    action = F.when(F.col("format").isNull(), "unsupported").when(same, "exists").otherwise("convert").alias("action")
    return files.join(ledger, "file", "left").select("file", "path", "dir", "name", "format", "length", "changed", action)


def read_raw(spark: SparkSession, fmt: str, paths: Sequence[str], declared: StructType | None) -> DataFrame:
    """Rows of files that share a header or schema; ``_corrupt`` holds the text of a row that cannot be taken apart."""
    places = [literal(p) for p in paths]
    text = StructField(CORRUPT, StringType())
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    if fmt == "csv":
        names = spark.read.option("header", True).csv(places).columns
        fields = StructType([StructField(n, StringType()) for n in names] + [text])
        # Files whose header differs from the first one's raise, and are then read on their own.
        return spark.read.options(header=True, enforceSchema=False, **options).schema(fields).csv(places)
    if fmt == "json":
        fields = declared or spark.read.options(primitivesAsString=True, dropFieldIfAllNull=False, **options).json(places).schema
        return spark.read.options(**options).schema(StructType([f for f in fields if f.name != CORRUPT] + [text])).json(places)
    reader = spark.read.option("mergeSchema", True) if fmt == "parquet" else spark.read
    return reader.format(fmt).load(places).withColumn(CORRUPT, F.lit(None).cast("string"))


def typed(rows: DataFrame, declared: StructType | None) -> tuple[list[Column], Column]:
    """Columns under their declared types, and why a row cannot have them (null where it can).

    A declared column that a file lacks is null; further columns stay as they are.
    """
    held = [c for c in rows.columns if c not in (CORRUPT, UNIT)]
    reason = F.when(F.col(CORRUPT).isNotNull(), "unreadable")
    if declared is None:
        return [F.col(f"`{c}`") for c in held], reason
    columns = []
    for field in declared:
        if field.name not in held:
            columns.append(F.lit(None).cast(field.dataType).alias(field.name))
            continue
        raw = F.col(f"`{field.name}`")
        value = raw if rows.schema[field.name].dataType == field.dataType else raw.try_cast(field.dataType)
        columns.append(value.alias(field.name))
        reason = reason.when(raw.isNotNull() & value.isNull(), F.lit(field.name))
    names = {field.name for field in declared}
    return [*columns, *[F.col(f"`{c}`") for c in held if c not in names]], reason


def _write_units(df: DataFrame, path: str) -> None:
    writer = spread(df, [UNIT]).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.option("maxRecordsPerFile", ROWS_A_FILE).partitionBy(UNIT).parquet(path)


def _counts(df: DataFrame, name: Column) -> dict[str, int]:
    """Rows of each file of a job, by one grouped count that reads no column."""
    return {row["name"]: row["n"] for row in df.select(name.alias("name")).groupBy("name").agg(F.count(F.lit(1)).alias("n")).collect()}


def _held(spark: SparkSession, path: str, names: Sequence[str]) -> dict[str, int]:
    try:
        units = spark.read.schema(f"{UNIT} string").parquet(path)
    except AnalysisException:
        return {}
    return _counts(units.where(F.col(UNIT).isin(list(names))), F.col(UNIT))


def _convert(spark: SparkSession, target: str, directory: str, fmt: str, files: Mapping[str, str], declared: StructType | None, stamp: Column | None) -> list[tuple]:
    """Convert ``files`` (path by name) of one directory and compare rows read with rows written and set aside."""
    out, aside, names = f"{target}/{directory}", f"{target}/_rejected/{directory}", sorted(files)
    raw = read_raw(spark, fmt, [files[n] for n in names], declared)
    source = _counts(raw, file_name(row_path()))
    rows = raw.select("*", file_name(row_path()).alias(UNIT))
    columns, reason = typed(rows, declared)
    now = (F.current_timestamp() if stamp is None else stamp).cast(clock.NTZ).alias("processed_time")
    judged, seen = rows.select(*columns, now, UNIT, reason.alias(REASON)), Observation()
    kept = judged.observe(seen, F.count_if(F.col(REASON).isNotNull()).alias("bad")).where(F.col(REASON).isNull()).drop(REASON)
    _write_units(kept, out)
    held = F.to_json(F.struct(*[f"`{c}`" for c in raw.columns if c != CORRUPT]))
    aside_rows = rows.select(F.coalesce(CORRUPT, held).alias("raw"), reason.alias("reason"), UNIT)
    rejected: dict[str, int] = {}
    if observed(seen).get("bad", 0):
        _write_units(aside_rows.where("reason is not null"), aside)
        rejected = _held(spark, aside, names)
        stale = [n for n in names if rejected.get(n) == source.get(n, 0)]
    else:
        stale = [n for n in names if not source.get(n, 0)]
        if old := sorted(_held(spark, aside, names)):
            empty_partitions(aside_rows.drop(UNIT), aside, old)
    if stale := sorted(set(stale) & set(_held(spark, out, stale))):  # rows of an earlier version of the file
        empty_partitions(kept.drop(UNIT), out, stale)
    written = _held(spark, out, names)
    report = []
    for n in names:
        read, wrote, bad = source.get(n, 0), written.get(n, 0), rejected.get(n, 0)
        report.append((n, "converted" if read == wrote + bad else "mismatch", read, wrote, bad))
    return report


def convert_files(
    spark: SparkSession, source: str, target: str, schemas: Mapping[str, StructType | str] | None = None, stamp: Column | None = None
) -> DataFrame:
    """Convert what is new or has changed below ``source``; one row for every file that lies there.

    ``schemas`` declares columns for directories (below ``source``). Outcomes: ``converted``; ``mismatch`` when rows
    read are not found again, written or set aside; ``failed`` with the message, tried again by the next run;
    ``exists`` and ``unsupported``. Only names of files to be converted come to the driver.
    """
    plan = file_plan(spark, source, target)
    declared = {d: struct_of(s) if isinstance(s, str) else s for d, s in (schemas or {}).items()}
    todo = plan.where(F.col("action") == "convert").collect()
    load = (read_file_ledger(spark, target).agg(F.max("load")).first()[0] or 0) + 1
    groups: dict[tuple[str, str], dict] = {}
    for row in todo:
        groups.setdefault((row["dir"], row["format"]), {})[row["name"]] = row

    lines: list[tuple] = []
    for (directory, fmt), rows in sorted(groups.items()):

        def attempt(names: Sequence[str], directory=directory, fmt=fmt, rows=rows) -> None:
            done = _convert(spark, target, directory, fmt, {n: rows[n]["path"] for n in names}, declared.get(directory), stamp)
            ledger = [(rows[n]["file"], rows[n]["length"], rows[n]["changed"], what, load) for n, what, *_ in done]
            spark.createDataFrame(ledger, FILE_LEDGER).coalesce(1).write.mode("append").parquet(f"{target}/_files")
            lines.extend((rows[n]["file"], *rest, None) for n, *rest in done)

        names = sorted(rows)
        for at in range(0, len(names), FILES_A_JOB):
            failures = run_isolated(names[at : at + FILES_A_JOB], attempt)
            lines.extend((rows[n]["file"], "failed", None, None, None, message) for n, message in failures)

    worked = spark.createDataFrame(lines, FILE_REPORT)
    none = [F.lit(None).cast("bigint").alias(c) for c in ("rows_read", "rows_written", "rejected")]
    # The plan names what this run did not touch; files that it converted are in the ledger by now.
    others = plan.join(worked.select("file"), "file", "left_anti").select(
        "file", F.col("action").alias("outcome"), *none, F.lit(None).cast("string").alias("message")
    )
    return worked.unionByName(others)


def read_converted(spark: SparkSession, path: str) -> DataFrame:
    """Rows of one converted directory without the bookkeeping column."""
    return spark.read.option("mergeSchema", True).parquet(path).drop(UNIT)
