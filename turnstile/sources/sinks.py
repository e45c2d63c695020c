"""K-1 … K-10: writers, checked writes and materialised results."""

from __future__ import annotations

import datetime as dt
import hashlib
import json
from collections.abc import Mapping, Sequence

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

CHECK_SCHEMA = "path string, n bigint, ok boolean"
# A file holds one row group as a rule, and one task reads that: more files let more tasks read a folder.
ROWS_A_FILE = 250_000


def spread(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Even out a partitioned write: few files per partition value, hot values split over tasks."""
    return df.hint("rebalance", *partition_by) if partition_by else df


def observed(seen: Observation) -> dict[str, int]:
    """What was observed while writing; nothing where Spark saw beforehand that no row would come and left the plan out."""
    try:
        return seen.get
    except Py4JJavaError:
        return {}


def overwrite(df: DataFrame, path: str, fmt: str = "parquet", partition_by: Sequence[str] = ()) -> None:
    """K-1, K-2. Raises on failure."""
    spread(df, partition_by).write.mode("overwrite").partitionBy(*partition_by).format(fmt).save(path)


def append_by_month(df: DataFrame, path: str) -> None:
    """K-3: ``day`` stays a data column."""
    spread(df, ["year", "month"]).write.mode("append").partitionBy("year", "month").parquet(path)


def append_by_day(df: DataFrame, path: str) -> None:
    """K-4."""
    columns = ["year", "month", "day"]
    spread(df, columns).write.mode("append").partitionBy(*columns).parquet(path)


def create_table_as(df: DataFrame, name: str, path: str, partition_by: Sequence[str] = (), sort_by: str | None = None) -> DataFrame:
    """K-5: external snappy parquet table; with ``sort_by`` every file is sorted by that column."""
    rows = spread(df, partition_by)
    (
        (rows.sortWithinPartitions(*partition_by, sort_by) if sort_by else rows)
        .write.mode("overwrite")
        .partitionBy(*partition_by)
        .format("parquet")
        .option("path", path)
        .option("compression", "snappy")
        .saveAsTable(name)
    )
    return df.sparkSession.table(name)


def result_path(root: str, name: str, schema: StructType, params: Mapping[str, object] | None = None) -> str:
    """Folder of one stored result: other names, parameters or columns never share one."""
    key = json.dumps([name, sorted((params or {}).items()), schema.jsonValue()], default=str)
    return f"{root.rstrip('/')}/{hashlib.sha256(key.encode()).hexdigest()[:32]}"


def materialize(
    df: DataFrame,
    root: str,
    name: str,
    max_age: dt.timedelta | None = dt.timedelta(hours=1),
    refresh: bool = False,
    params: Mapping[str, object] | None = None,
) -> DataFrame:
    """K-6, S-10: the stored result ``name`` with ``params`` if it is young enough, else run ``df`` and store it.

    Results live as parquet below ``root``; ``max_age=None`` accepts any age. A query that takes parameters must give
    them as ``params``.
    """
    spark, path = df.sparkSession, result_path(root, name, df.schema, params)
    if refresh or not _is_fresh(spark, path, max_age):
        df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _is_fresh(spark: SparkSession, path: str, max_age: dt.timedelta | None) -> bool:
    try:
        files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    except AnalysisException:
        return False
    age = F.max("modificationTime")
    limit = F.lit(True) if max_age is None else age >= F.current_timestamp() - F.lit(max_age)
    return bool(files.agg(F.coalesce(limit & age.isNotNull(), F.lit(False)).alias("fresh")).first()["fresh"])


def export_csv(df: DataFrame, path: str) -> None:
    """K-7."""
    df.write.mode("overwrite").option("header", True).csv(path)


def write_checked(df: DataFrame, path: str) -> DataFrame:
    """K-8: write, then compare the rows written with the rows found again.

    The rows are counted in the writing stage itself, which Spark accounts once per finished
    partition, so no extra pass runs and repeated tasks are not counted twice.
    """
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("written")).write.mode("overwrite").parquet(path)
    spark, written = df.sparkSession, observed(seen).get("written", 0)
    return (
        spark.read.schema(df.schema)
        .parquet(path)
        .agg(F.count(F.lit(1)).alias("found"))
        .select(
            F.lit(path).alias("path"),
            F.lit(written).cast("bigint").alias("written"),
            "found",
            (F.col("found") == F.lit(written)).alias("ok"),
        )
    )


def verify_paths(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """K-9: rows found per output path; a path that cannot be read is reported, not raised."""
    found = []
    for path in paths:
        try:
            found.append((path, spark.read.option("pathGlobFilter", "*.parquet").parquet(path).count(), True))
        except Exception:
            found.append((path, None, False))
    return spark.createDataFrame(found, CHECK_SCHEMA)


def create_view(df: DataFrame, name: str) -> DataFrame:
    """K-10."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)
