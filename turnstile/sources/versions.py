"""K-6, S-10: results that are replaced as a whole, by a pointer.

A version is written to a folder of its own and becomes current when one line is added to the pointer table, which is
one file moved into place. A reader takes the newest line and sees that version whole, or the one before. What a crash
leaves behind before the pointer is never read; :func:`remove_old` clears it away.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from turnstile.sources.manifest import file_manifest, literal, row_path
from turnstile.sources.sinks import result_path

POINTER = "number bigint, folder string, upto bigint, published timestamp"


def pointer_path(root: str) -> str:
    return f"{root.rstrip('/')}/_current"


def current(spark: SparkSession, root: str) -> Row | None:
    """The newest line of the pointer; ``None`` where nothing was published."""
    try:
        lines = spark.read.schema(POINTER).parquet(literal(pointer_path(root)))
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return lines.orderBy(F.desc("number"), F.desc("published"), F.desc("folder")).first()


def publish(df: DataFrame, root: str, upto: int | None = None) -> str:
    """Write ``df`` as a new version and make it current; ``upto`` is kept with it. Returns its folder."""
    spark, folder = df.sparkSession, f"data-{uuid.uuid4().hex}"
    df.write.parquet(f"{root}/{folder}")
    point(spark, root, folder, upto)
    return folder


def point(spark: SparkSession, root: str, folder: str, upto: int | None = None) -> None:
    before = current(spark, root)
    line = spark.createDataFrame([((before["number"] if before else 0) + 1, folder, upto)], "number bigint, folder string, upto bigint")
    line.withColumn("published", F.current_timestamp()).coalesce(1).write.mode("append").parquet(pointer_path(root))


def read_current(spark: SparkSession, root: str, schema: StructType | str | None = None) -> DataFrame | None:
    line = current(spark, root)
    if line is None:
        return None
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(literal(f"{root}/{line['folder']}"))


def keep_result(
    df: DataFrame,
    root: str,
    name: str,
    max_age: dt.timedelta | None = dt.timedelta(hours=1),
    refresh: bool = False,
    params: Mapping[str, object] | None = None,
) -> DataFrame:
    """The stored result ``name`` with ``params`` if it is young enough, else ``df``, run and stored.

    ``max_age=None`` accepts any age. Only whole results count, by the time they became current; readers of the version
    before are not disturbed by a refresh.
    """
    spark, place = df.sparkSession, result_path(root, name, df.schema, params)
    line = None if refresh else current(spark, place)
    if line is not None and max_age is not None:
        limit = F.lit(line["published"]) >= F.current_timestamp() - F.lit(max_age)
        line = line if spark.range(1).select(limit.alias("young")).first()["young"] else None
    if line is None:
        publish(df, place)
    return read_current(spark, place, df.schema)


def remove_old(spark: SparkSession, root: str, older_than: dt.timedelta = dt.timedelta(days=1)) -> None:
    """Delete versions other than the current one, with their pointer lines, whose files are older than ``older_than``.

    Readers that began before a version was replaced have that long to finish.
    """
    line = current(spark, root)
    if line is None:
        return
    files = file_manifest(spark, literal(root)).where(F.col("modificationTime") < F.current_timestamp() - F.lit(older_than))
    folder = F.regexp_extract("path", r"/(data-[0-9a-f]{32})/[^/]+$", 1)
    versions = {r["folder"] for r in files.select(folder.alias("folder")).distinct().collect()} - {"", line["folder"]}
    lines = spark.read.schema(POINTER).parquet(literal(pointer_path(root)))
    passed = lines.where(F.col("folder").isin(list(versions)) & (F.col("number") < line["number"])).select(row_path().alias("file"))
    gone = [r["file"] for r in passed.distinct().collect()] + [f"{root}/{v}" for v in sorted(versions)]
    paths = spark._jvm.org.apache.hadoop.fs.Path
    for at in gone:
        path = paths(at)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
