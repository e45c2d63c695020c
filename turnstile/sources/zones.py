"""Pruning by event time: which partitions of a stored table can hold a range of times.

Facts and cleaned events are partitioned by the date of the *folder* they came in, and a late folder holds earlier
events; so a condition on event time says nothing about partitions, and every one would be opened. A zone map beside the
table keeps, for each partition, the least and the greatest event time and the version of the files they were read from
(number, bytes, newest change and a fingerprint). A query then reads the partitions whose times overlap its range. A
partition that the map does not know, or knows in another version, is always read: a map that is out of date costs time,
never rows. Within a partition rows are sorted by time, so that the statistics of row groups skip what lies outside.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from turnstile.sources.manifest import file_manifest, literal, row_path
from turnstile.sources.readers import Tables
from turnstile.sources.sinks import spread

VERSION = ("files", "bytes", "newest", "fingerprint")
ZONE_MAP = """partition string, files bigint, bytes bigint, newest timestamp, fingerprint bigint,
    lo timestamp_ntz, hi timestamp_ntz, n bigint, load bigint"""
DIRECTORY = r"^(.*)/[^/]+$"


def zones_path(path: str) -> str:
    return f"{path.rstrip('/')}_zones"


def write_sorted(df: DataFrame, path: str, partition_by: Sequence[str], time: str, dynamic: bool = False) -> None:
    """Overwrite a table (or, with ``dynamic``, the partitions that ``df`` holds) with files sorted by ``time``.

    Partitions are evened out first, hot ones over several files; each file is sorted on its own.
    """
    rows = spread(df, partition_by).sortWithinPartitions(*partition_by, time)
    writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic" if dynamic else "static")
    writer.option("compression", "snappy").partitionBy(*partition_by).parquet(path)
    update_zones(df.sparkSession, path, time)


def partition_versions(spark: SparkSession, path: str) -> DataFrame:
    """Version of every partition, from the listing alone."""
    located = file_manifest(spark, literal(path), "*.parquet").select(
        F.regexp_extract("path", DIRECTORY, 1).alias("partition"), "length", "modificationTime",
        F.xxhash64("path", "length", "modificationTime").alias("print"),
    )
    return located.groupBy("partition").agg(
        F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"), F.max("modificationTime").alias("newest"),
        F.bit_xor("print").alias("fingerprint"),
    )


def read_zones(spark: SparkSession, path: str) -> DataFrame:
    """The last entry of every partition; a table without a map has none."""
    try:
        lines = spark.read.schema(ZONE_MAP).parquet(literal(zones_path(path)))
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        lines = spark.createDataFrame([], ZONE_MAP)
    last = F.max_by(F.struct(*[c for c in lines.columns if c != "partition"]), "load").alias("last")
    return lines.groupBy("partition").agg(last).select("partition", "last.*")


def partition_zones(spark: SparkSession, path: str) -> DataFrame:
    """Every partition there is, with its times where the map knows them in the present version (``known``)."""
    zones = read_zones(spark, path).select("partition", *[F.col(c).alias(f"was_{c}") for c in VERSION], "lo", "hi", "n", "load")
    same = F.lit(True)
    for c in VERSION:
        same = same & F.col(c).eqNullSafe(F.col(f"was_{c}"))
    rows = partition_versions(spark, path).join(zones, "partition", "left")
    return rows.select("partition", *VERSION, same.alias("known"), "lo", "hi", "n", "load")


def update_zones(spark: SparkSession, path: str, time: str) -> None:
    """Bring the map up to date: only partitions of another version are looked into, and of them one column.

    The version is taken before the times are read, so an entry can be older than its times but never newer.
    """
    zones = partition_zones(spark, path)
    stale = zones.where(~F.col("known")).collect()
    if not stale:
        return
    load = (zones.agg(F.max("load")).first()[0] or 0) + 1
    rows = spark.read.schema(f"`{time}` timestamp_ntz").option("recursiveFileLookup", True).parquet(*[literal(r["partition"]) for r in stale])
    times = rows.select(F.regexp_extract(row_path(), DIRECTORY, 1).alias("found"), F.col(f"`{time}`").alias("time")).groupBy("found").agg(
        F.min("time").alias("lo"), F.max("time").alias("hi"), F.count(F.lit(1)).alias("n")
    )
    versions = spark.createDataFrame([(r["partition"], *[r[c] for c in VERSION]) for r in stale], ", ".join(ZONE_MAP.split(",")[:5]))
    # Listings and rows may spell the scheme of one path differently.
    plain = lambda c: F.regexp_replace(c, r"^file:/+", "/")
    lines = versions.join(times, plain(F.col("partition")) == plain(F.col("found")), "left")
    lines.select(*versions.columns, "lo", "hi", "n", F.lit(load).cast("bigint").alias("load")).coalesce(1).write.mode("append").parquet(zones_path(path))


def read_between(
    spark: SparkSession, path: str, time: str, start: Column | None = None, end: Column | None = None, schema: StructType | str | None = None
) -> DataFrame:
    """Rows of the partitions that can hold times from ``start`` up to, not including, ``end``.

    Rows outside the range may be among them: the query's own condition stays. Only names of chosen partitions come to
    the driver. ``start`` and ``end`` are constants.
    """
    hit = F.lit(True)
    if start is not None:
        hit = hit & (F.col("hi") >= start)
    if end is not None:
        hit = hit & (F.col("lo") < end)
    # A known partition without any time has neither bound, and no row that the range could hold.
    chosen = partition_zones(spark, path).where(~F.col("known") | F.coalesce(hit, F.lit(False)))
    places = sorted(row["partition"] for row in chosen.select("partition").collect())
    reader = spark.read if schema is None else spark.read.schema(schema)
    reader = reader.option("basePath", path)
    return reader.parquet(*[literal(p) for p in places]) if places else reader.parquet(literal(path)).where(F.lit(False))


class ZonedTables(Tables):
    """Tables of which some are stored with a zone map; queries that ask for a range of times read only what can hold it."""

    def __init__(self, spark: SparkSession, builders: Mapping[str, Callable[[], DataFrame]], zoned: Mapping[str, str]):
        super().__init__(builders)
        self._spark, self._zoned = spark, dict(zoned)

    def between(self, name: str, time: str, start: Column | None = None, end: Column | None = None) -> DataFrame:
        if name not in self._zoned:
            return self[name]
        return read_between(self._spark, self._zoned[name], time, start, end, self[name].schema)


def zoned_tables(spark: SparkSession, tables: Mapping[str, DataFrame], paths: Mapping[str, str]) -> ZonedTables:
    """``tables`` with those named in ``paths`` read from there."""
    builders = {name: (lambda name=name: tables[name]) for name in tables}
    stored = {name: (lambda path=path: spark.read.parquet(literal(path))) for name, path in paths.items()}
    return ZonedTables(spark, builders | stored, paths)


def rows_between(tables: Mapping[str, DataFrame], name: str, time: str, start: Column | None = None, end: Column | None = None) -> DataFrame:
    """Rows of a table with at least those of the range; all of them where the table has no zone map."""
    pick = getattr(tables, "between", None)
    return pick(name, time, start, end) if pick else tables[name]
