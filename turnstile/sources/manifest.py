"""S-7, S-8, I-2 … I-5: which files and folders there are, and which are new.

A *unit* is one dated folder ``<category>/<type>/<type>_<YYYYMMDD>``. Manifests are DataFrames built
from the binary file source with its content column pruned, so no file is opened.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from turnstile.schemas import LEDGER

# Bytes of input files for one partition of a grouping, and below which an input is not dealt anew.
PART_BYTES = 4 << 20
SMALL_BYTES = 32 << 20


def file_manifest(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """S-7: path, length and modification time of every non-empty file below ``path``."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(path).select("path", "length", "modificationTime").where(F.col("length") > 0)


def row_path() -> Column:
    """Path of the file a row was read from, spelled as in a manifest: Spark encodes it in ``_metadata``.

    This runs for every row, so a path that holds nothing encoded, as nearly all do, is left as it is.
    """
    path = F.col("_metadata.file_path")
    decoded = F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))
    return F.when(path.contains("%"), decoded).otherwise(path)


def literal(path: str) -> str:
    """``path`` for a reader, where brackets, braces, stars and question marks would be patterns."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", path)


def file_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def _above(path: Column, levels: int) -> Column:
    """The name ``levels`` above the file, empty for a shorter path. No pattern: these run for every row."""
    tail = F.substring_index(path, "/", -levels - 1)
    return F.when(tail != path, F.substring_index(tail, "/", 1)).otherwise("")


def input_bytes(df: DataFrame) -> int:
    """Bytes of the files that ``df`` reads; 0 where it reads none. No file is opened."""
    files = df.inputFiles()
    if not files:
        return 0
    listed = df.sparkSession.read.format("binaryFile").load([literal(unquote(f)) for f in files])
    return listed.agg(F.sum("length")).first()[0] or 0


def in_parts(df: DataFrame, *keys: str) -> DataFrame:
    """Large inputs dealt by ``keys`` to partitions whose number follows the bytes read.

    A task then holds as much however large the input is; the number of partitions that a session fixes, or those that
    are coalesced, would let it grow. Inputs below ``SMALL_BYTES`` stay as they are.
    """
    size = input_bytes(df)
    return df.repartition(-(-size // PART_BYTES), *keys) if size >= SMALL_BYTES else df


def folder_of(path: Column) -> Column:
    """Name of the folder that holds a file; the ``unit=`` prefix of converted folders is dropped."""
    name = _above(path, 1)
    return F.when(name.startswith("unit=") & (name != "unit="), F.substring(name, 6, 1 << 30)).otherwise(name)


def type_of(path: Column) -> Column:
    return _above(path, 2)


def category_of(path: Column) -> Column:
    return _above(path, 3)


@dataclass(frozen=True)
class FolderNaming:
    """How a dated folder name is read.

    ``default_day`` replaces a missing date token. ``whole_token`` asks for a token of exactly eight
    digits, otherwise eight leading digits are enough.
    """

    default_day: str | None
    whole_token: bool

    def day_text(self, folder: Column) -> Column:
        """Eight digits, or null where the name cannot be read."""
        token = F.get(F.split(folder, "_"), 1)
        if self.default_day is not None:
            token = F.coalesce(F.nullif(token, F.lit("")), F.lit(self.default_day))
        pattern = r"^\d{8}$" if self.whole_token else r"^\d{8}"
        return F.when(token.rlike(pattern), F.substring(token, 1, 8))

    def is_valid(self, folder: Column) -> Column:
        return self.day_text(folder).isNotNull()


# I-4 (strict names) and I-5 (missing date token means this day).
STRICT_NAMING = FolderNaming(default_day=None, whole_token=True)
LENIENT_NAMING = FolderNaming(default_day="20250501", whole_token=False)


def units(files: DataFrame, naming: FolderNaming) -> DataFrame:
    """S-8: one row per dated folder with its location and its day (null for a name not accepted)."""
    path = F.col("path")
    return (
        files.select(
            category_of(path).alias("category"),
            type_of(path).alias("data_type"),
            folder_of(path).alias("folder"),
            F.regexp_extract(path, r"^(.*)/[^/]+$", 1).alias("location"),
        )
        .distinct()
        .select(
            "*",
            F.concat_ws("/", "category", "data_type", "folder").alias("unit"),
            naming.day_text(F.col("folder")).alias("day_text"),
        )
    )


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """I-2, I-3: the units finished so far; a ledger that does not exist yet is an empty one."""
    spark.createDataFrame([], LEDGER).write.mode("ignore").parquet(path)
    return spark.read.schema(LEDGER).parquet(path)


def pending(candidates: DataFrame, ledger: DataFrame) -> DataFrame:
    """I-2, I-3: candidates that the ledger does not list."""
    return candidates.join(ledger.select("unit"), "unit", "left_anti")
