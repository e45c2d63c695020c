"""S-1 … S-6, S-9 … S-11: tables from files and from the catalogue."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

# File extensions and the reader each one selects.
FORMAT_BY_EXTENSION = {
    "csv": "csv",
    "txt": "csv",
    "json": "json",
    "jsonl": "json",
    "parquet": "parquet",
    "orc": "orc",
}

Paths = str | Sequence[str]


def extension_of(path: str) -> str:
    name = path.rstrip("/").rsplit("/", 1)[-1]
    return name.rsplit(".", 1)[1].lower() if "." in name else ""


def _load(spark: SparkSession, fmt: str, paths: Paths, schema: StructType | str | None, **options) -> DataFrame:
    reader = spark.read.format(fmt).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(paths if isinstance(paths, str) else list(paths))


def read_csv(spark: SparkSession, paths: Paths, schema=None, header: bool | None = None) -> DataFrame:
    """S-2. ``header=None`` expects a header and reads again without one if that attempt fails.

    Files read together under an inferred schema must agree in their headers; Spark raises when one
    does not, instead of taking its columns by position.
    """

    def attempt(with_header: bool) -> DataFrame:
        inferred = schema is None
        return _load(spark, "csv", paths, schema, header=with_header, inferSchema=inferred, enforceSchema=not inferred)

    if header is not None:
        return attempt(header)
    try:
        return attempt(True)
    except Exception:
        return attempt(False)


def read_json(spark: SparkSession, paths: Paths, schema=None) -> DataFrame:
    """S-3: one object per line."""
    return _load(spark, "json", paths, schema)


def read_parquet(spark: SparkSession, paths: Paths, schema=None, glob: str | None = None) -> DataFrame:
    """S-4; with ``glob`` only matching file names (S-6)."""
    options = {"pathGlobFilter": glob} if glob else {}
    return _load(spark, "parquet", paths, schema, **options)


def read_orc(spark: SparkSession, paths: Paths, schema=None) -> DataFrame:
    """S-5."""
    return _load(spark, "orc", paths, schema)


READERS: dict[str, Callable[..., DataFrame]] = {
    "csv": read_csv,
    "json": read_json,
    "parquet": read_parquet,
    "orc": read_orc,
}


def read_any(spark: SparkSession, path: str, fmt: str | None = None, schema=None) -> DataFrame | None:
    """S-1: reader chosen by the lower-cased extension; ``None`` where no reader knows it."""
    chosen = fmt or FORMAT_BY_EXTENSION.get(extension_of(path))
    return READERS[chosen](spark, path, schema) if chosen else None


def register_file(spark: SparkSession, name: str, path: str, fmt: str | None = None) -> DataFrame:
    """S-11: make a user's own file queryable under ``name``."""
    df = read_any(spark, path, fmt)
    if df is None:
        raise ValueError(f"no reader for {path}")
    df.createOrReplaceTempView(name)
    return df


class Tables(Mapping):
    """Tables by name, each built on first use, so a query only plans what it reads."""

    def __init__(self, builders: Mapping[str, Callable[[], DataFrame]]):
        self._builders = dict(builders)
        self._built: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            self._built[name] = self._builders[name]()
        return self._built[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._builders)

    def __len__(self) -> int:
        return len(self._builders)

    def with_tables(self, **builders: Callable[[], DataFrame]) -> Tables:
        return Tables({**self._builders, **builders})

    def register(self) -> None:
        """K-10: a temporary view per table."""
        for name in self:
            self[name].createOrReplaceTempView(name)


def catalog_tables(spark: SparkSession, names: Sequence[str], database: str | None = None) -> Tables:
    """S-9: tables of the session catalogue, optionally of one database."""
    prefix = f"{database}." if database else ""
    return Tables({name: (lambda full=prefix + name: spark.table(full)) for name in names})
