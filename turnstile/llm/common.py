"""What several operators share: words, tables that cut lineage, block-wise Python columns."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from xxhash import xxh64_intdigest

from turnstile.session import scratch_path

# White space that ends a word.
BLANKS = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared scratch folder and read again: cuts lineage and survives lost executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    again = df.sparkSession.read.schema(df.schema).parquet(path)
    again.stored_at = path
    return again


def discard(*tables: DataFrame) -> None:
    """Delete tables that :func:`stored` wrote and nothing that is still to run reads."""
    for table in tables:
        spark = table.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(table.stored_at)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def split_words(text: str | None) -> list[bytes]:
    """Words as UTF-8; ``bytes.split`` splits at exactly the six characters of :data:`BLANKS`."""
    return text.encode("utf-8", "surrogatepass").split() if text else []


def word_hashes(words: list[bytes]) -> np.ndarray:
    """64-bit digests of words, the same on every machine."""
    return np.fromiter(map(xxh64_intdigest, words), dtype=np.uint64, count=len(words))


def run_hashes(hashes: np.ndarray, length: int) -> np.ndarray:
    """64-bit digests of every run of ``length`` consecutive words, in order."""
    n = len(hashes) - length + 1
    mixed = np.zeros(max(n, 0), dtype=np.uint64)
    for k in range(length if n > 0 else 0):
        mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + hashes[k : k + n]
    return mixed ^ (mixed >> np.uint64(32))


def per_text(work: Callable[[str | None], tuple], schema: str) -> Callable[[Column], Column]:
    """A struct column computed from each whole text by ``work``; null texts arrive as ``None``."""
    names = [part.split()[0] for part in schema.split(", ")]

    @F.pandas_udf(schema)
    def column(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            yield pd.DataFrame([work(text if isinstance(text, str) else None) for text in texts], columns=names)

    return column


def doc_columns(docs: DataFrame, *names: str) -> DataFrame:
    """Only the columns an operator reads, so that extra columns can clash with nothing it adds."""
    return docs.select(*[F.col(f"`{name}`") for name in names])
