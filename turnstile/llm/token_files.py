"""Token ids of whole documents in files of range-coded blocks, in ascending order of doc_id.

Texts are dealt to tasks by ranges of doc_id, encoded there with a public vocabulary, closed with an end id, and cut
into segments of whole documents: one row of a Parquet table each, with the documents' ids and lengths, where the
segment starts among its task's ids, and its independently coded, checksummed blocks (``range_coder``). A reader needs
only one segment at a time. A task holds one segment, however many rows it has.

Null and empty texts are the end id alone. Rows without doc_id come first; rows of equal doc_id follow each other in
the order of a digest of their text. An empty table gives empty files. Other columns are never read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from turnstile.llm.common import doc_columns
from turnstile.llm.range_coder import BLOCK_IDS, decode_segment, encode_segment
from turnstile.llm.tokens import byte_bpe
from turnstile.session import scratch_path

END_ID = 2
SEGMENT_IDS = 2048 * BLOCK_IDS

FILE_SCHEMA = (
    "part int, segment int, start long, n_ids long, doc_ids array<long>, lengths array<long>, "
    "blocks array<binary>, checksums array<long>"
)


def write_token_files(docs: DataFrame, path: str, vocabulary: str | None = None, segment_ids: int = SEGMENT_IDS) -> None:
    """Writes the ids of every row of ``docs`` below ``path``."""

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part = byte_bpe(vocabulary), TaskContext.get().partitionId()
        segment, start, held, lengths, doc_ids, size = 0, 0, [], [], [], 0

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal segment, start, held, lengths, doc_ids, size
            if doc_ids:
                blocks, sums = encode_segment(np.concatenate(held))
                row = [part, segment, start, size, doc_ids, lengths, blocks, sums]
                kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.binary()), pa.list_(pa.int64())]
                names = ["part", "segment", "start", "n_ids", "doc_ids", "lengths", "blocks", "checksums"]
                yield pa.record_batch([pa.array([v], k) for v, k in zip(row, kinds)], names=names)
            segment, start = segment + 1, start + size
            held, lengths, doc_ids, size = [], [], [], 0

        for batch in batches:
            at, known = 0, batch.column(0).to_pylist()
            for ids, bounds in encoder.encode(batch.column(1)):
                ids, bounds = np.insert(ids, bounds[1:], END_ID), (bounds + np.arange(len(bounds))).tolist()
                for b, e in zip(bounds[:-1], bounds[1:]):
                    if size and size + e - b > segment_ids:
                        yield from flush()
                    held.append(ids[b:e])
                    doc_ids.append(known[at])
                    lengths.append(e - b)
                    at, size = at + 1, size + e - b
        yield from flush()

    ordered = (
        doc_columns(docs, "doc_id", "text")
        .select(F.col("doc_id").cast("long"), "text", F.xxhash64("text").alias("digest"))
        .repartitionByRange("doc_id", "digest")
        .sortWithinPartitions("doc_id", "digest")
    )
    ordered.select("doc_id", "text").mapInArrow(encoded, FILE_SCHEMA).write.parquet(path)


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """Per document: doc_id, start (ids of all documents before it), n_tokens and ids (little-endian 32-bit)."""
    files = spark.read.schema(FILE_SCHEMA).parquet(path)
    bases, base = {}, 0
    for part, n in sorted(files.groupBy("part").agg(F.sum("n_ids")).collect()):  # one row per writing task
        bases[part], base = base, base + n

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                (row,) = batch.slice(at, 1).to_pylist()
                ids = decode_segment(row["blocks"], row["checksums"], row["n_ids"]).astype("<u4")
                bounds = np.concatenate([[0], np.cumsum(row["lengths"])])
                for i in range(0, len(bounds) - 1, 1000):
                    some, near = slice(i, i + 1000), bounds[i : i + 1001]
                    offsets = pa.py_buffer(((near - near[0]) * 4).astype("<i4"))
                    columns = [
                        pa.array(row["doc_ids"][some], pa.int64()),
                        pa.array(near[:-1] + row["start"] + bases[row["part"]], pa.int64()),
                        pa.array(row["lengths"][some], pa.int64()),
                        pa.Array.from_buffers(pa.binary(), len(near) - 1, [None, offsets, pa.py_buffer(ids[near[0] : near[-1]])]),
                    ]
                    yield pa.record_batch(columns, names=["doc_id", "start", "n_tokens", "ids"])

    columns = files.select("part", "start", "n_ids", "doc_ids", "lengths", "blocks", "checksums")
    return columns.mapInArrow(decoded, "doc_id long, start long, n_tokens long, ids binary")


def token_report(docs: DataFrame) -> DataFrame:
    """Writes token files of ``docs`` to the shared scratch folder and reads them back."""
    path = scratch_path(docs.sparkSession, "token-files")
    write_token_files(docs, path)
    return read_token_files(docs.sparkSession, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
