"""Cost-balanced packing of token documents into sequences of bounded length.

The cost of a sequence is linear in its tokens plus quadratic in each piece's own length, as attention within the
piece takes it. Every task packs groups of about :data:`GROUP_TOKENS` tokens of the rows it reads: whole sequences
are cut off documents that reach the capacity, then the other pieces go, longest first, to the sequence of lowest
cost that has room for them. There are just as many sequences as the group's tokens fill; a piece for which none has
room is cut, so that a group leaves less than one sequence of padding. Nothing is shuffled
and a task holds one group, however large the table or a document group is.

Null and empty texts are one end id. Every row is packed on its own, also repeated ones and those without doc_id.
An empty table gives no pieces.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turnstile.llm.common import doc_columns
from turnstile.llm.tokens import word_bpe

CAPACITY = 4096
END_ID = 2
GROUP_TOKENS = 1 << 20
LINEAR, QUADRATIC = 1.0, 1.0 / 2048

SCHEMA = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"


def attention_cost(length: int, linear: float = LINEAR, quadratic: float = QUADRATIC) -> float:
    return linear * length + quadratic * length * length


def pack(sizes: list[int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int]]:
    """(document, start, length, sequence, offset) of pieces of documents with ``sizes`` tokens, all above 0."""
    placed, queue, sequence = [], [], 0
    for doc, size in enumerate(sizes):
        whole = size // capacity
        for k in range(whole):
            placed.append((doc, k * capacity, capacity, sequence, 0))
            sequence += 1
        if size % capacity:
            queue.append((-(size % capacity), doc, whole * capacity))
    heapq.heapify(queue)
    n = -(-sum(-size for size, _, _ in queue) // capacity)
    room, costs = np.full(n, capacity, dtype=np.int64), np.zeros(n)
    while queue:
        size, doc, start = heapq.heappop(queue)
        size = -size
        fits = room >= size
        s = int(np.where(fits, costs, np.inf).argmin()) if fits.any() else int(room.argmax())
        length = min(size, int(room[s]))
        placed.append((doc, start, length, sequence + s, capacity - int(room[s])))
        room[s] -= length
        costs[s] += attention_cost(length)
        if length < size:  # no sequence has that much room left: the one with most takes a part
            heapq.heappush(queue, (length - size, doc, start + length))
    return placed


def pack_documents(
    docs: DataFrame, vocabulary: str | None = None, capacity: int = CAPACITY, group_tokens: int = GROUP_TOKENS
) -> DataFrame:
    """One row per piece, with its ids as little-endian unsigned 32-bit integers."""

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, sequence = word_bpe(vocabulary), TaskContext.get().partitionId() << 32
        ids_held, docs_held, tokens = [], [], 0

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal ids_held, docs_held, tokens, sequence
            pieces = pack([len(ids) for ids in ids_held], capacity)
            for i in range(0, len(pieces), 2000):
                some = pieces[i : i + 2000]
                doc, start, length, at, offset = map(list, zip(*some))
                yield pa.record_batch(
                    [
                        pa.array([docs_held[d] for d in doc], pa.int64()),
                        pa.array(start, pa.int64()),
                        pa.array(length, pa.int64()),
                        pa.array([ids_held[d][b : b + n].astype("<u4").tobytes() for d, b, n, _, _ in some], pa.binary()),
                        pa.array([len(ids_held[d]) for d in doc], pa.int64()),
                        pa.array([sequence + s for s in at], pa.int64()),
                        pa.array(offset, pa.int64()),
                    ],
                    names=["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"],
                )
            sequence += 1 + max((p[3] for p in pieces), default=-1)
            ids_held, docs_held, tokens = [], [], 0

        for batch in batches:
            at, doc_ids = 0, batch.column(0).to_pylist()
            for ids, bounds in encoder.encode(batch.column(1)):
                for b, e in zip(bounds[:-1], bounds[1:]):
                    ids_held.append(np.append(ids[b:e], np.array([END_ID], "<u2")))
                    docs_held.append(doc_ids[at])
                    at, tokens = at + 1, tokens + int(e - b) + 1
                    if tokens >= group_tokens:
                        yield from flush()
        yield from flush()

    columns = doc_columns(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), "text")
    return columns.mapInArrow(packed, SCHEMA)


def piece_report(docs: DataFrame) -> DataFrame:
    """The packing of ``docs`` with a digest in place of each piece's ids."""
    return pack_documents(docs).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )
