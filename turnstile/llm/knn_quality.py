"""Quality by nearest-neighbour voting among labelled documents in a latent-semantic space.

A text's terms are its byte trigrams, hashed to :data:`DIMENSIONS` places, with logarithmic counts weighted by inverse
document frequency over all documents. A truncated SVD of a sample of at most ``max_labelled`` labelled documents
gives the latent space; their vectors and labels are broadcast, at most ``max_labelled`` x :data:`RANK` numbers. Every
document is compared with all of them, block by block, and the labels of the nearest vote with the cosine's power.

Only rows with a quality label whose crc32(doc_id as text) is not divisible by five are learnt from, in the order of a
hash of doc_id; several labels of a doc_id count as their greatest. Without labels every score is 0.5. A null or empty
text has no direction and gets the share of label 1 in the sample. Repeated rows get equal scores; rows without doc_id
are scored and never held out. Columns other than doc_id and text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turnstile.llm.common import doc_columns

DIMENSIONS = 4096
RANK = 48
MAX_LABELLED = 4000
NEIGHBOURS = 15
POWER = 8
THRESHOLD = 0.3
BLOCK = 256
FOLDS = 5


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def term_counts(text: str | None) -> np.ndarray:
    """How often each hashed byte trigram occurs in the whole text."""
    raw = np.frombuffer((text or "").encode("utf-8", "surrogatepass"), dtype=np.uint8).astype(np.uint32)
    if len(raw) < 3:
        return np.zeros(DIMENSIONS, dtype=np.int64)
    code = (raw[:-2] << 16 | raw[1:-1] << 8 | raw[2:]) * np.uint32(2654435761)
    return np.bincount(code >> np.uint32(20), minlength=DIMENSIONS)


def document_frequencies(docs: DataFrame) -> tuple[np.ndarray, int]:
    """Documents with each term, and all documents: counted in every task, then summed."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(DIMENSIONS + 1, dtype=np.int64)
        for batch in batches:
            for text in batch.column(0):
                seen[:-1] += term_counts(text.as_py()) > 0
            seen[-1] += len(batch)
        yield pa.record_batch([pa.array(np.arange(DIMENSIONS + 1)), pa.array(seen)], names=["term", "n"])

    totals = docs.select("text").mapInArrow(counted, "term long, n long").groupBy("term").agg(F.sum("n")).collect()
    found = np.zeros(DIMENSIONS + 1, dtype=np.int64)
    for term, n in totals:
        found[term] = n
    return found[:-1], int(found[-1])


def sample_counts(docs: DataFrame, labels: DataFrame, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Term counts and labels of at most ``most`` labelled documents."""
    usable = labels.filter(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    chosen = usable.groupBy("doc_id").agg(F.max("quality").alias("quality")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = [np.minimum(term_counts(t.as_py()), 65535).astype(np.uint16).tobytes() for t in batch.column(1)]
            yield pa.record_batch([batch.column(0), batch.column(2), pa.array(counts, pa.binary())], names=["doc_id", "quality", "counts"])

    joined = docs.join(F.broadcast(chosen.withColumn("quality", F.col("quality").cast("int"))), "doc_id")
    rows = joined.select("doc_id", "text", "quality").mapInArrow(counted, "doc_id long, quality int, counts binary")
    one_each = rows.groupBy("doc_id").agg(F.max(F.struct("counts", "quality")).alias("row")).orderBy("doc_id").select("row.*").collect()
    counts = np.array([np.frombuffer(r.counts, np.uint16) for r in one_each]).reshape(-1, DIMENSIONS)
    return counts, np.array([r.quality for r in one_each], dtype=np.float32)


@dataclass
class Voters:
    weights: np.ndarray  # of terms
    axes: np.ndarray  # DIMENSIONS x RANK
    vectors: np.ndarray  # of labelled documents, of length 1
    labels: np.ndarray

    def place(self, counts: np.ndarray) -> np.ndarray:
        found = unit(np.log1p(counts.astype(np.float32)) * self.weights) @ self.axes
        return unit(found)

    def vote(self, counts: np.ndarray) -> np.ndarray:
        """Score of each row of term counts: exact cosines with every labelled vector."""
        prior = float(self.labels.mean()) if len(self.labels) else 0.5
        if not len(self.labels):
            return np.full(len(counts), prior)
        cosines = self.place(counts) @ self.vectors.T
        k = min(NEIGHBOURS, cosines.shape[1])
        nearest = np.argpartition(-cosines, k - 1, axis=1)[:, :k]
        votes = np.maximum(np.take_along_axis(cosines, nearest, axis=1), 0).astype(np.float64) ** POWER
        total = votes.sum(axis=1)
        ones = (votes * self.labels[nearest]).sum(axis=1)
        return np.where(total > 0, np.clip(ones / np.where(total > 0, total, 1), 0, 1), prior)


def unit(rows: np.ndarray) -> np.ndarray:
    length = np.sqrt((rows * rows).sum(axis=1, keepdims=True))
    return rows / np.where(length > 0, length, 1)


def principal_axes(rows: np.ndarray, rank: int, rounds: int = 4) -> np.ndarray:
    """Leading right singular vectors by subspace iteration from a fixed start."""
    basis = np.random.default_rng(7).standard_normal((rows.shape[1], rank + 16)).astype(np.float32)
    for _ in range(rounds):
        basis, _ = np.linalg.qr(rows.T @ (rows @ basis))
    left = rows @ basis
    _, _, turn = np.linalg.svd(left.T @ left)
    return (basis @ turn.T[:, :rank]).astype(np.float32)


def fit(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED) -> Voters:
    docs = doc_columns(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), "text")
    frequencies, n = document_frequencies(docs)
    weights = np.log((1 + n) / (1 + frequencies)).astype(np.float32)
    counts, quality = sample_counts(docs, labels, max_labelled)
    if not len(counts):
        return Voters(weights, np.zeros((DIMENSIONS, RANK), np.float32), np.zeros((0, RANK), np.float32), quality)
    rows = unit(np.log1p(counts.astype(np.float32)) * weights)
    voters = Voters(weights, principal_axes(rows, RANK), np.zeros(0), quality)
    voters.vectors = voters.place(counts)
    return voters


def score_documents(docs: DataFrame, voters: Voters) -> DataFrame:
    """doc_id and score of every row of ``docs``. The voters travel with the function, which Spark broadcasts."""

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, len(batch), BLOCK):
                part = batch.slice(i, BLOCK)
                scores = voters.vote(np.array([term_counts(t.as_py()) for t in part.column(1)]))
                yield pa.record_batch([part.column(0), pa.array(scores, pa.float64())], names=["doc_id", "score"])

    columns = doc_columns(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), "text")
    return columns.mapInArrow(scored, "doc_id long, score double")


def quality_report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    scores = score_documents(docs, fit(docs, labels))
    return scores.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
