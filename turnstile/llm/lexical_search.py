"""Ranked lexical search: best-first intervals of documents, bounded by range-maximum queries on posting lists.

Two passes over the documents. The first counts the query terms of each text and stores them packed, one row a document;
document and term counts follow from that table. In the second, every task cuts its documents into segments of bounded
size and builds each segment's posting lists (documents by doc_id, with the impact of the term on their score) with a
sparse table of range maxima over all of them. An item starts with one interval, the whole segment, whose bound is the
sum over its terms of the largest impact there. The intervals of highest bound are split first, each at the document
where a term has its maximum impact; that document is scored in full, the parts before and behind it get bounds of their
own from two lookups a term, and parts that cannot reach the item's 50th best score are dropped. Many intervals are
split at once, as one array operation. Best scores go on from segment to segment within a task; tasks' best are ranked last.

Items are worked off in blocks of at most about ``BLOCK_TERMS`` terms, which go to the tasks with the code; more items
make more blocks, each a pass over all documents. No text and no posting list is gathered by term, so a term in every
document is as good as any other.

Defined results: null texts and texts without a term are no documents; items without a term find nothing. Documents that
repeat count and are ranked each; items that repeat with item_id and text are answered once. Rows without doc_id come last
among equal scores. Empty tables give an empty result.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from turnstile.llm.common import stored

# A-Z to lower case; all other ASCII characters that are no letters or digits part terms.
SEPARATORS = bytes(b if 48 <= b <= 57 or 97 <= b <= 122 or b > 127 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))
BLOCK_TERMS = 1 << 18
SEGMENT_POSTINGS, SEGMENT_DOCS = 1 << 20, 1 << 15
AT_ONCE = 512
NO_ID = np.iinfo(np.int64).max


def terms_of(text: bytes | None) -> list[bytes]:
    return text.translate(SEPARATORS).split() if text else []


def item_terms(items: DataFrame) -> DataFrame:
    """Distinct terms of every different item that has any."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            terms = [sorted(set(terms_of(t))) for t in batch.column("text").cast(pa.binary()).to_pylist()]
            columns = [batch.column("item_id"), batch.column("digest"), pa.array(terms, type=pa.list_(pa.binary()))]
            yield pa.RecordBatch.from_arrays(columns, names=["item_id", "digest", "terms"])

    kind = items.schema["item_id"].dataType.simpleString()
    different = items.select("item_id", F.sha2("text", 256).alias("digest"), "text").where(F.col("text").isNotNull())
    one = different.groupBy("item_id", "digest").agg(F.first("text").alias("text"))
    found = one.select("item_id", "digest", "text").mapInArrow(work, f"item_id {kind}, digest string, terms array<binary>")
    return stored(found.where(F.size("terms") > 0), "search-items")


def packed_terms(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """For each document with a term: their number, and which of ``vocabulary`` occur how often."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, lengths, terms, times = [], [], [], []
            for row, text in enumerate(batch.column("text").cast(pa.binary()).to_pylist()):
                words = terms_of(text)
                if words:
                    known = sorted((vocabulary[w], n) for w, n in Counter(words).items() if w in vocabulary)
                    rows.append(row)
                    lengths.append(len(words))
                    terms.append(np.array([t for t, _ in known], dtype="<u4").tobytes())
                    times.append(np.array([n for _, n in known], dtype="<u4").tobytes())
            ids = batch.column("doc_id").take(pa.array(rows, type=pa.int64())).cast(pa.int64())
            columns = [ids, pa.array(lengths, type=pa.int64()), pa.array(terms, type=pa.binary()), pa.array(times, type=pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n", "terms", "times"])

    found = docs.select("doc_id", "text").mapInArrow(work, "doc_id long, n long, terms binary, times binary")
    return stored(found, "search-terms")


def document_counts(packed: DataFrame, size: int) -> np.ndarray:
    """Documents that hold each term: summed in the tasks, one number a term to the driver."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(size, dtype=np.int64)
        for batch in batches:
            counts += np.bincount(np.frombuffer(b"".join(batch.column("terms").to_pylist()), dtype="<u4"), minlength=size)
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_pydict({"term": used, "df": counts[used]})

    sums = packed.select("terms").mapInArrow(work, "term long, df long").groupBy("term").agg(F.sum("df").alias("df"))
    counts = np.zeros(size, dtype=np.int64)
    for row in sums.collect():
        counts[row["term"]] = row["df"]
    return counts


class Segment:
    """Posting lists of some documents, one after the other by term, with range maxima of impacts."""

    def __init__(self, ids: np.ndarray, n: np.ndarray, terms: list[bytes], times: list[bytes], weights: np.ndarray, docs: int, length: int):
        order = np.argsort(ids, kind="stable")
        self.ids, self.size = ids[order], len(ids)
        counts = np.array([len(terms[i]) for i in order]) // 4
        doc = np.repeat(np.arange(self.size), counts)
        term = np.frombuffer(b"".join([terms[i] for i in order]), dtype="<u4").astype(np.int64)
        tf = np.frombuffer(b"".join([times[i] for i in order]), dtype="<u4").astype(np.int64)
        m = 50 + (50 * n[order] * docs) // length
        impact = weights[term] * ((1_000_000_000 * tf) // (1000 * tf + 20 * m[doc]))
        by_term = np.argsort(term, kind="stable")
        self.doc, self.impact = doc[by_term], impact[by_term]
        self.key = term[by_term] * self.size + self.doc
        longest = int(np.bincount(term).max(initial=0))
        self.maxima = [np.arange(len(term), dtype=np.int32)]
        for half in (1 << j for j in range(max(longest, 1).bit_length() - 1)):
            last = self.maxima[-1]
            ahead = last[np.minimum(np.arange(half, half + len(last)), len(last) - 1)]
            self.maxima.append(np.where(self.impact[ahead] > self.impact[last], ahead, last))
        self.maxima = np.array(self.maxima)
        self.logs = np.array([0] + [i.bit_length() - 1 for i in range(1, longest + 1)])

    def maximum(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Largest impact of each range of postings and where it is; 0 for an empty range."""
        length = right - left
        empty = length <= 0
        left, level = np.where(empty, 0, left), self.logs[np.where(empty, 0, length)]
        one = self.maxima[level, left]
        two = self.maxima[level, np.where(empty, 0, right - (1 << level))]
        at = np.where(self.impact[two] > self.impact[one], two, one)
        return np.where(empty, 0, self.impact[at]), at

    def search(self, terms: np.ndarray, scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """``scores`` and ``ids`` found so far, best first, with those of this segment: at most ``k``."""
        first, end = np.searchsorted(self.key, terms * self.size), np.searchsorted(self.key, (terms + 1) * self.size)
        here = end > first
        base = terms[here] * self.size
        # An interval of documents: where it starts, its range in every posting list, its bound, where it is split.
        parts = self.bounded(np.zeros(1, dtype=np.int64), first[here][None], end[here][None])
        parts = [x[parts[3] > 0] for x in parts]
        while len(parts[0]):
            chosen = np.zeros(len(parts[0]), dtype=bool)
            some = min(AT_ONCE, max(16, len(chosen) // 4))
            chosen[np.argpartition(-parts[3], some)[:some] if len(chosen) > some else slice(None)] = True
            start, left, right, _, doc = (x[chosen] for x in parts)
            at = np.searchsorted(self.key, base + doc[:, None])
            present = (at < right) & (self.key[np.minimum(at, len(self.key) - 1)] == base + doc[:, None])
            found = np.where(present, self.impact[np.minimum(at, len(self.key) - 1)], 0).sum(axis=1)
            scores, ids = np.concatenate([scores, found]), np.concatenate([ids, self.ids[doc]])
            best = np.lexsort((ids, -scores))[:k]
            scores, ids = scores[best], ids[best]
            before = self.bounded(start, left, at)
            behind = self.bounded(doc + 1, at + present, right)
            parts = [np.concatenate([x[~chosen], a, b]) for x, a, b in zip(parts, before, behind, strict=True)]
            keep = parts[3] > 0
            if len(scores) == k:  # an equal score counts where a smaller doc_id may still come
                keep &= (parts[3] > scores[-1]) | (parts[3] == scores[-1]) & (self.ids[np.minimum(parts[0], self.size - 1)] < ids[-1])
            parts = [x[keep] for x in parts]
        return scores, ids

    def bounded(self, start: np.ndarray, left: np.ndarray, right: np.ndarray) -> list[np.ndarray]:
        most, at = self.maximum(left, right)
        bounds = most.sum(axis=1)
        split = at[np.arange(len(at)), most.argmax(axis=1)] if at.shape[1] else np.zeros(len(at), dtype=np.int64)
        return [start, left, right, bounds, self.doc[split] if len(self.doc) else split]


def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, list[bytes], list[bytes]]]:
    """Documents of a task with a term of the items, in groups of bounded size."""
    parts: list[list] = [[], [], [], []]
    postings = 0
    for batch in batches:
        ids = batch.column("doc_id").fill_null(NO_ID).to_pylist()
        for row in zip(ids, *(batch.column(c).to_pylist() for c in ("n", "terms", "times")), strict=True):
            if not row[2]:
                continue
            if parts[0] and (postings + len(row[2]) // 4 > SEGMENT_POSTINGS or len(parts[0]) >= SEGMENT_DOCS):
                yield np.array(parts[0]), np.array(parts[1]), parts[2], parts[3]
                parts, postings = [[], [], [], []], 0
            postings += len(row[2]) // 4
            for part, value in zip(parts, row, strict=True):
                part.append(value)
    if parts[0]:
        yield np.array(parts[0]), np.array(parts[1]), parts[2], parts[3]


def best_of_block(docs: DataFrame, items: DataFrame, k: int) -> DataFrame:
    """Each task's ``k`` best documents of every item of one block."""
    block = items.collect()
    names = [(r["item_id"], r["digest"]) for r in block]
    vocabulary: dict[bytes, int] = {}
    term_ids = [np.array([vocabulary.setdefault(bytes(t), len(vocabulary)) for t in r["terms"]], dtype=np.int64) for r in block]
    packed = packed_terms(docs, vocabulary)
    totals = packed.agg(F.count(F.lit(1)).alias("docs"), F.coalesce(F.sum("n"), F.lit(0)).alias("length")).first()
    count, length = totals["docs"], totals["length"]
    df = document_counts(packed, len(vocabulary)).tolist()
    weights = np.array([math.floor(1000 * math.log((2 * count + 2) / (2 * d + 1))) for d in df], dtype=np.int64)
    asked = [t[weights[t] > 0] for t in term_ids]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = [(np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)) for _ in names]
        for ids, n, terms, times in segments(batches):
            segment = Segment(ids, n, terms, times, weights, count, length)
            found = [segment.search(t, *best, k) for t, best in zip(asked, found, strict=True)]
        for (item_id, digest), (scores, ids) in zip(names, found, strict=True):
            size = len(scores)
            ids = pa.array(ids, mask=ids == NO_ID)
            yield pa.RecordBatch.from_arrays(
                [pa.array([item_id] * size, type=pa.int64()), pa.array([digest] * size, type=pa.string()), ids, pa.array(scores)],
                names=["item_id", "digest", "doc_id", "score"],
            )

    return packed.mapInArrow(work, "item_id long, digest string, doc_id long, score long")


def ranked_documents(docs: DataFrame, items: DataFrame, k: int = 50) -> DataFrame:
    """The ``k`` best documents of every item with a score above 0."""
    terms = item_terms(items)
    blocks = max(1, math.ceil((terms.agg(F.sum(F.size("terms"))).first()[0] or 0) / BLOCK_TERMS))
    numbered = terms.withColumn("block", F.pmod(F.xxhash64("digest", "item_id"), F.lit(blocks)))
    parts = [best_of_block(docs, numbered.where(F.col("block") == b), k) for b in range(blocks)]
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    best = Window.partitionBy("item_id", "digest").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("item_id", "rank", "doc_id", "score")
