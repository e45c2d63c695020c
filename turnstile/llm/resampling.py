"""Documents drawn to resemble a target: hashed n-gram importance weights and Gumbel scores.

Words are lower-cased (A-Z only) runs of letters, digits and characters beyond ASCII. A document's features are its runs
of 1 to ``max_n`` words joined by one blank; each falls into the bucket ``crc32 mod buckets``. A task scans each text
once, keeps the running CRCs at its words' bounds, and derives every run's CRC from two of them (:mod:`.crc`); no run is
ever built as text. Bucket counts are summed per task before the shuffle, so at most ``buckets`` rows leave a task.

A bucket's gain compares its share in the target with its share in the documents; a document's weight is the floored
mean gain of its features. With Gumbel noise of its doc_id that weight is a score, and the highest scores are drawn.

Ranks come without a global sort: rows are counted per score (scores are integers; some ten thousand differ, whatever
the number of documents), and only rows with a drawn score are ranked, within their score.

Defined results: null, empty and wordless texts have no features and weight 0. Repeated rows count each. Rows without
doc_id share the noise of an empty id and come last among equals. Equal rows that straddle the end of the draw are told
apart by number only. Empty tables give empty results; an empty target gives gains below that of no evidence, not an error.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from turnstile.llm.common import stored
from turnstile.llm.crc import RunningCrcs

# A-Z to lower case; all other ASCII characters that are no letters or digits part words.
SEPARATORS = bytes(b if 48 <= b <= 57 or 97 <= b <= 122 or b > 127 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))
SLICE_BYTES = 4 << 20
SPACE = 1 << 32


def sliced_words(texts: list[bytes | None]) -> Iterator[tuple[int, list[bytes], np.ndarray]]:
    """For slices of a batch: the first text's place, all words, and where each text's words start."""
    at = 0
    while at < len(texts):
        first, size, words, starts = at, 0, [], [0]
        while at < len(texts) and (size == 0 or size + len(texts[at] or b"") <= SLICE_BYTES):
            text = texts[at] or b""
            words += text.translate(SEPARATORS).split()
            starts.append(len(words))
            size, at = size + max(len(text), 1), at + 1
        yield first, words, np.array(starts)


def run_buckets(words: list[bytes], starts: np.ndarray, max_n: int, buckets: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each length: the buckets of all runs of the slice, and which of them lie within one text."""
    crcs = RunningCrcs(words)
    text_of = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
    for n in range(1, max_n + 1):
        found = crcs.of_runs(n) % np.uint32(buckets)
        within = text_of[: len(found)] == text_of[n - 1 : n - 1 + len(found)]
        yield n, found.astype(np.int64), within


def bucket_counts(docs: DataFrame, max_n: int, buckets: int) -> DataFrame:
    """Features in each bucket, over all documents."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            for _, words, starts in sliced_words(batch.column("text").cast(pa.binary()).to_pylist()):
                for _, found, within in run_buckets(words, starts, max_n, buckets):
                    totals += np.bincount(found[within], minlength=buckets)
        used = np.flatnonzero(totals)
        yield pa.RecordBatch.from_pydict({"bucket": used, "n": totals[used]})

    counts = docs.select("text").mapInArrow(count, "bucket long, n long")
    return counts.groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_gains(docs: DataFrame, target: DataFrame, max_n: int, buckets: int) -> np.ndarray:
    """Gain of every bucket; ``buckets`` numbers of each side come to the driver."""
    sides = [np.zeros(buckets, dtype=np.int64) for _ in range(2)]
    counts = [bucket_counts(frame, max_n, buckets).withColumn("side", F.lit(k)) for k, frame in enumerate((docs, target))]
    for row in counts[0].unionByName(counts[1]).collect():
        sides[row["side"]][row["bucket"]] = row["n"]
    s, t = (side.tolist() for side in sides)
    all_s, all_t = sum(s) + buckets, sum(t) + buckets
    return np.array([math.floor(1000 * math.log((t[b] + 1) * all_s / ((s[b] + 1) * all_t))) for b in range(buckets)], dtype=np.int64)


def weigh(docs: DataFrame, gains: np.ndarray, max_n: int) -> DataFrame:
    """Words, features and floored mean gain of every document."""
    buckets = len(gains)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words_of, features, sums = (np.zeros(batch.num_rows, dtype=np.int64) for _ in range(3))
            for first, words, starts in sliced_words(batch.column("text").cast(pa.binary()).to_pylist()):
                rows = slice(first, first + len(starts) - 1)
                words_of[rows] = np.diff(starts)
                for n, found, within in run_buckets(words, starts, max_n, buckets):
                    ends = np.concatenate([[0], np.cumsum(np.where(within, gains[found], 0))])
                    at = np.minimum(starts, len(found))
                    sums[rows] += ends[at[1:]] - ends[at[:-1]]
                    features[rows] += np.maximum(np.diff(starts) - n + 1, 0)
            weights = np.where(features > 0, sums // np.maximum(features, 1), 0)
            columns = [batch.column("doc_id"), pa.array(words_of), pa.array(features), pa.array(weights)]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_words", "n_features", "weight"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(work, f"doc_id {kind}, n_words long, n_features long, weight long")


def gumbel(doc_id: Column, seed: int) -> Column:
    """Thousandths of a Gumbel variate that the id alone decides."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / F.lit(float(SPACE))))).cast("bigint")


def ranked(scored: DataFrame, min_words: int, percent: int) -> DataFrame:
    """``rank`` of the highest scores among documents of ``min_words``; null for all others."""
    eligible = scored.where(F.col("n_words") >= min_words)
    # Rows of one score: at most as many groups as scores differ, whatever the number of documents.
    above = Window.orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, -1)
    counts = eligible.groupBy("score").agg(F.count(F.lit(1)).alias("n"))
    places = stored(counts.select("score", "n", F.coalesce(F.sum("n").over(above), F.lit(0)).alias("before")), "resample-places")
    n = places.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    draws = percent * n // 100
    lowest = places.where(F.col("before") < draws).agg(F.min("score")).first()[0]
    # No draw at all: a score that none reaches.
    drawn = (F.col("n_words") >= min_words) & (F.col("score") >= F.lit(lowest)) if draws else F.lit(False)
    result = ["doc_id", "n_features", "weight", "score"]
    rest = scored.where(~drawn).select(*result, F.lit(None).cast("bigint").alias("rank"))
    # Equal rows become one with a number, so a row that is repeated without end fills no window.
    equal = scored.where(drawn).groupBy(*result).agg(F.count(F.lit(1)).alias("copies"))
    order = Window.partitionBy("score").orderBy(F.asc_nulls_last("doc_id"), "n_features")
    upto = F.sum("copies").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    within = equal.select("*", upto.alias("upto")).join(places.where(F.col("before") < draws).select("score", "before"), "score")
    each = F.explode(F.sequence(F.col("upto") - F.col("copies") + 1, F.col("upto"))).alias("place")
    numbered = within.select(*result, "before", each).select(*result, (F.col("before") + F.col("place")).alias("rank"))
    top = numbered.withColumn("rank", F.when(F.col("rank") <= draws, F.col("rank")))
    return rest.unionByName(top)


def resample(
    docs: DataFrame, target: DataFrame, buckets: int = 10_000, max_n: int = 2, min_words: int = 20, percent: int = 25, seed: int = 7
) -> DataFrame:
    """Every document with its weight and score, and its rank if it is drawn."""
    gains = bucket_gains(docs, target, max_n, buckets)
    noisy = weigh(docs, gains, max_n).withColumn("score", F.col("weight") + gumbel(F.col("doc_id"), seed))
    return ranked(stored(noisy, "resample-scored"), min_words, percent)
