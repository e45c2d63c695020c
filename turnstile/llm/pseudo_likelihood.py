"""Masked pseudo-likelihood: a network over a window on both sides predicts every word of every document.

Every distinct word of all documents is counted in a table, the vocabulary, which stays distributed. Words are hashed
to :data:`PLACES` places, whose counts part them into :data:`CLASSES` classes of about equal mass. The network reads the
two words before and the two after a masked one: their vectors pass one hidden layer and give the probabilities of the
class; within the class a word has its exact share of the counts. It is trained in numpy by every task on all words it
reads, from common weights, for :data:`ROUNDS` rounds; after each the tasks' weights are averaged in proportion to
their words. The driver gets one set of weights, the places' counts and those of at most :data:`HEAD` words.

The counts of these most frequent words travel with the scoring function. All other words of a document are joined to
the vocabulary; each of them is too rare to be a hot key. So no word is left out or shares its count with another.

A document's score is the sum of its words' conditional log-probabilities. Null and empty texts have no words, the sum
0 and no mean. Each row is scored alone, repeated rows alike. Other columns are never read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from xxhash import xxh64_intdigest

from turnstile.llm.common import BLANKS, doc_columns, stored

PLACES = 1 << 15
CLASSES = 48
VECTORS, WIDTH, HIDDEN = 1 << 12, 8, 24
OFFSETS = (-2, -1, 1, 2)
OUTSIDE = VECTORS  # the vector that stands before the first and after the last word
ROUNDS = 2
BATCH, RATE = 4096, 0.05
CHUNK_WORDS = 1 << 19
#: Words whose counts are sent to every task at most (1 MB), and parts of a doubling by which counts are told apart.
HEAD, PARTS = 1 << 16, 16
#: Bytes that are summed up at once, and of a word above which it is digested alone.
SPAN, LONG = 1 << 16, 64
_RANDOM = np.random.default_rng(20240229)
LETTERS = _RANDOM.integers(1 << 64, size=256, dtype=np.uint64)
FACTOR = 0x9E3779B97F4A7C15
POWERS, INVERSES = (
    np.multiply.accumulate(np.concatenate([np.ones(1, np.uint64), np.full(SPAN, f, np.uint64)]))
    for f in (FACTOR, pow(FACTOR, -1, 1 << 64))
)
IN_WORD = ~np.isin(np.arange(256), list(BLANKS.encode()))
#: Scores of classes up to which their exponentials are taken as they are.
SAFE = 80

SHAPES = {
    "vectors": (VECTORS + 1, WIDTH),
    "inner": (len(OFFSETS) * WIDTH, HIDDEN),
    "inner_bias": (HIDDEN,),
    "outer": (HIDDEN, CLASSES),
    "outer_bias": (CLASSES,),
}


def word_bounds(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The bytes of all texts, where their words start and end there, and how many words each text has."""
    column = texts.fill_null("").cast(pa.large_binary())
    edges = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)[edges[0] : edges[-1]]
    edges = edges - edges[0]
    full = IN_WORD[data]
    first, last = full.copy(), full.copy()
    first[1:] &= ~full[:-1]
    last[:-1] &= ~full[1:]
    some = edges[1:] > edges[:-1]  # words end with their text
    first[edges[:-1][some]] = full[edges[:-1][some]]
    last[edges[1:][some] - 1] = full[edges[1:][some] - 1]
    starts = np.flatnonzero(first)
    return data, starts, np.flatnonzero(last) + 1, np.diff(np.searchsorted(starts, edges))


def text_words(texts: list[str | None] | pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """64-bit digests of the words of all texts in order, and how many each text has.

    A digest is a polynomial in random values of the word's bytes: sums up to every byte, a span of bytes at a time,
    give those of all words. Long words, for which such polynomials are weaker, have a digest of their own.
    """
    data, starts, ends, counts = word_bounds(texts if isinstance(texts, pa.Array) else pa.array(texts, pa.large_string()))
    found = np.zeros(len(starts), dtype=np.uint64)
    sums, i = np.zeros(SPAN + 1, dtype=np.uint64), 0
    while i < len(starts):
        at = starts[i]
        j = max(i + 1, int(np.searchsorted(ends, at + SPAN, side="right")))
        n = ends[j - 1] - at
        if n <= SPAN:
            np.cumsum(LETTERS[data[at : at + n]] * POWERS[:n], out=sums[1 : n + 1])
            found[i:j] = (sums[ends[i:j] - at] - sums[starts[i:j] - at]) * INVERSES[starts[i:j] - at]
        i = j
    found ^= found >> np.uint64(32)
    found *= np.uint64(0xBF58476D1CE4E5B9)
    found ^= found >> np.uint64(29)
    for k in np.flatnonzero(ends - starts > LONG):
        found[k] = xxh64_intdigest(data[starts[k] : ends[k]])
    return found.view(np.int64), counts


def places_of(words: np.ndarray) -> np.ndarray:
    return words & (PLACES - 1)


def windows(places: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """For every word the vectors of the words around it in its own text."""
    reach = max(OFFSETS)
    shift = np.repeat(np.arange(len(counts)) * reach, counts) + reach  # a gap before each text
    line = np.full(len(places) + (len(counts) + 1) * reach, OUTSIDE, dtype=np.int64)
    at = np.arange(len(places)) + shift
    line[at] = places & (VECTORS - 1)
    return np.stack([line[at + offset] for offset in OFFSETS], axis=1)


def starting_weights() -> dict[str, np.ndarray]:
    random = np.random.default_rng(11)
    scale = {"vectors": 0.5, "inner": 0.3, "outer": 0.1}
    return {name: (random.standard_normal(shape) * scale.get(name, 0)).astype(np.float32) for name, shape in SHAPES.items()}


def activations(weights: dict[str, np.ndarray], around: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Inputs, hidden values and scores of the classes, from which their exponentials' sum is still to be taken.

    The scores are small enough for exponentials.
    """
    inputs = np.take(weights["vectors"], around, axis=0).reshape(len(around), -1)
    hidden = inputs @ weights["inner"]
    hidden += weights["inner_bias"]
    np.tanh(hidden, out=hidden)
    scores = hidden @ weights["outer"]
    scores += weights["outer_bias"]
    # Hidden values lie between -1 and 1, which bounds the scores.
    if (np.abs(weights["outer"]).sum(axis=0) + np.abs(weights["outer_bias"])).max() > SAFE:
        scores -= scores.max(axis=1, keepdims=True)
    return inputs, hidden, scores


def row_sums(values: np.ndarray) -> np.ndarray:
    return values @ np.ones(values.shape[1], dtype=values.dtype)


def forward(weights: dict[str, np.ndarray], around: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Inputs, hidden values and logarithms of the classes' probabilities."""
    inputs, hidden, scores = activations(weights, around)
    return inputs, hidden, scores - np.log(np.exp(scores).sum(axis=1, keepdims=True))


def train(weights: dict[str, np.ndarray], squares: dict[str, np.ndarray], around: np.ndarray, classes: np.ndarray) -> None:
    """Steps of AdaGrad over all given words, in place."""
    for i in range(0, len(classes), BATCH):
        near, wanted = around[i : i + BATCH], classes[i : i + BATCH]
        inputs, hidden, scores = activations(weights, near)
        error = np.exp(scores, out=scores)
        error *= (1 / (len(wanted) * row_sums(error)))[:, None]
        error[np.arange(len(wanted)), wanted] -= 1 / len(wanted)
        back = (error @ weights["outer"].T) * (1 - hidden * hidden)
        to_inputs = (back @ weights["inner"].T).reshape(-1, WIDTH)
        flat = near.ravel()
        moved = np.stack([np.bincount(flat, to_inputs[:, k], minlength=VECTORS + 1) for k in range(WIDTH)], axis=1)
        gradients = {
            "vectors": moved.astype(np.float32),
            "inner": inputs.T @ back,
            "inner_bias": back.sum(axis=0),
            "outer": hidden.T @ error,
            "outer_bias": error.sum(axis=0),
        }
        for name, gradient in gradients.items():
            squares[name] += gradient * gradient
            weights[name] -= RATE * gradient / (np.sqrt(squares[name]) + 1e-7)


def flatten(weights: dict[str, np.ndarray]) -> np.ndarray:
    return np.concatenate([weights[name].ravel() for name in SHAPES]).astype(np.float64)


def unflatten(values: np.ndarray) -> dict[str, np.ndarray]:
    sizes = [int(np.prod(shape)) for shape in SHAPES.values()]
    parts = np.split(values.astype(np.float32), np.cumsum(sizes)[:-1])
    return {name: part.reshape(shape).copy() for (name, shape), part in zip(SHAPES.items(), parts)}


def chunks(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Parts of the batches of about CHUNK_WORDS words, with their words' digests."""
    for batch in batches:
        texts = batch.column(column).cast(pa.large_string())
        lengths = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False) // 6 + 1
        part_of = np.cumsum(lengths) // CHUNK_WORDS
        edges = [0, *(np.flatnonzero(np.diff(part_of)) + 1).tolist(), len(batch)]
        for b, e in zip(edges[:-1], edges[1:]):
            yield batch.slice(b, e - b), *text_words(texts.slice(b, e - b))


def vocabulary(docs: DataFrame) -> DataFrame:
    """(word, n) of every distinct word: counted by parts of a task's texts, then summed by word."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, words, _ in chunks(batches, 0):
            found, n = np.unique(words, return_counts=True)
            yield pa.record_batch([pa.array(found, pa.int64()), pa.array(n, pa.int64())], names=["word", "n"])

    return docs.select("text").mapInArrow(counted, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))


def place_counts(words: DataFrame) -> np.ndarray:
    found = np.zeros(PLACES, dtype=np.int64)
    place = F.col("word").bitwiseAND(F.lit(PLACES - 1).cast("long"))
    for at, n in words.groupBy(place.alias("place")).agg(F.sum("n")).collect():  # one row per place
        found[at] = n
    return found


def with_size(words: DataFrame) -> DataFrame:
    return words.withColumn("size", F.floor(F.log2("n") * PARTS))


def frequent_words(words: DataFrame, most: int = HEAD) -> tuple[np.ndarray, np.ndarray, int]:
    """Sorted digests and counts of the words of the greatest sizes, at most ``most``, and the least size of them."""
    least, held = 1 << 30, 0
    sizes = with_size(words).groupBy("size").agg(F.count("*").alias("n")).collect()  # at most 64 * PARTS rows
    for size, n in sorted(sizes, reverse=True):
        held += n
        if held > most:
            break
        least = size
    rows = sorted(with_size(words).filter(F.col("size") >= least).select("word", "n").collect())  # at most ``most``
    found = np.array(rows, dtype=np.int64).reshape(-1, 2)
    return found[:, 0], found[:, 1], least


def classes_of(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Class of each place, and the logarithm of all counts of each class."""
    order = np.argsort(-counts, kind="stable")
    mass = counts + 1.0
    before = np.cumsum(mass[order]) - mass[order] / 2
    classes = np.empty(PLACES, dtype=np.int64)
    classes[order] = np.minimum(before * CLASSES / mass.sum(), CLASSES - 1).astype(np.int64)
    return classes, np.log(np.maximum(np.bincount(classes, counts, minlength=CLASSES), 1))


def train_round(docs: DataFrame, start: dict[str, np.ndarray], classes: np.ndarray) -> dict[str, np.ndarray]:
    def trained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = {name: value.copy() for name, value in start.items()}
        squares = {name: np.zeros_like(value) for name, value in start.items()}
        words = 0
        for _, found, counts in chunks(batches, 0):
            places = places_of(found)
            train(weights, squares, windows(places, counts), classes[places])
            words += len(places)
        if words:
            values = flatten(weights) * words
            columns = [pa.array(np.arange(len(values))), pa.array(values), pa.array(np.full(len(values), float(words)))]
            yield pa.record_batch(columns, names=["at", "value", "words"])

    sums = docs.select("text").mapInArrow(trained, "at long, value double, words double").groupBy("at")
    means = sums.agg((F.sum("value") / F.sum("words")).alias("value")).collect()  # one row per weight
    if not means:
        return start
    values = np.zeros(len(means))
    for at, value in means:
        values[at] = value
    return unflatten(values)


def score_documents(docs: DataFrame, rounds: int = ROUNDS, most_frequent: int = HEAD) -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, log_prob and mean_log_prob.

    ``most_frequent`` bounds the words whose counts every task gets; the scores do not depend on it.
    """
    docs = doc_columns(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), "text")
    words = stored(vocabulary(docs), "vocabulary")
    classes, masses = classes_of(place_counts(words))
    head, head_counts, least = frequent_words(words, most_frequent)
    weights = starting_weights()
    for _ in range(rounds):
        weights = train_round(docs, weights, classes)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row, known = TaskContext.get().partitionId() << 40, np.append(head, 0)
        logs = np.append(np.log(head_counts), 0.0)
        for part, found, counts in chunks(batches, 1):
            places = places_of(found)
            around, wanted, chances = windows(places, counts), classes[places], np.zeros(len(places))
            for i in range(0, len(places), 4 * BATCH):
                scores = activations(weights, around[i : i + 4 * BATCH])[2]
                own = scores[np.arange(len(scores)), wanted[i : i + 4 * BATCH]]
                chances[i : i + 4 * BATCH] = own - np.log(row_sums(np.exp(scores, out=scores)))
            at = np.searchsorted(head, found)
            frequent = (at < len(head)) & (known[at] == found)
            chances += np.where(frequent, logs[at], 0) - masses[wanted]
            text_of = np.repeat(np.arange(len(counts)), counts)
            total = np.bincount(text_of, chances, minlength=len(counts))
            ends = np.concatenate([[0], np.cumsum(np.bincount(text_of[~frequent], minlength=len(counts)))])
            rare = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(found[~frequent], pa.int64()))
            columns = [pa.array(row + np.arange(len(counts))), part.column(0), pa.array(counts), pa.array(total, pa.float64()), rare]
            yield pa.record_batch(columns, names=["row", "doc_id", "n_words", "log_prob", "rare"])
            row += len(counts)

    known = stored(docs.mapInArrow(scored, "row long, doc_id long, n_words long, log_prob double, rare array<long>"), "scored-rows")
    rare_words = with_size(words).filter(F.col("size") < least).select("word", F.log("n").alias("log_n"))
    rare = known.select("row", F.explode("rare").alias("word")).join(rare_words, "word").groupBy("row").agg(F.sum("log_n").alias("log_n"))
    found = known.select("row", "doc_id", "n_words", "log_prob").join(rare, "row", "left")
    total = F.col("log_prob") + F.coalesce("log_n", F.lit(0.0))
    mean = F.when(F.col("n_words") > 0, F.col("log_prob") / F.col("n_words"))
    return found.select("doc_id", "n_words", total.alias("log_prob")).withColumn("mean_log_prob", mean)
