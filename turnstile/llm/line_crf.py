"""Line sequence labelling: a linear-chain conditional random field marks each line content or boilerplate.

A text's lines with a word form a sequence. Each line has a few yes-or-no features; Viterbi decoding finds the best
labelling under integer weights, and the share of words on content lines decides whether the text stays. Texts that
fail the base rules (under 20 words, or over 30 % of words in 8-word windows that recur in the text) go before that.

:func:`fit_labels` trains the weights on a sample of the labelled documents, where every line has the quality label of
its document: at most :data:`SAMPLE` documents of each label, in the order of a digest of doc_id, and the first
:data:`SAMPLE_CHARS` characters of each. A document counts in its own lines and wrapped anew at :data:`WIDTHS`, so that
no weight rests on where lines break, and is followed by the next one of the sample, so that labels change within a
sequence. With under :data:`MIN_LABELLED` documents of a label, or no labels, :data:`WEIGHTS` are taken: those found on
the 0.1 test tables. No feature looks for marks of sentences, and only letters with case can shout, so verse, code and
scripts without case or full stop are judged by the same features as prose.

Null and empty texts have no words and fail. Each row is judged alone, so repeated rows get repeated results; other
columns are never read. A long text takes memory in proportion to its own words only.
"""

from __future__ import annotations

import re
import textwrap
from functools import partial

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turnstile.llm.common import BLANKS, doc_columns, per_text, run_hashes, split_words, word_hashes

SYMBOLS = "#*$%&|<>"
WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
MIN_CONTENT_PERCENT = 50

# Phrases of lines that stand around a text rather than in it.
NOTICE = re.compile(r"licen[sc]e|copyright|all rights reserved|cookie|subscribe|sign in|privacy policy|terms of", re.I)

FEATURES = ("always", "symbols", "shouting", "echoes", "seen before", "short", "notice")
BOILERPLATE, CONTENT = 0, 1
# Found by fit_labels on the 0.1 test tables: score of the content label for each feature, of a change of label between
# lines, and of each label for the first line; in hundredths.
WEIGHTS = {"content": (59, -168, -112, -128, -109, -35, -4), "change": -345, "first": (0, -13)}
#: Training sample: documents of each label at most, and least for a fit; characters of each; widths beside the own lines.
SAMPLE, MIN_LABELLED, SAMPLE_CHARS = 200, 50, 1500
WIDTHS = (78, 40)

SCHEMA = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "n_lines long, n_content_words long, base_failed boolean, kept boolean"
)


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words in windows that the text has twice or more, each word counted once."""
    if len(words) <= window:
        return 0
    mixed = run_hashes(word_hashes(words), window)
    n = len(mixed)
    order = np.argsort(mixed, kind="stable")
    same = mixed[order][1:] == mixed[order][:-1]
    twice = np.zeros(n + 1, dtype=bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    edges = np.zeros(len(words) + 1, dtype=np.int64)
    at = np.flatnonzero(twice)
    np.add.at(edges, at, 1)
    np.add.at(edges, at + window, -1)
    return int((np.cumsum(edges[:-1]) > 0).sum())


def shouts(line: str) -> bool:
    """More than half of the letters are capitals and none is small; letters of scripts without case are neither."""
    return line.isupper() and 2 * sum(map(str.isupper, line)) > sum(map(str.isalpha, line))


def line_features(line: str, words: list[str], seen: bool) -> tuple[bool, ...]:
    n = len(words)
    return (
        True,
        5 * sum(map(line.count, SYMBOLS)) >= 2 * n,
        4 * line.count("!!") >= n or n > 1 and shouts(line),
        n >= 6 and 2 * len(set(words)) <= n,
        seen,
        n < 4,
        bool(NOTICE.search(line)),
    )


def text_lines(text: str) -> tuple[np.ndarray, np.ndarray, int]:
    """Features and word counts of the lines with a word, and how many of these equal an earlier one."""
    features, counts, seen = [], [], set()
    for line in text.split("\n"):
        words = [w for w in re.split(r"[\x20\x09-\x0D]+", line) if w]
        if words:
            features.append(line_features(line, words, line in seen))
            counts.append(len(words))
            seen.add(line)
    return np.array(features, dtype=np.int64).reshape(-1, len(FEATURES)), np.array(counts, dtype=np.int64), len(counts) - len(seen)


def viterbi(content: np.ndarray, change: int, first: tuple[int, int]) -> np.ndarray:
    """Best labels for lines whose content label scores ``content`` (the other scores 0); content wins ties."""
    if not len(content):
        return np.zeros(0, dtype=bool)
    best, back = [first[0], first[1] + int(content[0])], []
    for score in content[1:].tolist():
        stay = [best[label] >= best[1 - label] + change for label in (0, 1)]
        back.append(stay)
        best = [max(best[0], best[1] + change), max(best[1], best[0] + change) + score]
    label = int(best[1] >= best[0])
    labels = [label]
    for stay in reversed(back):
        label = label if stay[label] else 1 - label
        labels.append(label)
    return np.array(labels[::-1], dtype=bool)


def judge(text: str | None, weights: dict = WEIGHTS) -> tuple:
    text = text or ""
    words = split_words(text)
    features, counts, n_dup = text_lines(text)
    content = features @ np.array(weights["content"], dtype=np.int64)
    on_content = int(counts[viterbi(content, weights["change"], weights["first"])].sum()) if len(counts) else 0
    n_repeat = repeated_words(words)
    failed = len(words) < MIN_WORDS or 100 * n_repeat > MAX_REPEAT_PERCENT * len(words)
    return (
        len(words),
        len(text) - sum(map(text.count, BLANKS)),
        sum(map(text.count, SYMBOLS)),
        n_dup,
        n_repeat,
        len(counts),
        on_content,
        failed,
        not failed and 100 * on_content >= MIN_CONTENT_PERCENT * len(words),
    )


def with_line_verdict(docs: DataFrame, weights: dict = WEIGHTS) -> DataFrame:
    """All columns of ``docs`` and a struct ``lines`` of counts and the verdict (replacing a column of that name)."""
    return docs.withColumn("lines", per_text(partial(judge, weights=weights), SCHEMA)(F.col("text")))


def content_documents(docs: DataFrame, labels: DataFrame | None = None) -> DataFrame:
    """The rows of ``docs`` whose text stays under weights fitted to ``labels``, with their columns as they were."""
    judged = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("text"))
    return with_line_verdict(judged, fit_labels(docs, labels)).filter("lines.kept").select("row.*")


def line_report(docs: DataFrame, labels: DataFrame | None = None) -> DataFrame:
    names = [part.split()[0] for part in SCHEMA.split(", ")]
    docs = doc_columns(docs, "doc_id", "text")
    return with_line_verdict(docs, fit_labels(docs, labels)).select("doc_id", *[f"lines.{n}" for n in names])


def labelled_sample(docs: DataFrame, labels: DataFrame, most: int = SAMPLE) -> list[tuple[str, int]]:
    """Texts and labels of at most ``most`` documents of each label; a doc_id with both labels is left out."""
    usable = labels.select(F.col("doc_id").cast("long"), F.col("quality").cast("int")).filter("doc_id is not null and quality in (0, 1)")
    agreed = usable.groupBy("doc_id").agg(F.min("quality").alias("quality"), F.max("quality").alias("most")).filter("quality = most")
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    chosen = [agreed.filter(F.col("quality") == label).orderBy(*order).limit(most).select("doc_id", "quality") for label in (0, 1)]
    texts = doc_columns(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), F.substring("text", 1, SAMPLE_CHARS).alias("text"))
    rows = texts.join(chosen[0].unionByName(chosen[1]), "doc_id").groupBy("doc_id").agg(F.min(F.struct("text", "quality")).alias("row"))
    found = rows.orderBy(*order).select("row.*").collect()
    return [(row["text"], row["quality"]) for row in found if split_words(row["text"])]


def rewrapped(text: str, width: int) -> str:
    return "\n".join(textwrap.wrap(text, width, break_long_words=False, break_on_hyphens=False))


def training_sequences(sample: list[tuple[str, int]]) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Each document in its own lines and at every width, followed by the next one in the same form."""
    sequences, labels = [], []
    for change in (lambda text: text, *[partial(rewrapped, width=width) for width in WIDTHS]):
        lines = [text_lines(change(text))[0] for text, _ in sample]
        for k, (_, label) in enumerate(sample):
            after = (k + 1) % len(sample)
            sequences.append(np.concatenate([lines[k], lines[after]]))
            labels.append(np.repeat([label, sample[after][1]], [len(lines[k]), len(lines[after])]))
    return sequences, labels


def fit_labels(docs: DataFrame, labels: DataFrame | None) -> dict:
    """Weights fitted to the labelled documents of ``docs``, or :data:`WEIGHTS` where these are too few."""
    sample = [] if labels is None else labelled_sample(docs, labels)
    if min(sum(label == y for _, label in sample) for y in (0, 1)) < MIN_LABELLED:
        return WEIGHTS
    return fit_crf(*training_sequences(sample))


def fit_crf(sequences: list[np.ndarray], labels: list[np.ndarray], steps: int = 150, rate: float = 6.0, penalty: float = 1e-3) -> dict:
    """Weights of highest penalised likelihood by gradient ascent, with exact expectations over all labellings.

    Sequences are padded to the longest one and taken together, a line at a time.
    """
    n, longest, width = len(sequences), max(map(len, sequences)), sequences[0].shape[1]
    x, y, real = np.zeros((n, longest, width)), np.zeros((n, longest)), np.zeros((n, longest), dtype=bool)
    for k, (rows, own) in enumerate(zip(sequences, labels)):
        x[k, : len(rows)], y[k, : len(rows)], real[k, : len(rows)] = rows, own, True
    total, both = real.sum(), real[:, 1:]
    changes = ((y[:, 1:] != y[:, :-1]) & both).sum()
    content, change, first = np.zeros(width), 0.0, np.zeros(2)
    for _ in range(steps):
        g_content, g_change, g_first = -penalty * content, -penalty * change, -penalty * first
        states = np.stack([np.zeros((n, longest)), x @ content], axis=2)
        ahead, behind = np.empty_like(states), np.zeros_like(states)
        ahead[:, 0] = states[:, 0] + first
        for t in range(1, longest):
            a, b = ahead[:, t - 1, 0], ahead[:, t - 1, 1]
            moved = np.stack([np.logaddexp(a, b + change), np.logaddexp(b, a + change)], axis=1)
            ahead[:, t] = np.where(real[:, t, None], states[:, t] + moved, ahead[:, t - 1])
        for t in range(longest - 2, -1, -1):
            a, b = (states[:, t + 1] + behind[:, t + 1]).T
            moved = np.stack([np.logaddexp(a, b + change), np.logaddexp(b, a + change)], axis=1)
            behind[:, t] = np.where(real[:, t + 1, None], moved, 0.0)
        norm = np.logaddexp(ahead[:, -1, 0], ahead[:, -1, 1])
        likely = np.exp(ahead + behind - norm[:, None, None]) * real[:, :, None]
        g_content += np.tensordot(y * real - likely[:, :, 1], x, 2) / total
        g_first += (np.stack([1 - y[:, 0], y[:, 0]], axis=1) - likely[:, 0]).sum(axis=0) / total
        after = states[:, 1:] + behind[:, 1:] - norm[:, None, None]
        crossed = np.exp(ahead[:, :-1, 0] + change + after[:, :, 1]) + np.exp(ahead[:, :-1, 1] + change + after[:, :, 0])
        g_change += (changes - (crossed * both).sum()) / total
        content, change, first = content + rate * g_content, change + rate * g_change, first + rate * g_first
    scaled = lambda v: tuple(int(round(100 * w)) for w in v)
    return {"content": scaled(content), "change": int(round(100 * change)), "first": scaled(first - first.max())}
