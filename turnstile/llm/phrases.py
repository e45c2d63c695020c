"""Repeated-phrase automata: removes words of passages that occur earlier in the documents.

Every window of 20 words holds one phrase of eight words with the least hash, the same wherever the window occurs; so
windows that recur have a recurring phrase in common. Recurring phrases are found by counts, and each belongs to the
first document that has it. Documents, cut to the words that a window with a recurring phrase can reach, stream through
shards of one Aho-Corasick automaton per first document, built of that document's recurring phrases, which locates
every occurrence of them by their words. Each window around an
occurrence is then looked up among the first document's windows, or compared by a 128-bit digest with the windows
that other documents have around phrases of the same kind.

A first document whose phrases very many documents share is copied to several tasks, each with a part of them. Texts
are ordered by doc_id (null first), then by a digest of the text, then by start. Null, empty and short texts lose
nothing; rows equal in doc_id and text get the same result. Other columns are never read.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turnstile.llm.common import doc_columns, run_hashes, split_words, stored, word_hashes

WINDOW = 20
PHRASE = 8
#: Documents with phrases of one first document that a task takes at most, about.
DOCUMENTS_A_TASK = 256
NO_ID = -(1 << 63)
KEYS = ("first_doc", "first_digest", "part", "doc", "digest")


def phrase_places(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of the phrases that have the least hash in some window."""
    hashes = run_hashes(word_hashes(words), PHRASE)
    span = WINDOW - PHRASE + 1
    if len(hashes) < span:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    least = np.lib.stride_tricks.sliding_window_view(hashes, span).argmin(axis=1)
    places = np.unique(least + np.arange(len(least)))
    return places, hashes[places].astype(np.int64)


def phrase_rows(docs: DataFrame) -> DataFrame:
    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes = [phrase_places(split_words(text.as_py()))[1] for text in batch.column(2)]
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(hashes, pa.list_(pa.int64()))], names=["doc", "digest", "phrases"])

    rows = docs.select("doc", "digest", "text").mapInArrow(found, "doc long, digest string, phrases array<long>")
    return rows.select("doc", "digest", F.explode("phrases").alias("phrase"))


def cut_to_passages(placed: DataFrame) -> DataFrame:
    """Rows with the runs of words that windows with one of their ``phrases`` can reach, in place of the text.

    ``places`` says where the phrases of a first document start.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            segments, starts = [], []
            for text, phrases in zip(batch.column(5), batch.column(6)):
                words = split_words(text.as_py())
                places, hashes = phrase_places(words)
                places = places[np.isin(hashes, phrases.values.to_numpy())]
                edges = np.zeros(len(words) + 1, dtype=np.int64)
                np.add.at(edges, np.maximum(places - (WINDOW - PHRASE), 0), 1)
                np.add.at(edges, np.minimum(places + WINDOW, len(words)), -1)
                turns = np.diff(np.concatenate([[0], np.cumsum(edges[:-1]) > 0, [0]]).astype(np.int8))
                runs = zip(np.flatnonzero(turns == 1).tolist(), np.flatnonzero(turns == -1).tolist())
                segments.append([{"start": b, "words": b" ".join(words[b:e]).decode("utf-8", "surrogatepass")} for b, e in runs])
                starts.append(places.tolist())
            kind = pa.list_(pa.struct([("start", pa.int32()), ("words", pa.string())]))
            columns = [*batch.columns[:5], pa.array(segments, kind), pa.array(starts, pa.list_(pa.int32()))]
            yield pa.record_batch(columns, names=[*KEYS, "segments", "places"])

    rows = placed.select(*KEYS, "text", "phrases")
    schema = "first_doc long, first_digest string, part int, doc long, digest string, segments array<struct<start:int,words:string>>, places array<int>"
    return rows.mapInArrow(cut, schema)


class Passages:
    """The automaton of one first document, and where its windows around the phrases start."""

    def __init__(self, segments: list[dict], places: list[int]):
        import ahocorasick

        self.automaton = ahocorasick.Automaton()
        for segment in segments:
            words = segment["words"].split(" ")
            for place in places:
                at = place - segment["start"]
                if 0 <= at <= len(words) - PHRASE:
                    phrase = " ".join(words[at : at + PHRASE])
                    self.automaton.add_word(f" {phrase} ", len(phrase))
        self.automaton.make_automaton()
        self.starts: dict[str, int] = {}

    def windows(self, segments: list[dict]) -> Iterator[tuple[int, str]]:
        """Start and words of every window that holds one of the phrases, in order."""
        for segment in segments:
            line = f" {segment['words']} "
            words = segment["words"].split(" ")
            begins = np.concatenate([[1], 1 + np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1)])
            found = np.array([end - length for end, length in self.automaton.iter(line)], dtype=np.int64)
            n = len(words) - WINDOW + 1
            if n <= 0 or not len(found):
                continue
            places = np.searchsorted(begins, found)
            edges = np.zeros(n + 1, dtype=np.int64)
            np.add.at(edges, np.clip(places - (WINDOW - PHRASE), 0, n), 1)
            np.add.at(edges, np.clip(places + 1, 0, n), -1)
            for start in np.flatnonzero(np.cumsum(edges[:-1]) > 0).tolist():
                yield segment["start"] + start, line[begins[start] : begins[start + WINDOW] - 1]


def locate(routed: DataFrame) -> DataFrame:
    """Per document and first document: starts of windows the first one has, and digests of the other windows."""

    def located(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, passages = None, None
        for batch in batches:
            rows = []
            for row in batch.to_pylist():
                if group != (row["first_doc"], row["first_digest"]):
                    group, passages = (row["first_doc"], row["first_digest"]), Passages(row["segments"], row["places"])
                earlier, others, highs, lows = [], [], [], []
                own = (row["doc"], row["digest"]) == group
                for start, window in passages.windows(row["segments"]):
                    if own and passages.starts.setdefault(window, start) == start:
                        continue
                    if window in passages.starts:
                        earlier.append(start)
                        continue
                    digest = blake2b(window.encode("utf-8", "surrogatepass"), digest_size=16).digest()
                    others.append(start)
                    highs.append(int.from_bytes(digest[:8], "little", signed=True))
                    lows.append(int.from_bytes(digest[8:], "little", signed=True))
                rows.append((row["doc"], row["digest"], earlier, others, highs, lows))
            kinds = [pa.int64(), pa.string(), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.list_(pa.int64()), pa.list_(pa.int64())]
            names = ["doc", "digest", "earlier", "starts", "highs", "lows"]
            yield pa.record_batch([pa.array(column, kind) for column, kind in zip(zip(*rows), kinds)], names=names)

    schema = "doc long, digest string, earlier array<int>, starts array<int>, highs array<long>, lows array<long>"
    return routed.mapInArrow(located, schema)


def earlier_windows(docs: DataFrame) -> DataFrame:
    """(doc, digest, starts) of the windows whose words also start earlier, for documents with any."""
    phrases = phrase_rows(docs)
    recurring = phrases.groupBy("phrase").agg(F.min(F.struct("doc", "digest")).alias("first"), F.count("*").alias("n")).filter("n > 1")
    shares = stored(
        phrases.join(recurring.select("phrase", F.col("first.doc").alias("first_doc"), F.col("first.digest").alias("first_digest")), "phrase")
        .groupBy("first_doc", "first_digest", "doc", "digest")
        .agg(F.collect_set("phrase").alias("phrases")),  # at most the phrases of one document
        "phrase-shares",
    )
    first = ["first_doc", "first_digest"]
    is_first = (F.col("doc") == F.col("first_doc")) & (F.col("digest") == F.col("first_digest"))
    parts = shares.groupBy(*first).agg(F.ceil(F.count("*") / DOCUMENTS_A_TASK).cast("int").alias("parts"))
    split = shares.join(parts.filter("parts > 1"), first, "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    part = F.when(is_first, F.sequence(F.lit(0), F.col("parts") - 1)).otherwise(F.array(F.pmod(F.xxhash64("doc", "digest"), F.col("parts")).cast("int")))
    placed = split.select(*first, "doc", "digest", "phrases", F.explode(part).alias("part"))
    texts = docs.select("doc", "digest", "text")
    routed = (
        cut_to_passages(texts.join(placed, ["doc", "digest"]))
        .withColumn("later", ~is_first)
        .repartition(*first, "part")
        .sortWithinPartitions(*first, "part", "later", "doc", "digest")
    )
    found = stored(locate(routed), "phrase-windows")
    windows = found.select("doc", "digest", F.explode(F.arrays_zip("starts", "highs", "lows")).alias("w")).select("doc", "digest", "w.*")
    place = F.struct("doc", "digest", "starts")
    several = windows.groupBy("highs", "lows").agg(F.min(place).alias("least"), F.max(place).alias("most")).filter("least < most")
    later = windows.join(several, ["highs", "lows"]).filter(place > F.col("least")).select("doc", "digest", F.col("starts").alias("start"))
    known = found.select("doc", "digest", F.explode("earlier").alias("start"))
    return known.unionByName(later).groupBy("doc", "digest").agg(F.collect_set("start").alias("starts"))


def drop_repeats(text: str | None, starts: list[int] | None) -> tuple[int, int, str]:
    words = split_words(text)
    if not starts:
        return len(words), 0, b" ".join(words).decode("utf-8", "surrogatepass")
    edges = np.zeros(len(words) + 1, dtype=np.int64)
    edges[np.array(starts)] += 1
    edges[np.array(starts) + WINDOW] -= 1
    keep = np.flatnonzero(np.cumsum(edges[:-1]) == 0).tolist()
    kept = b" ".join([words[i] for i in keep]).decode("utf-8", "surrogatepass")
    return len(words), len(words) - len(keep), kept


def without_repeats(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, n_removed and the kept words joined by one blank."""
    keyed = doc_columns(docs, "doc_id", "text").select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc"),
        # Rows of one doc_id are few; rows without one are told apart by 128 bits.
        F.when(F.col("doc_id").isNull(), F.coalesce(F.md5("text"), F.lit(""))).otherwise(F.hash("text").cast("string")).alias("digest"),
        "doc_id",
        "text",
    )
    starts = earlier_windows(keyed.select("doc", "digest", "text"))

    def dropped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [drop_repeats(t.as_py(), s.as_py()) for t, s in zip(batch.column(1), batch.column(2))]
            n_words, n_removed, kept = zip(*rows) if rows else ((), (), ())
            columns = [batch.column(0), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(kept, pa.string())]
            yield pa.record_batch(columns, names=["doc_id", "n_words", "n_removed", "kept"])

    joined = keyed.join(starts, ["doc", "digest"], "left").select(F.col("doc_id").cast("long"), "text", "starts")
    return joined.mapInArrow(dropped, "doc_id long, n_words long, n_removed long, kept string")


def repeat_report(docs: DataFrame) -> DataFrame:
    return without_repeats(docs).select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
