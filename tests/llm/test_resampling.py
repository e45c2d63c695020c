"""Substring CRCs against zlib; weights, scores and ranks against plain recomputation."""

import hashlib
import math
import re
from collections import Counter
from zlib import crc32

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm.conftest import SF
from turnstile.llm import crc, queries, resampling

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def split(text):
    return WORDS.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def runs(text, max_n=2):
    w = split(text)
    return [" ".join(w[i : i + n]) for n in range(1, max_n + 1) for i in range(len(w) - n + 1)]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.binary(min_size=1, max_size=400).map(lambda b: b.replace(b" ", b"_")), max_size=12), st.integers(1, 4))
def test_crc_of_every_run(words, n):
    found = crc.RunningCrcs(words).of_runs(n).tolist()
    assert found == [crc32(b" ".join(words[i : i + n])) for i in range(len(words) - n + 1)]


def test_crc_of_long_words():
    words = [b"a" * n for n in (1, 127, 128, 129, 70_000, 3, 1 << 20)]
    assert crc.RunningCrcs(words).of_runs(2).tolist() == [crc32(a + b" " + b) for a, b in zip(words, words[1:])]
    assert len(crc.RunningCrcs([]).of_runs(2)) == 0


def expected(docs, target, percent=25, seed=7):
    """Rows of (doc_id, n_features, weight, score, rank) as lists, ties by doc_id with null last."""
    s, t = (Counter(crc32(f.encode()) % 10_000 for text in side for f in runs(text)) for side in ([d[1] for d in docs], target))
    all_s, all_t = sum(s.values()) + 10_000, sum(t.values()) + 10_000
    gain = [math.floor(1000 * math.log((t[b] + 1) * all_s / ((s[b] + 1) * all_t))) for b in range(10_000)]
    rows = []
    for i, text in docs:
        gains = [gain[crc32(f.encode()) % 10_000] for f in runs(text)]
        weight = sum(gains) // len(gains) if gains else 0
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        noise = math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([i, len(gains), weight, weight + noise, None, len(split(text))])
    order = sorted((r for r in rows if r[5] >= 20), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1]))
    for place, row in enumerate(order[: percent * len(order) // 100], 1):
        row[4] = place
    return [tuple(r[:5]) for r in rows]


def by_text(rows):
    return sorted(rows, key=str)


def test_query_on_whole_tables(spark, documents, texts):
    benchmark = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    found = queries.queries()["op13_prefix_crc"](spark, SF).select("doc_id", "n_features", "weight", "score", "rank").collect()
    assert by_text(tuple(r) for r in found) == by_text(expected(list(texts.items()), benchmark))


@pytest.mark.parametrize("percent", [0, 25, 60, 100])
def test_odd_rows(spark, odd, benchmark, percent):
    """Nulls, empties, long texts, rows that repeat (one of them often) and rows without id."""
    extra = spark.createDataFrame([(77, "copy of a line that is long enough " * 5)] * 40, "doc_id long, text string")
    docs = odd.unionByName(extra, allowMissingColumns=True)
    found = resampling.resample(docs, benchmark, percent=percent).collect()
    data = [(r.doc_id, r.text) for r in docs.collect()]
    want = expected(data, [r.text for r in benchmark.collect()], percent)
    assert by_text(tuple(r) for r in found) == by_text(want)
    ranks = sorted(r["rank"] for r in found if r["rank"] is not None)
    assert ranks == list(range(1, len(ranks) + 1))


def test_empty_tables(odd, benchmark):
    assert resampling.resample(odd.limit(0), benchmark).collect() == []
    found = resampling.resample(odd, benchmark.limit(0)).collect()
    assert len(found) == odd.count()


def test_slices_do_not_change_results(spark, monkeypatch):
    texts = [None, "", "one two", "Three  FOUR five", "é-ñ 日本 six"] * 7
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    gains = np.arange(10_000)
    whole = sorted(map(tuple, resampling.weigh(docs, gains, 3).collect()))
    monkeypatch.setattr(resampling, "SLICE_BYTES", 10)
    assert sorted(map(tuple, resampling.weigh(docs, gains, 3).collect())) == whole
