"""Ranked lexical search against plain recomputation, on odd rows, small segments and several blocks of items."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from tests.llm.conftest import SF
from turnstile.llm import lexical_search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def split(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain(docs, items, k=50):
    bags = [(i, Counter(split(text))) for i, text in docs if split(text)]
    count, length = len(bags), sum(sum(bag.values()) for _, bag in bags)
    df = Counter(t for _, bag in bags for t in bag)
    w = {t: math.floor(1000 * math.log((2 * count + 2) / (2 * d + 1))) for t, d in df.items()}
    found = []
    for item, text in {(i, t) for i, t in items}:
        scored = []
        for i, bag in bags:
            m = 50 + (50 * sum(bag.values()) * count) // length
            score = sum(w[t] * ((10**9 * bag[t]) // (1000 * bag[t] + 20 * m)) for t in set(split(text)) & set(bag))
            if score > 0:
                scored.append((-score, i is None, i or 0, i))
        found += [(item, r, s[3], -s[0]) for r, s in enumerate(sorted(scored, key=lambda s: s[:3])[:k], 1)]
    return sorted(found, key=str)


def search(docs, items, k=50):
    return sorted((tuple(r) for r in lexical_search.ranked_documents(docs, items, k).collect()), key=str)


def pairs(frame):
    return [tuple(r) for r in frame.select(frame.columns[0], "text").collect()]


def test_whole_tables(spark, documents):
    items = spark.read.parquet(f"{SF}/benchmark.parquet")
    found = search(documents, items)
    assert found == plain(pairs(documents), pairs(items)) and len(found) > 100


def test_odd_rows(spark, odd, benchmark):
    more = [(7, "word3 of1 日本 É"), (7, "of2 of2 word4"), (None, "x-y a_b A"), (8, "..."), (9, "absent"), (1, None), (7, "of2 of2 word4")]
    items = benchmark.unionByName(spark.createDataFrame(more, "item_id long, text string"))
    assert search(odd, items) == plain(pairs(odd), pairs(items))
    assert search(odd, items, 2) == plain(pairs(odd), pairs(items), 2)


def test_empty_tables(odd, benchmark):
    assert search(odd.limit(0), benchmark) == search(odd, benchmark.limit(0)) == search(odd.limit(0), benchmark.limit(0)) == []


@pytest.mark.parametrize("seed", range(2))
def test_segments_blocks_and_ties(spark, monkeypatch, seed):
    """Several segments a task and blocks of items; many documents of the same score, copies for a third."""
    for name, value in {"SEGMENT_POSTINGS": 300, "SEGMENT_DOCS": 60, "BLOCK_TERMS": 40, "AT_ONCE": 8}.items():
        monkeypatch.setattr(lexical_search, name, value)
    r = random.Random(seed)
    word = lambda: f"w{min(int(r.expovariate(0.2)), 40)}"
    copy = "w1 w2 w9 w9"
    texts = [copy if r.random() < 0.33 else " ".join(word() for _ in range(r.randint(0, 12))) for _ in range(500)]
    docs = spark.createDataFrame(list(zip(r.sample(range(10_000), 500), texts)), "doc_id long, text string").repartition(3)
    items = spark.createDataFrame([(i, " ".join(word() for _ in range(8))) for i in range(20)] + [(99, copy)], "item_id long, text string")
    assert search(docs, items, 10) == plain(pairs(docs), pairs(items), 10)


def test_bounds_spare_documents():
    """A rare term's documents are found by visiting few of the documents that share common terms."""
    r = np.random.default_rng(0)
    size = 4000
    bags = [sorted({0: 1, 1: int(r.integers(1, 3)), **({2: 3} if i % 400 == 7 else {})}.items()) for i in range(size)]
    packed = lambda k: [np.array([b[k] for b in bag], dtype="<u4").tobytes() for bag in bags]
    weights = np.array([5, 300, 6000])
    visited = []
    segment = lexical_search.Segment(np.arange(size), np.full(size, 20), packed(0), packed(1), weights, size, 20 * size)
    bounded = segment.bounded
    segment.bounded = lambda start, left, right: visited.append(len(start)) or bounded(start, left, right)
    empty = np.empty(0, dtype=np.int64)
    scores, ids = segment.search(np.array([0, 1, 2]), empty, empty, 5)
    assert all(i % 400 == 7 for i in ids) and len(ids) == 5
    assert sum(visited) / 2 < size / 4
