"""Exact vector search against plain recomputation, on odd vectors and in small tiles."""

import math
from collections import defaultdict

import numpy as np
import pytest

from turnstile.llm import vector_search

SCHEMA = "vec_id long, embedding array<double>, score string, copies string, vector string"
END = 2**63 - 1


def plain(rows, k=5, every=50):
    """Expected (query_id, rank, vec_id, score), queries that repeat as a whole once."""
    whole = lambda x: min(max(math.floor(256 * x), -END - 1), END)
    usable = [(i, [whole(x) for x in v]) for i, v in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    found, done = [], set()
    for n, (i, v) in enumerate(usable):
        if i is None or i % every or (i, tuple(v)) in done:
            continue
        done.add((i, tuple(v)))
        scores = [(-min(max(sum(a * b for a, b in zip(v, w)), -END - 1), END), j is None, j or 0, j) for m, (j, w) in enumerate(usable) if m != n]
        found += [(i, r, j, -s) for r, (s, _, _, j) in enumerate(sorted(scores, key=lambda t: t[:3])[:k], 1)]
    return sorted(found, key=str)


def search(spark, rows, schema=SCHEMA, **options):
    frame = spark.createDataFrame([(i, v, "x", "y", "z") for i, v in rows], schema)
    return sorted((tuple(r) for r in vector_search.nearest_vectors(frame, **options).collect()), key=str)


def test_odd_vectors(spark):
    rows = [
        (0, [0.5, -0.25, 0.1]), (0, [0.5, -0.25, 0.1]), (0, [0.1]), (50, []), (50, [1.0, 1.0, 1.0, 1.0]), (100, None),
        (150, [math.nan, 1.0]), (151, [math.inf]), (152, [None, 1.0]), (None, [0.5, 0.5, 0.5]), (None, [0.5, 0.5, 0.5]),
        (7, [0.5, 0.5, 0.5]), (8, [0.5, 0.5, 0.5]), (9, [-3.0, 0.0, 2.0]), (200, [0.001, -0.001]),
    ]
    assert search(spark, rows) == plain(rows)
    assert search(spark, rows, k=2) == plain(rows, 2)
    assert search(spark, []) == []
    assert search(spark, [(1, [1.0])]) == []
    assert search(spark, [(50, [1.0])]) == []


def test_values_beyond_doubles_and_long(spark):
    rows = [(i, [(-1.0) ** i * 10.0**i, 3e7 + i / 256, 2e13]) for i in range(0, 26)] + [(50, [1e30, -1e30, 1.0]), (100, [12345678.5, 4e13 + 1, 1e12])]
    assert search(spark, rows) == plain(rows)


def test_a_third_of_all_rows_is_one_vector(spark):
    rows = [(50, [0.3, 0.4])] * 300 + [(i, [i / 100, 0.5]) for i in range(600)]
    assert search(spark, rows) == plain(rows)


@pytest.mark.parametrize("seed", range(3))
def test_tiles_chunks_and_ties(spark, monkeypatch, seed):
    """Many tiles, blocks and chunks; few distinct values, so that many scores are equal."""
    monkeypatch.setattr(vector_search, "BLOCK", 3)
    for name, value in {"CELLS": 1 << 12, "LEAST_ROWS": 64, "QUERY_TILE": 5, "TILE": 32, "FIRST_TILE": 4}.items():
        monkeypatch.setattr(vector_search, name, value)
    random = np.random.default_rng(seed)
    values = random.integers(-2, 3, (700, 20)) / 256 if seed else random.normal(size=(700, 20))
    rows = [(int(i), v.tolist()) for i, v in zip(random.permutation(700), values)]
    assert search(spark, rows, every=20) == plain(rows, every=20)


def test_bounds_rule_candidates_out(monkeypatch):
    """On clustered vectors most pairs end before their last block."""
    random = np.random.default_rng(1)
    centres = random.normal(size=(20, 64))
    rows = np.floor(256 * (centres[random.integers(0, 20, 4000)] + 0.3 * random.normal(size=(4000, 64)))).astype(np.int64)
    chunk = vector_search.Chunk(rows, np.arange(4000), rows[:50])
    whole = defaultdict(int)
    living = vector_search.Chunk.living

    def counted(self, qs, cs, least):
        found = living(self, qs, cs, least)
        whole["pairs"] += len(found[0])
        return found

    monkeypatch.setattr(vector_search.Chunk, "living", counted)
    q, row, score = chunk.nearest(np.arange(50), np.ones(4000, dtype=np.int64), 5)
    scores = rows[:50] @ rows.T
    scores[np.arange(50), np.arange(50)] = -(2**62)
    assert score.tolist() == (-np.sort(-scores, axis=1)[:, :5]).ravel().tolist()
    assert whole["pairs"] < 0.1 * 50 * 4000
