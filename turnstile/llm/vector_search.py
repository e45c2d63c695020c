"""Exact nearest vectors by inner product: branch and bound over dimensions stored column by column.

Components become integers, ``floor(256 * x)``. Vectors and queries are dealt into a grid: every task holds one bounded
chunk of vectors and one bounded group of queries, however large either side is; nothing is broadcast. A task keeps its
chunk vertically, one row per dimension, heaviest dimensions first, and adds up inner products for a block of dimensions
at a time. What the remaining dimensions can still add is at most the product of the two remaining masses (Cauchy and
Schwarz), so a candidate whose sum so far plus that bound stays below the query's k-th best score so far is out. While
many candidates live, sums run over the whole tile; once few do, they are compacted to (query, candidate) pairs and only
those go on. Nothing is approximate: a bound of equality survives, as ties go to the smaller vec_id.

Defined results: vectors that are null or hold a null or non-finite component take no part. Vectors of unequal length
are compared as if the shorter ended in zeros. Rows that repeat with vec_id and vector are candidates each; as queries
they are answered once. Rows of one vec_id with different vectors are queries each. A row without vec_id is no query; as
a candidate it comes last among equal scores. Integers and scores beyond 64 bits stop at the ends of ``long``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from turnstile.llm.common import stored

SCALE = 256
BLOCK = 16  # dimensions between two bounds
CELLS = 1 << 22  # components of a task's chunk, and of its queries
LEAST_ROWS = 1 << 10  # a chunk of fewer rows is not worth a task
QUERY_TILE, TILE, FIRST_TILE = 256, 4096, 128
DENSE = 0.1  # share of living candidates from which a whole tile is summed
ROUNDING = 1 + 1e-12
LONG = np.iinfo(np.int64)


def integer_vectors(vectors: DataFrame) -> DataFrame:
    """Distinct (vec_id, vector of integers) with the number of rows that hold it."""
    x = F.col("embedding")
    bad = F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c.cast("double")) == F.lit(math.inf)))
    whole = F.transform(x, lambda c: F.floor(F.lit(SCALE) * c.cast("double")).cast("bigint"))
    usable = vectors.select("vec_id", "embedding").where(x.isNotNull() & ~F.coalesce(bad, F.lit(True)))
    return usable.select("vec_id", whole.alias("vector")).groupBy("vec_id", "vector").agg(F.count(F.lit(1)).alias("copies"))


def matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    """Lists of integers as rows, shorter ones ending in zeros."""
    lists = column.combine_chunks()
    lengths = np.diff(lists.offsets.to_numpy())
    rows = np.zeros((len(lists), width), dtype=np.int64)
    rows[np.arange(width) < lengths[:, None]] = lists.flatten().to_numpy()
    return rows


class Chunk:
    """Vectors of one task in vertical layout with what is needed to bound and to rank them."""

    def __init__(self, rows: np.ndarray, id_order: np.ndarray, queries: np.ndarray):
        width = rows.shape[1]
        mass = (rows.astype(float) ** 2).sum(axis=0) * (queries.astype(float) ** 2).sum(axis=0)
        dims = np.argsort(-mass, kind="stable")
        heavy = np.argsort(-(rows.astype(float) ** 2).sum(axis=1), kind="stable")
        self.place = heavy  # position in this layout -> row
        self.rows, self.query_rows = rows, queries
        self.columns = np.ascontiguousarray(rows[heavy][:, dims].T.astype(float))
        self.queries = queries[:, dims].astype(float)
        self.cuts = [*range(0, width, BLOCK), width]
        self.rest = np.array([np.sqrt((self.columns[c:] ** 2).sum(axis=0)) for c in self.cuts])
        self.query_rest = np.array([np.sqrt((self.queries[:, c:] ** 2).sum(axis=1)) for c in self.cuts])
        self.id_order = id_order[heavy]
        top = float(np.abs(rows).max(initial=0)) * float(np.abs(queries).max(initial=0)) * max(width, 1)
        self.exact = top < 2**53
        # Sums of doubles beyond 53 bits are off by this share of the masses at most.
        self.slack = 0.0 if self.exact else 4e-16 * max(width, 1)

    def scores(self, q: np.ndarray, c: np.ndarray, sums: np.ndarray) -> np.ndarray:
        """Exact scores of pairs; beyond 53 bits the integers are multiplied out."""
        if self.exact:
            return sums.astype(np.int64)
        pairs = zip(self.query_rows[q].tolist(), self.rows[self.place[c]].tolist(), strict=True)
        return np.array([min(max(sum(map(int.__mul__, a, b)), LONG.min), LONG.max) for a, b in pairs], dtype=np.int64)

    def living(self, qs: slice, cs: slice, least: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Pairs of a tile that no bound has ruled out, with their whole sums."""
        last = len(self.cuts) - 1
        sums = np.zeros((qs.stop - qs.start, cs.stop - cs.start))
        rest, query_rest = self.rest[:, cs], self.query_rest[:, qs]
        floor = least[qs]
        error = self.slack * query_rest[0][:, None] * rest[0]
        block, alive = 0, np.ones(sums.shape, dtype=bool)
        while block < last:
            dims = slice(self.cuts[block], self.cuts[block + 1])
            sums += self.queries[qs, dims] @ self.columns[dims, cs]
            block += 1
            alive = sums + query_rest[block][:, None] * rest[block] * ROUNDING + error >= floor[:, None]
            if alive.mean() < DENSE:
                break
        q, c = np.nonzero(alive)
        sums = sums[q, c]
        while block < last:
            for dim in range(self.cuts[block], self.cuts[block + 1]):
                sums += self.queries[q + qs.start, dim] * self.columns[dim, c + cs.start]
            block += 1
            more = query_rest[block][q] * rest[block][c] * ROUNDING + self.slack * query_rest[0][q] * rest[0][c]
            keep = sums + more >= floor[q]
            q, c, sums = q[keep], c[keep], sums[keep]
        return q + qs.start, c + cs.start, sums

    def nearest(self, own: np.ndarray, copies: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query, row, score) of the k best candidates of every query, all copies of a row as one.

        ``own`` is the row of each query itself, or -1; it is no candidate unless it has copies.
        """
        count, total = self.columns.shape[1], len(self.queries)
        alone = np.where((own >= 0) & (copies[own] == 1), own, -1)
        found = [np.empty(0, dtype=np.int64)] * 3
        for start in range(0, total, QUERY_TILE):
            qs = slice(start, min(start + QUERY_TILE, total))
            best, least = [np.empty(0, dtype=np.int64)] * 3, np.full(total, -np.inf)
            at, size = 0, FIRST_TILE
            while at < count:
                cs = slice(at, min(at + size, count))
                q, c, sums = self.living(qs, cs, least)
                keep = self.place[c] != alone[q]
                q, c, sums = q[keep], c[keep], sums[keep]
                best = [np.concatenate(pair) for pair in zip(best, (q, c, self.scores(q, c, sums)), strict=True)]
                order = np.lexsort((self.id_order[best[1]], ~best[2], best[0]))  # ~ turns the order round, without overflow
                best = [x[order] for x in best]
                starts = np.flatnonzero(np.diff(best[0], prepend=-1))
                number = np.arange(len(best[0])) - np.repeat(starts, np.diff(starts, append=len(best[0])))
                kth = number == k - 1
                error = self.slack * self.query_rest[0][best[0][kth]] * self.rest[0].max()
                least[best[0][kth]] = best[2][kth].astype(float) - error
                best = [x[number < k] for x in best]
                at, size = cs.stop, min(2 * size, TILE)
            found = [np.concatenate(pair) for pair in zip(found, best, strict=True)]
        return found[0], self.place[found[1]], found[2]


def id_ranks(ids: pa.ChunkedArray) -> np.ndarray:
    """Place of each vec_id in ascending order, rows without one last."""
    missing = ids.is_null().to_numpy()
    values = ids.fill_null(0).to_numpy()
    ranks = np.empty(len(values), dtype=np.int64)
    ranks[np.lexsort((values, missing))] = np.arange(len(values))
    return ranks


def own_rows(left: pa.Table, rows: np.ndarray, right: pa.Table, queries: np.ndarray) -> np.ndarray:
    """The row of each query in this chunk, or -1."""
    ids, query_ids = left["vec_id"].to_pylist(), right["vec_id"].to_pylist()
    asked = set(query_ids)
    lengths = [len(v) for v in left["vector"]]
    at = {(i, lengths[n], rows[n].tobytes()): n for n, i in enumerate(ids) if i in asked}
    keys = zip(query_ids, (len(v) for v in right["vector"]), (q.tobytes() for q in queries), strict=True)
    return np.array([at.get(key, -1) for key in keys], dtype=np.int64)


def nearest_rows(left: pa.Table, right: pa.Table, k: int) -> tuple[list, list, list, list]:
    """Per query of ``right``: its best rows of ``left``, a row with copies as often as they count."""
    width = max(max((len(v) for v in t["vector"]), default=0) for t in (left, right))
    rows, queries = matrix(left["vector"], width), matrix(right["vector"], width)
    own, copies = own_rows(left, rows, right, queries), left["copies"].to_numpy()
    q, row, score = Chunk(rows, id_ranks(left["vec_id"]), queries).nearest(own, copies, k)
    times = np.minimum(copies[row] - (row == own[q]), k)
    q, row, score = (np.repeat(x, times) for x in (q, row, score))
    ids, texts = right["vec_id"].take(pa.array(q)), right["digest"].take(pa.array(q))
    return ids, texts, left["vec_id"].take(pa.array(row)), pa.array(score)


def dealt(rows: int, width: int, tasks: int) -> int:
    """Number of chunks: of bounded size, and for small tables as many as there are tasks to run at once."""
    return max(1, math.ceil(rows * max(width, 1) / CELLS), min(math.ceil(rows / LEAST_ROWS), tasks))


def nearest_vectors(vectors: DataFrame, every: int = 50, k: int = 5) -> DataFrame:
    """The ``k`` best other rows of each row whose vec_id is divisible by ``every``."""
    spark = vectors.sparkSession
    grouped = stored(integer_vectors(vectors), "search-vectors")
    asked = F.col("vec_id") % every == 0
    size = grouped.agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(asked).alias("asked"), F.coalesce(F.max(F.size("vector")), F.lit(0)).alias("width")
    ).first()
    chunks = dealt(size["rows"], size["width"], 2 * spark.sparkContext.defaultParallelism)
    groups = dealt(size["asked"], size["width"], 1)
    keys = ["chunk", "query_group"]
    everywhere = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    candidates = grouped.select(
        "*", F.pmod(F.xxhash64("vec_id", "vector"), F.lit(chunks)).cast("int").alias("chunk"), everywhere(groups).alias("query_group")
    )
    queries = grouped.where(asked).select(
        "vec_id", "vector", F.xxhash64("vector").alias("digest"), everywhere(chunks).alias("chunk"),
        F.pmod(F.xxhash64("vector", "vec_id"), F.lit(groups)).cast("int").alias("query_group"),
    )
    kind = vectors.schema["vec_id"].dataType.simpleString()
    names = ["query_id", "digest", "vec_id", "score"]

    def work(left: pa.Table, right: pa.Table) -> pa.Table:
        if not len(left) or not len(right):
            return pa.table({n: pa.array([], type=t) for n, t in zip(names, (left["vec_id"].type, pa.int64(), left["vec_id"].type, pa.int64()))})
        return pa.table(dict(zip(names, nearest_rows(left, right, k), strict=True)))

    pairs = candidates.groupBy(*keys).cogroup(queries.groupBy(*keys)).applyInArrow(
        work, f"query_id {kind}, digest long, vec_id {kind}, score long"
    )
    best = Window.partitionBy("query_id", "digest").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    ranked = pairs.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
