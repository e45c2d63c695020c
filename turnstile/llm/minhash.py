"""Near duplicates by an inverted join on MinHash signature coordinates.

Documents with equal shingle sets become one node. Every node is posted under each (coordinate, value) pair of its
signature. Postings are ordered by how many nodes they hold: nodes that agree in at least ``matches`` coordinates
share one of each other's rarest ``coordinates - matches + 1`` postings, so only this prefix is joined, and a pair
that shares several is taken at the first and skipped at the others. Pairs with enough collisions are confirmed on
their full shingle sets: of the last candidates first the likeliest of each node, and then only those whose nodes are
still in different components.

A posting of many nodes is not joined with itself. All its nodes are first compared with one of them, the one whose
postings hold most nodes: in a group of copies that is the text they were made from. Only nodes that are in different
components after that are compared with each other, and those inside tasks: a posting is dealt in blocks of bounded size,
each task merges the signatures of two blocks, and no row is made of a pair that is not a candidate. A first pass over
the signatures only names the nodes with a candidate; a second one has the least ``SAMPLE`` digests of their sets as
well, which decide for sets of that size and rule out most larger ones. So no link between components is lost.

At the default of 32 coordinates and 12 matches, a pair of similarity 0.8 is missed with a chance below 1e-7. Node
keys and shingles are 64-bit digests. Null texts and texts without words have an empty set, are linked with nothing
and are kept. Rows with equal doc_id and text share their result; rows without doc_id belong to their component, and
are kept only where no row of it has one. Other columns are never read.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turnstile.llm.common import discard, doc_columns, run_hashes, split_words, stored, word_hashes
from turnstile.llm.components import connected_components

COORDINATES = 32
MATCHES = 12
THRESHOLD_PERCENT = 80
_RANDOM = np.random.default_rng(20240131)
FACTORS = _RANDOM.integers(1 << 63, size=256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
SHIFTS = _RANDOM.integers(1 << 63, size=256, dtype=np.uint64)
ROWS_AT_ONCE = 4096
SETS_AT_ONCE = 500
#: Nodes of a block, pairs compared at once, digests of a set's sample, and standard deviations that samples may err by.
BLOCK, PAIRS_AT_ONCE, SAMPLE, DEVIATIONS = 1024, 1 << 18, 256, 5.3
#: Places of the filter that spares most documents the second computation of their set (4 MB), and of one part of it.
ID_BITS, BITMAP = 1 << 25, 1 << 15


def shingle_set(text: str | None, width: int) -> np.ndarray:
    """Sorted digests of the distinct shingles of ``width`` words; of the whole sequence if it is shorter."""
    words = split_words(text.translate(LOWER) if text else None)
    if not words:
        return np.zeros(0, dtype=np.uint64)
    return np.unique(run_hashes(word_hashes(words), min(width, len(words))))


# Only A-Z are lower-cased.
LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


def set_key(shingles: np.ndarray) -> int | None:
    if not len(shingles):
        return None
    return int.from_bytes(blake2b(shingles.tobytes(), digest_size=8).digest(), "little", signed=True)


def signature(shingles: np.ndarray, coordinates: int) -> np.ndarray:
    """The least value of each of ``coordinates`` random functions over a set that is not empty."""
    least = np.full(coordinates, np.iinfo(np.uint64).max, dtype=np.uint64)
    for i in range(0, len(shingles), ROWS_AT_ONCE):
        values = shingles[i : i + ROWS_AT_ONCE, None] * FACTORS[:coordinates] + SHIFTS[:coordinates]
        np.minimum(least, values.min(axis=0), out=least)
    return least


def sign(docs: DataFrame, width: int, coordinates: int) -> DataFrame:
    """Per row: doc_id, n_shingles, node (null for an empty set) and the postings of its signature."""

    def signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pa.default_memory_pool().release_unused()
        places = np.arange(coordinates, dtype=np.uint64) << np.uint64(32)
        for batch in batches:
            sizes, nodes, postings = [], [], []
            for text in batch.column(1):
                shingles = shingle_set(text.as_py(), width)
                sizes.append(len(shingles))
                nodes.append(set_key(shingles))
                found = (signature(shingles, coordinates) >> np.uint64(32)) | places if len(shingles) else np.zeros(0)
                postings.append(found.astype(np.int64))
            columns = [batch.column(0), pa.array(sizes, pa.int64()), pa.array(nodes, pa.int64()), pa.array(postings, pa.list_(pa.int64()))]
            yield pa.record_batch(columns, names=["doc_id", "n_shingles", "node", "postings"])

    return docs.mapInArrow(signed, "doc_id long, n_shingles long, node long, postings array<long>")


def id_bits(ids: DataFrame) -> np.ndarray:
    """A Bloom filter of one function over doc_id, of fixed size: which of :data:`ID_BITS` places hold an id."""
    place = id_place(F.col("doc_id"))
    parts = ids.groupBy((place / BITMAP).cast("long").alias("part")).agg(F.bitmap_construct_agg(place % BITMAP).alias("bits"))
    bits = np.zeros(ID_BITS, dtype=bool)
    for row in parts.collect():  # at most ID_BITS / BITMAP rows of BITMAP / 8 bytes
        bits[row.part * BITMAP : (row.part + 1) * BITMAP] = np.unpackbits(np.frombuffer(row.bits, np.uint8), bitorder="little")
    return np.packbits(bits)


def id_place(doc_id: Column) -> Column:
    return F.pmod(F.xxhash64(doc_id), F.lit(ID_BITS).cast("long"))


def full_sets(docs: DataFrame, wanted: DataFrame, width: int, least: int | None = None) -> DataFrame:
    """(node, shingles) of at least the nodes of ``wanted``: the filter over their doc_id lets some others pass.

    With ``least``, only that many digests of each set, the smallest of the digests' upper halves.
    """
    bits = id_bits(wanted)

    def computed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pa.default_memory_pool().release_unused()  # what earlier work left in this worker
        for batch in batches:
            place = batch.column(0).to_numpy()
            texts = batch.column(1).filter(pa.array(bits[place >> 3] >> (7 - (place & 7)).astype(np.uint8) & 1 == 1))
            for i in range(0, len(texts), SETS_AT_ONCE):
                sets = [shingle_set(text.as_py(), width) for text in texts.slice(i, SETS_AT_ONCE)]
                nodes = pa.array(map(set_key, sets), pa.int64())
                if least:
                    sets = [np.unique(x >> np.uint64(32))[:least] for x in sets]
                yield pa.record_batch([nodes, pa.array([s.astype(np.int64) for s in sets], pa.list_(pa.int64()))], names=["node", "shingles"])

    sets = docs.select(id_place(F.col("doc_id")), "text").mapInArrow(computed, "node long, shingles array<long>")
    return sets.filter("node is not null")


def similar_sizes(a: Column, b: Column, percent: int) -> Column:
    """Sets of these sizes can reach the similarity."""
    return (100 * a >= percent * b) & (100 * b >= percent * a)


def confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets have at least ``percent`` % of their union in common."""
    left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("set_a"))
    right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("set_b"))
    common = F.size(F.array_intersect("set_a", "set_b"))
    joined = pairs.join(left, "a").join(right, "b")
    return joined.filter(100 * common >= percent * (F.size("set_a") + F.size("set_b") - common)).select("a", "b")


def by_halves(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that 31 bits of the digests do not rule out: half of what :func:`confirm` moves.

    Two digests of a set can coincide in them, so as many more may be common as there are fewer of them.
    """
    cut = F.array_distinct(F.transform("shingles", lambda d: d.bitwiseAND(F.lit(0x7FFFFFFF).cast("long")).cast("int")))
    short = sets.select("node", F.size("shingles").alias("size"), cut.alias("halves"))
    left, right = (short.select(*[F.col(c).alias(n) for c, n in zip(short.columns, names)]) for names in (("a", "size_a", "set_a"), ("b", "size_b", "set_b")))
    missing = F.least(F.col("size_a") - F.size("set_a"), F.col("size_b") - F.size("set_b"))
    common = F.size(F.array_intersect("set_a", "set_b")) + missing
    joined = pairs.join(left, "a").join(right, "b")
    return joined.filter(100 * common >= percent * (F.col("size_a") + F.col("size_b") - common)).select("a", "b")


def likeliest(pairs: DataFrame) -> DataFrame:
    """The pair of each node that seems most alike."""
    ends = pairs.select(F.col("a").alias("node"), "*").union(pairs.select(F.col("b").alias("node"), "*"))
    best = ends.groupBy("node").agg(F.max_by(F.struct("a", "b"), F.struct("alike", "a", "b")).alias("best"))
    return best.select("best.*").distinct()


def between(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """The pairs (a, b) whose nodes are in different components; a node without label is its own."""
    of = lambda c: labels.select(F.col("node").alias(c), F.col("component").alias(f"of_{c}"))
    named = pairs.select("a", "b").join(of("a"), "a", "left").join(of("b"), "b", "left")
    return named.filter(F.coalesce("of_a", "a") != F.coalesce("of_b", "b")).select("a", "b")


def prefixes(nodes: DataFrame, coordinates: int, matches: int) -> DataFrame:
    """(node, weight, shared, prefix) of nodes that have a posting of another node in their prefix.

    ``weight`` is how many nodes all its postings hold together. ``shared`` has all postings with several nodes. Postings of one node are the rarest; they take up the prefix first.
    """
    posted = nodes.select("node", F.explode("postings").alias("posting"))
    counts = posted.groupBy("posting").count().filter("count > 1")
    ranked = (
        posted.join(counts, "posting")
        .groupBy("node")
        .agg(
            F.sort_array(F.collect_list(F.struct("count", "posting"))).alias("ranked"),  # at most one per coordinate
            F.sum("count").alias("weight"),
        )
    )
    length = F.size("ranked") - matches + 1  # the prefix of all coordinates, less postings of this node alone
    return ranked.filter(length > 0).select(
        "node",
        "weight",
        F.col("ranked.posting").alias("shared"),
        F.slice(F.col("ranked.posting"), F.lit(1), length).alias("prefix"),
    )


def colliding(posted: DataFrame, chosen: DataFrame, shared: DataFrame, matches: int, percent: int) -> DataFrame:
    """Pairs (a, b), once each, of a node and the chosen nodes of its postings with enough collisions."""
    other = chosen.select("posting", *[F.col(c).alias(f"{c}_b") for c in ("node", "size", "component")])
    pairs = (
        posted.join(other, "posting")
        .filter((F.col("component") != F.col("component_b")) & similar_sizes(F.col("size"), F.col("size_b"), percent))
        .select(F.least("node", "node_b").alias("a"), F.greatest("node", "node_b").alias("b"))
        .distinct()
    )
    left = shared.select(F.col("node").alias("a"), F.col("shared").alias("shared_a"))
    right = shared.select(F.col("node").alias("b"), F.col("shared").alias("shared_b"))
    joined = pairs.join(left, "a").join(right, "b")
    return joined.filter(F.size(F.array_intersect("shared_a", "shared_b")) >= matches).select("a", "b")


def in_blocks(posted: DataFrame) -> DataFrame:
    """Every row under each pair of blocks of its posting that its own block belongs to: any two rows meet in one."""
    blocks = posted.groupBy("posting").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    block = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    own = posted.join(blocks, "posting").withColumn("block", block)
    dealt = own.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    first, second = F.least("block", "other").alias("first"), F.greatest("block", "other").alias("second")
    return dealt.select(*[c for c in own.columns if c != "blocks"], first, second)


def whole_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Sorted rows in tables that end with a group, and where each row's group starts."""
    kept: list[pa.RecordBatch] = []
    keys = lambda t: np.stack([t.column(c).to_numpy(zero_copy_only=False) for c in ("posting", "first", "second")])

    def starts(table: pa.Table) -> np.ndarray:
        key = keys(table)
        new = np.concatenate([[True], (key[:, 1:] != key[:, :-1]).any(axis=0)])
        return np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))

    for batch in batches:
        if batch.num_rows:
            kept.append(batch)
            table = pa.Table.from_batches(kept)
            start = starts(table)
            if last := int(start[-1]):
                yield table.slice(0, last).combine_chunks(), start[:last]
                kept = table.slice(last).combine_chunks().to_batches()
    if kept:
        table = pa.Table.from_batches(kept).combine_chunks()
        yield table, starts(table)


def pairs_of(start: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs of rows of one group, a bounded number at once."""
    before = np.arange(len(start)) - start
    ends = np.cumsum(before)
    at = 0
    while at < len(start):
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + PAIRS_AT_ONCE, side="right")))
        counts = before[at:to]
        left = np.repeat(np.arange(at, to), counts)
        offsets = np.repeat(np.cumsum(counts) - counts, counts)
        yield left, np.repeat(start[at:to], counts) + np.arange(len(left)) - offsets
        at = to


def signatures_of(column: pa.ChunkedArray) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype="<u4").reshape(len(column), -1)


def candidates(table: pa.Table, start: np.ndarray, matches: int, percent: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows of different components and of like sizes with enough collisions, each at its first common posting."""
    size, component, first, second, block, prefix = (
        table.column(c).to_numpy() for c in ("size", "component", "first", "second", "block", "prefix_bits")
    )
    signature = signatures_of(table.column("signature"))
    coordinate = (table.column("posting").to_numpy() >> 32).astype(np.uint64)
    within = first == second
    for a, b in pairs_of(start):
        near = (component[a] != component[b]) & (within[a] | (block[a] != block[b]))
        near &= (100 * size[a] >= percent * size[b]) & (100 * size[b] >= percent * size[a])
        a, b = a[near], b[near]
        equal = np.packbits(signature[a] == signature[b], axis=1, bitorder="little")
        bits = np.zeros((len(a), 8), dtype=np.uint8)
        bits[:, : equal.shape[1]] = equal
        bits = bits.view("<u8")[:, 0]
        common = bits & prefix[a].view(np.uint64) & prefix[b].view(np.uint64)
        here = np.uint64(1) << coordinate[a]
        keep = (common & (~common + np.uint64(1)) == here) & (np.bitwise_count(bits) >= matches)
        yield a[keep], b[keep]


def with_candidates(dealt: DataFrame, matches: int, percent: int) -> DataFrame:
    """(posting, first, second, node) of the nodes that have a candidate among the rows they meet."""
    names = ["posting", "first", "second", "node"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, start in whole_groups(batches):
            found = np.zeros(len(table), dtype=bool)
            for a, b in candidates(table, start, matches, percent):
                found[a] = found[b] = True
            yield from table.select(names).filter(pa.array(found)).combine_chunks().to_batches()

    return dealt.mapInArrow(work, "posting long, first int, second int, node long")


def alike(a: np.ndarray, b: np.ndarray, sizes_a: np.ndarray, sizes_b: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Which rows of two matrices of sorted samples can belong to sets as similar as that, and how similar they seem.

    The sample of the union is its least digests; a set of at most ``SAMPLE`` is its own sample.
    """
    both = np.sort(np.concatenate([a, b], axis=1), axis=1)
    none = np.uint32(0xFFFFFFFF)
    again = (both[:, 1:] == both[:, :-1]) & (both[:, 1:] != none)
    new = both != none
    new[:, 1:] &= ~again
    # Beyond the end of a sample that is cut off nothing is known of its set.
    end = np.minimum(np.where(sizes_a > SAMPLE, a[:, -1], none), np.where(sizes_b > SAMPLE, b[:, -1], none))
    known = both <= end[:, None]
    union, common = (new & known).sum(axis=1), (again & known[:, 1:]).sum(axis=1)
    share = percent / 100
    cut = (sizes_a > SAMPLE) | (sizes_b > SAMPLE)
    # Halves of digests can coincide: one more may be common than is seen here.
    error = np.where(cut, DEVIATIONS * np.sqrt(share * (1 - share) * union), 0) + 1
    return common >= share * union - error, common / np.maximum(union, 1)


def sampled_pairs(dealt: DataFrame, matches: int, percent: int) -> DataFrame:
    """Candidates (a, b, alike), once each, that the samples of their sets do not rule out."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, start in whole_groups(batches):
            node, size = table.column("node").to_numpy(), table.column("size").to_numpy()
            raw = table.column("sample").to_pylist()
            sample = np.full((len(raw), SAMPLE), 0xFFFFFFFF, dtype=np.uint32)
            for row, digests in zip(sample, raw, strict=True):
                row[: len(digests) // 4] = np.frombuffer(digests, dtype=">u4")
            # Bytes per place of 256: digests of a whole set by their low byte, the least of each; 0 where there is none.
            places = np.zeros((len(raw), 256), dtype=np.uint8)
            used = np.nonzero(sample != 0xFFFFFFFF)
            value = ((sample[used] >> 8) & 127).astype(np.uint8) + 1
            low = sample[used] & 255
            order = np.argsort(-value.astype(int), kind="stable")
            places[used[0][order], low[order]] = value[order]
            for a, b in candidates(table, start, matches, percent):
                for i in range(0, len(a), ROWS_AT_ONCE):
                    left, right = a[i : i + ROWS_AT_ONCE], b[i : i + ROWS_AT_ONCE]
                    one, two = places[left], places[right]
                    filled = (one | two) != 0
                    same = ((one == two) & filled).sum(axis=1)
                    n = filled.sum(axis=1)
                    share = percent / 100
                    whole = (size[left] <= SAMPLE) & (size[right] <= SAMPLE)
                    near = ~whole | (same >= share * n - DEVIATIONS * np.sqrt(share * (1 - share) * n) - 1)
                    left, right = left[near], right[near]
                    near, likeness = alike(sample[left], sample[right], size[left], size[right], percent)
                    x, y = node[left[near]], node[right[near]]
                    columns = [pa.array(np.minimum(x, y)), pa.array(np.maximum(x, y)), pa.array(likeness[near], pa.float32())]
                    yield pa.record_batch(columns, names=["a", "b", "alike"])

    return dealt.mapInArrow(work, "a long, b long, alike float")


def packed(postings: Column, prefix: Column) -> list[Column]:
    """A signature as bytes, four a coordinate, and which coordinates belong to the prefix as bits."""
    digits = F.transform(postings, lambda p: F.lpad(F.hex(p.bitwiseAND(F.lit(0xFFFFFFFF).cast("long"))), 8, "0"))
    bits = F.aggregate(prefix, F.lit(0).cast("long"), lambda b, p: b + F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftright(p, 32).cast("int")))
    return [F.unhex(F.array_join(digits, "")).alias("signature"), bits.alias("prefix_bits")]


def apart_pairs(posted: DataFrame, nodes: DataFrame, shared: DataFrame, docs: DataFrame, width: int, matches: int, percent: int) -> DataFrame:
    """Candidates among nodes that share a posting and are in different components."""
    marked = nodes.select("node", "postings").join(shared.select("node", "prefix"), "node")
    signed = marked.select("node", *packed(F.col("postings"), F.col("prefix")))
    keys = ["posting", "first", "second"]
    together = lambda df: df.repartition(*keys).sortWithinPartitions(*keys)
    # Rows are dealt to blocks first, so that signatures move once.
    dealt = in_blocks(posted.select("posting", "node", "size", "component")).join(signed, "node")
    few = stored(with_candidates(together(dealt), matches, percent), "minhash-few")
    ends = few.select("node").distinct()
    sets = full_sets(docs, nodes.join(ends, "node").select("doc_id"), width, SAMPLE)
    sample = F.unhex(F.array_join(F.transform("shingles", lambda d: F.lpad(F.hex(d), 8, "0")), ""))
    samples = stored(sets.dropDuplicates(["node"]).select("node", sample.alias("sample")), "minhash-samples")
    again = few.join(posted.select("posting", "node", "size", "component"), ["posting", "node"]).join(signed, "node").join(samples, "node")
    blocks = posted.groupBy("posting").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    again = again.join(blocks, "posting").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")).drop("blocks")
    pairs = stored(sampled_pairs(together(again), matches, percent), "minhash-pairs")
    discard(few, samples)
    return pairs


def near_duplicates(
    docs: DataFrame,
    width: int = 2,
    percent: int = THRESHOLD_PERCENT,
    coordinates: int = COORDINATES,
    matches: int = MATCHES,
) -> DataFrame:
    """Per row of ``docs``: doc_id, n_shingles, component_id (smallest doc_id reachable by links) and kept."""
    docs = doc_columns(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), "text")
    rows = stored(sign(docs, width, coordinates), "minhash-rows")
    nodes = rows.filter("node is not null").groupBy("node").agg(
        F.min("doc_id").alias("doc_id"), F.first("n_shingles").alias("size"), F.first("postings").alias("postings")
    )
    nodes = stored(nodes, "minhash-nodes")
    shared = stored(prefixes(nodes, coordinates, matches), "minhash-prefixes")
    postings = shared.select("node", "weight", F.explode("prefix").alias("posting"))
    several = postings.groupBy("posting").agg(F.min("node").alias("low"), F.max("node").alias("high")).filter("low < high")
    sized = nodes.select("node", "size", F.col("node").alias("component"))
    posted = stored(postings.join(several.select("posting"), "posting").join(sized, "node"), "minhash-postings")

    def sets_of(pairs: DataFrame) -> DataFrame:
        ends = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
        return stored(full_sets(docs, nodes.join(ends, "node").select("doc_id"), width), "minhash-sets")

    def linked(pairs: DataFrame, sets: DataFrame) -> DataFrame:
        return stored(confirm(pairs, sets, percent), "minhash-links")

    heaviest = F.max_by(F.struct("node", "size", "component"), F.struct("weight", "node")).alias("chosen")
    chosen = posted.groupBy("posting").agg(heaviest).select("posting", "chosen.*")
    pairs = stored(colliding(posted, chosen, shared, matches, percent), "minhash-pairs")
    sets = sets_of(pairs)
    links = linked(pairs, sets)
    discard(pairs, sets)
    labels = connected_components(links)
    # Only postings with nodes of several components are left to compare.
    renewed = posted.drop("component").join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
    apart = renewed.groupBy("posting").agg(F.min("component").alias("least"), F.max("component").alias("most")).filter("least < most")
    left = stored(renewed.join(apart.select("posting"), "posting"), "minhash-postings")
    discard(posted)
    if not left.isEmpty():
        pairs = apart_pairs(left, nodes, shared, docs, width, matches, percent)
        sets = sets_of(pairs)
        # Each pair carries a full set through a shuffle. One pair of each node joins most of what belongs together.
        links = links.unionByName(linked(likeliest(pairs), sets))
        labels = connected_components(links)
        rest = stored(between(pairs, labels), "minhash-rest")
        discard(pairs)
        if not rest.isEmpty():
            links = links.unionByName(linked(by_halves(rest, sets, percent), sets))
            labels = connected_components(links)
        discard(rest, sets)
    discard(left, shared, nodes)

    labelled = rows.join(labels, "node", "left").withColumn("label", F.coalesce("component", "node"))
    smallest = labelled.filter("label is not null").groupBy("label").agg(F.min("doc_id").alias("smallest"))
    result = labelled.join(smallest, "label", "left")
    component = F.when(F.col("label").isNull(), F.col("doc_id")).otherwise(F.col("smallest"))
    return result.select("doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))


def kept_documents(docs: DataFrame, width: int = 5, percent: int = THRESHOLD_PERCENT) -> DataFrame:
    """The rows of ``docs`` that stand for their component, with their columns as they were.

    Repeated rows of such a doc_id all stay, and rows without doc_id if one of them stands for its component.
    """
    kept = near_duplicates(docs, width, percent).filter("kept").select(F.col("doc_id").alias("_id")).distinct()
    return docs.join(kept, F.col("doc_id").eqNullSafe(F.col("_id")), "left_semi")
