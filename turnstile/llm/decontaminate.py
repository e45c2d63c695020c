"""Benchmark passages in documents: SimHash of item-sized windows, multi-index Hamming search, exact confirmation.

Words are lower-cased and end at the six ASCII blanks; shingles are five words. Windows are as long as an item and lie
where they share a shingle with one in the same place; every other window has similarity 0 to every item. The 64-bit
SimHash of a window's weighted shingles (a shingle weighs as often as it occurs) is looked up in an index of all
items: eight blocks of eight bits, each entered with every value within two bits. Two fingerprints up to 23 bits apart
agree within two bits in some block, so none within that radius is missed; a window of similarity 0.8 lies within it
but for about one in a million. Candidates are confirmed by the weighted Jaccard similarity of the shingles themselves.

Items under five words and null or empty texts match nothing. Repeated rows give one result; documents without doc_id
are reported under null. Documents shorter than an item are compared whole. Other columns are never read.
DataFrame operations only; an index too large to broadcast is joined by shuffle.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turnstile.llm.common import doc_columns, stored

WIDTH = 5
PERCENT = 80
BLOCKS, BLOCK_BITS, BLOCK_RADIUS = 8, 8, 2
#: Any two fingerprints within this distance share a block up to BLOCK_RADIUS bits.
RADIUS = BLOCKS * (BLOCK_RADIUS + 1) - 1
#: Rows of (shingle, item, place), of 24 bytes each, that are broadcast at most.
MAX_BROADCAST_ROWS = 500_000

MASKS = [sum(1 << b for b in bits) for r in range(BLOCK_RADIUS + 1) for bits in combinations(range(BLOCK_BITS), r)]


def word_array(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[\x20\x09-\x0D]+"), "")


def bound(value: Column, make) -> Column:
    """``make(value)`` with ``value`` computed once, also where it stands inside of a function over an array."""
    return F.get(F.transform(F.array(value), make), F.lit(0))


def each_shingle(words: Column, make) -> Column:
    """``make`` of every run of WIDTH words, in order."""
    return bound(words, lambda known: _each_shingle(known, make))


def _each_shingle(words: Column, make) -> Column:
    places = F.when(F.size(words) >= WIDTH, F.sequence(F.lit(1), F.size(words) - (WIDTH - 1))).otherwise(F.array().cast("array<int>"))
    return F.transform(places, lambda i: make(F.slice(words, i, WIDTH)))


def simhash(hashes: Column) -> Column:
    """Bit b is set where more than half of the hashes, with repetition, have it set."""
    return bound(hashes, _simhash)


def _simhash(hashes: Column) -> Column:
    bit = lambda x, b: F.call_function("shiftrightunsigned", x, b).bitwiseAND(F.lit(1).cast("long"))
    ones = lambda b: F.size(F.filter(hashes, lambda x: bit(x, b) == 1))
    one = F.lit(1).cast("long")
    bits = F.transform(
        F.sequence(F.lit(0), F.lit(63)),
        lambda b: F.when(2 * ones(b) > F.size(hashes), F.call_function("shiftleft", one, b)).otherwise(F.lit(0).cast("long")),
    )
    return F.aggregate(bits, F.lit(0).cast("long"), lambda a, x: a.bitwiseOR(x))


def block_values(fingerprint: Column) -> Column:
    values = [F.shiftrightunsigned(fingerprint, BLOCK_BITS * k).bitwiseAND(F.lit((1 << BLOCK_BITS) - 1).cast("long")) for k in range(BLOCKS)]
    return F.array(*values)


def common_weight(a: Column, b: Column) -> Column:
    """Sum over distinct shingles of the smaller of their counts."""
    count = lambda within, x: F.size(F.filter(within, lambda y: y == x))
    add = lambda p: lambda total, x: total + F.least(count(p["a"], x), count(p["b"], x))
    return bound(F.struct(a.alias("a"), b.alias("b")), lambda p: F.aggregate(F.array_distinct(p["a"]), F.lit(0), add(p)))


def bounded(df: DataFrame, most: int) -> DataFrame:
    """``df`` marked for broadcast if it has at most ``most`` rows, else as it is."""
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df


def find_passages(docs: DataFrame, items: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Per document and item with a window of that similarity: the best window's first word, length and weights.

    ``common`` of ``total`` is the weighted Jaccard similarity; of equally similar windows the first is given.
    """
    docs = doc_columns(docs, "doc_id", "text")
    words = F.col("words")
    item_words = items.select("item_id", word_array(F.col("text")).alias("words")).filter(F.size(words) >= WIDTH).distinct()
    item_rows = stored(
        item_words.select(
            "item_id",
            F.size(words).alias("length"),
            each_shingle(words, F.xxhash64).alias("hashes"),
            each_shingle(words, lambda w: F.array_join(w, " ")).alias("item_shingles"),
        ).withColumn("item_print", simhash(F.col("hashes"))),
        "benchmark-items",
    )
    entries = item_rows.select("item_id", "length", F.posexplode("hashes").alias("item_at", "hash"))
    shingles = docs.select("doc_id", F.posexplode(each_shingle(word_array(F.col("text")), F.xxhash64)).alias("at", "hash"))
    hits = stored(
        shingles.join(bounded(entries, MAX_BROADCAST_ROWS), "hash")
        .select("doc_id", "length", (F.col("at") - F.col("item_at")).alias("start"))
        .distinct(),
        "benchmark-hits",
    )
    named = hits.select(F.col("doc_id").alias("_id"), "length", "start")
    wanted = docs.join(named.select("_id").distinct(), F.col("doc_id").eqNullSafe(F.col("_id")), "left_semi").distinct()
    texts = wanted.select("doc_id", word_array(F.col("text")).alias("words"))
    last = F.greatest(F.size(words) - F.col("length"), F.lit(0))
    windows = (
        texts.join(named, F.col("doc_id").eqNullSafe(F.col("_id")))
        .select("doc_id", "length", F.least(F.greatest("start", F.lit(0)), last).alias("start"), "words")
        .withColumn("window", F.slice(words, F.col("start") + 1, F.col("length")))
        .drop("words")
        .distinct()
        .withColumn("print", simhash(each_shingle(F.col("window"), F.xxhash64)))
    )
    probes = windows.select("*", F.posexplode(block_values(F.col("print"))).alias("block", "value"))
    masks = F.array(*[F.lit(m).cast("long") for m in MASKS])
    index = (
        item_rows.select("item_id", "length", "item_print", "item_shingles", F.posexplode(block_values(F.col("item_print"))).alias("block", "own"))
        .select("*", F.explode(masks).alias("mask"))
        .withColumn("value", F.col("own").bitwiseXOR(F.col("mask")))
        .drop("own", "mask")
    )
    near = probes.join(index, ["block", "value", "length"]).filter(F.bit_count(F.col("print").bitwiseXOR(F.col("item_print"))) <= RADIUS)
    found = near.select("doc_id", "item_id", "start", "window", "item_shingles").distinct()
    common = common_weight(F.col("own_shingles"), F.col("item_shingles"))
    judged = (
        found.withColumn("own_shingles", each_shingle(F.col("window"), lambda w: F.array_join(w, " ")))
        .withColumn("common", common)
        .withColumn("total", F.size("own_shingles") + F.size("item_shingles") - F.col("common"))
        .filter(100 * F.col("common") >= percent * F.col("total"))
    )
    best = F.max(F.struct((F.col("common") / F.col("total")).alias("similarity"), (-F.col("start")).alias("at"), F.size("window").alias("n"), "common", "total"))
    return judged.groupBy("doc_id", "item_id").agg(best.alias("best")).select(
        "doc_id",
        "item_id",
        (-F.col("best.at")).cast("long").alias("start"),
        F.col("best.n").cast("long").alias("n_words"),
        F.col("best.common").cast("long").alias("common"),
        F.col("best.total").cast("long").alias("total"),
    )


def clean_documents(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of ``docs`` that hold no passage of ``items``, with their columns as they were."""
    key = F.xxhash64("doc_id", "text")  # rows of one doc_id, or of none, are told apart by their text
    leaked = find_passages(docs.select(key.alias("doc_id"), "text"), items).select(F.col("doc_id").alias("_key")).distinct()
    return docs.join(leaked, key == F.col("_key"), "left_anti")
