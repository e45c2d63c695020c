"""Histogram sort into shards of near equal bytes, in DataFrame operations only.

The order is by a 60-bit digest of the text and then doc_id, so equal texts lie side by side and every shard is a
random sample. Each round counts, in one aggregation over compact keys, the exact rows and bytes between candidate
boundaries; the bin in which a splitter must lie is divided again until it is small enough or holds one digest. A
group of equal texts that is too large for the tolerance is divided by doc_id in the same way, first by its upper and
then by its lower half, so that no difference of ids can overflow. The counts also say how many rows lie before each
block of a shard, so that rows get gapless slots from the single exchange that follows, block by block and never a
shard in one task.

Null texts have no bytes, the digest 0 and crc32 0. Rows without doc_id come first among equal texts. Rows equal in
digest and doc_id can stand for each other; where a boundary falls among so many of them that a shard would miss its
bytes by more than ``NEAR`` of its share, the rows are numbered once, in a table in the scratch folder, and divided by
that number. Columns of ``docs`` named like one of the result are replaced. An empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from turnstile.llm.common import doc_columns, stored

DIGEST_BITS = 60
#: Candidate boundaries in each bin that is still too wide, a power of two.
PROBES_LOG2 = 6
#: Blocks of a shard: enough for tasks of about this many bytes, within these bounds. Their boundaries are part of the
#: plan, so from 1 TB on blocks grow with the table instead (6 GB at 100 TB, which a task sorts with spilling).
BLOCK_BYTES, MIN_BLOCKS, MAX_BLOCKS = 64 << 20, 8, 2048
#: Share of a shard's bytes by which equal rows may move its boundary.
NEAR = 0.001
#: The order, most significant first, as numbers from 0 on, and how many bits each can have.
LEVELS = {"digest": DIGEST_BITS, "id_upper": 32, "id_lower": 32, "number": 62}

NO_ID = -(1 << 63)


def text_bytes(text: Column) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1


def text_digest(text: Column) -> Column:
    """First 60 bits of the MD5 as a number; 0 for null."""
    return F.coalesce(F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("long"), F.lit(0).cast("long"))


def key_columns(doc_id: Column, text: Column) -> dict[str, Column]:
    """The levels of a row but its number; no id is the least one."""
    key = F.coalesce(doc_id.cast("long"), F.lit(NO_ID))
    return {
        "digest": text_digest(text),
        "id_upper": F.shiftright(key, 32) + (1 << 31),
        "id_lower": key.bitwiseAND(F.lit((1 << 32) - 1).cast("long")),
    }


@dataclass(frozen=True)
class Splitter:
    """A point of the order, of as many levels as were needed, and what lies before it; ``even`` if near its target."""

    point: tuple[int, ...]
    rows: int
    bytes: int
    even: bool = True


@dataclass
class Bin:
    low: int
    log2: int  # keys low <= key < low + 2**log2
    rows: int  # before it
    bytes: int
    own_rows: int
    own_bytes: int


def at_most(values: Column, n: int, key: Column) -> Column:
    """How many of ``n`` sorted ``values`` are at most ``key``, by binary search."""
    steps = F.array(*[F.lit(1 << k) for k in reversed(range(n.bit_length()))])
    return F.aggregate(
        steps, F.lit(0), lambda at, step: F.when((at + step <= n) & (F.get(values, at + step - 1) <= key), at + step).otherwise(at)
    )


def longs(values: list[int]) -> Column:
    return F.array(*[F.lit(v).cast("long") for v in values])


def refine(keys: DataFrame, column: str, bins: list[Bin]) -> list[list[Bin]]:
    """Each bin divided at evenly spaced candidate boundaries, by exact counts of one pass. Empty parts are left out.

    Bins are disjoint and sorted; keys outside of them count nowhere.
    """
    widths = [max(0, b.log2 - PROBES_LOG2) for b in bins]
    lows = longs([b.low for b in bins])
    found = keys.withColumn("bin", at_most(lows, len(bins), F.col(column)) - 1).filter("bin >= 0")
    offset = F.col(column) - F.get(lows, F.col("bin"))
    shift = F.get(F.array(*map(F.lit, widths)), F.col("bin"))
    parts_in = F.get(longs([1 << (b.log2 - w) for b, w in zip(bins, widths)]), F.col("bin"))
    counted = (
        found.withColumn("part", F.call_function("shiftrightunsigned", offset, shift))
        .filter((F.col("part") >= 0) & (F.col("part") < parts_in))
        .groupBy("bin", "part")
        .agg(F.count("*").alias("rows"), F.sum("size").alias("bytes"))
        .collect()  # at most 2**PROBES_LOG2 rows for each bin
    )
    parts: list[list[Bin]] = [[] for _ in bins]
    for row in sorted(counted, key=lambda r: (r.bin, r.part)):
        b, width, before = bins[row.bin], widths[row.bin], parts[row.bin][-1:]
        rows = before[0].rows + before[0].own_rows if before else b.rows
        size = before[0].bytes + before[0].own_bytes if before else b.bytes
        parts[row.bin].append(Bin(b.low + (row.part << width), width, rows, size, row.rows, row.bytes))
    return parts


def search(keys: DataFrame, column: str, whole: Bin, targets: list[int], tolerance: int) -> dict[int, Bin]:
    """For each target, a bin within which ``target`` bytes are reached: of one key or at most ``tolerance`` bytes."""
    held = {t: whole for t in targets}
    while True:
        wide = {b.low: b for b in held.values() if b.log2 and b.own_rows > 1 and b.own_bytes > tolerance}
        if not wide:
            return held
        bins = [wide[low] for low in sorted(wide)]
        parts = dict(zip(map(id, bins), refine(keys, column, bins)))
        for target, b in held.items():
            if id(wide.get(b.low)) in parts and b.log2 == wide[b.low].log2:
                held[target] = next(p for p in parts[id(wide[b.low])] if p.bytes + p.own_bytes >= target)


def nearer(prefix: tuple[int, ...], b: Bin, target: int, near: float) -> Splitter:
    """The end of the bin that is nearer to the target; its start where both are as near."""
    below, above = target - b.bytes, b.bytes + b.own_bytes - target
    even = b.own_rows == 1 or min(below, above) <= near
    if below <= above:
        return Splitter((*prefix, b.low), b.rows, b.bytes, even)
    return Splitter((*prefix, b.low + (1 << b.log2)), b.rows + b.own_rows, b.bytes + b.own_bytes, even)


def find_splitters(
    keys: DataFrame, levels: list[str], whole: Bin, targets: list[int], tolerance: int, near: float, prefix: tuple[int, ...] = ()
) -> dict[int, Splitter]:
    """Boundaries before which ``targets`` bytes lie, as near as whole points of the order allow."""
    level, *rest = levels
    splitters: dict[int, Splitter] = {}
    groups: dict[int, tuple[Bin, list[int]]] = {}
    for target, b in search(keys, level, whole, targets, tolerance).items():
        if b.own_rows == 1 or b.own_bytes <= tolerance or not rest:
            splitters[target] = nearer(prefix, b, target, max(tolerance, near))
        else:  # one value of several rows
            groups.setdefault(b.low, (b, []))[1].append(target)
    for value, (b, inside) in groups.items():
        same = Bin(0, LEVELS[rest[0]], b.rows, b.bytes, b.own_rows, b.own_bytes)
        equal = keys.filter(F.col(level) == value)
        splitters |= find_splitters(equal, rest, same, inside, tolerance, near, (*prefix, value))
    return splitters


def numbered(docs: DataFrame) -> DataFrame:
    """``docs`` with a number for each row, written so that every pass sees the same one."""
    return stored(docs.withColumn("_number", F.monotonically_increasing_id()), "histogram-numbered")


def histogram_shards(docs: DataFrame, n_shards: int = 8, tolerance: float = 0.0) -> DataFrame:
    """``docs`` with ``size``, ``shard`` and ``slot``, exchanged once by block of a shard.

    ``tolerance`` is the share of a shard's bytes by which a boundary may miss its place; at 0 a boundary is the
    point of the order that is nearest to it.
    """
    docs = docs.drop("size", "shard", "slot")
    levels = list(LEVELS)[:-1]
    while True:
        number = {"number": F.col("_number")} if "number" in levels else {}
        columns = key_columns(F.col("doc_id"), F.col("text")) | number
        keys = docs.select(*[c.alias(name) for name, c in columns.items()], text_bytes(F.col("text")).alias("size"))
        keys = stored(keys, "histogram-keys")
        total_rows, total_bytes = keys.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()
        blocks = min(MAX_BLOCKS, max(MIN_BLOCKS, -(-total_bytes // (n_shards * BLOCK_BYTES))))
        shares = [i / (n_shards * blocks) for i in range(1, n_shards * blocks)]
        exact = shares[blocks - 1 :: blocks]
        target = {s: min(total_bytes, max(1, round(s * total_bytes))) for s in shares}
        share, whole = total_bytes / n_shards, Bin(0, DIGEST_BITS, 0, 0, total_rows, total_bytes)
        found: dict[int, Splitter] = {}
        if total_rows:
            found = find_splitters(keys, levels, whole, sorted({target[s] for s in exact}), int(tolerance * share), NEAR * share)
        if number or all(splitter.even for splitter in found.values()):
            break
        docs, levels = numbered(docs), list(LEVELS)
    splitters: dict[float, Splitter] = {}
    if total_rows:
        splitters |= {s: found[target[s]] for s in exact}
        rough = [s for s in shares if s not in splitters]
        if rough:
            tasks = find_splitters(keys, levels, whole, sorted({target[s] for s in rough}), int(share / blocks / 2), share)
            splitters |= {s: tasks[target[s]] for s in rough}
    # Shard boundaries are held to the tolerance; those of blocks within a shard only size its tasks.
    padded = lambda point: (*point, *[0] * (len(levels) - len(point)))
    ordered = sorted((padded(x.point), x.rows, s in exact) for s, x in splitters.items())
    shard_of, starts, base = [0], [0], 0
    for _, rows, ends_shard in ordered:
        if ends_shard:
            base = rows
        shard_of.append(shard_of[-1] + ends_shard)
        starts.append(rows - base)
    points = F.array(*[F.struct(*[F.lit(v).cast("long") for v in point]) for point, _, _ in ordered])
    names = [f"_{level}" for level in levels]
    block = at_most(points, len(ordered), F.struct(*names)) if ordered else F.lit(0)
    within = Window.partitionBy("_block").orderBy(*names)
    placed = (
        docs.withColumns({f"_{name}": c for name, c in key_columns(F.col("doc_id"), F.col("text")).items()})
        .withColumn("_block", block)
        .withColumn("_place", F.row_number().over(within) - 1)
    )
    of_block = lambda values: F.get(longs(values), F.col("_block"))
    result = {
        "size": text_bytes(F.col("text")),
        "shard": of_block(shard_of).cast("int"),
        "slot": of_block(starts) + F.col("_place"),
    }
    return placed.withColumns(result).drop(*names, "_block", "_place")


def shard_report(docs: DataFrame, n_shards: int = 8) -> DataFrame:
    sharded = histogram_shards(doc_columns(docs, "doc_id", "text"), n_shards)
    return sharded.select(
        "doc_id",
        "size",
        F.coalesce(F.crc32(F.col("text").cast("binary")), F.lit(0).cast("long")).alias("text_crc32"),
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
