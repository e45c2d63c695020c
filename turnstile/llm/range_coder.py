"""Adaptive context-mixing range coder for token ids below 65,536.

Ids are cut into blocks that are coded independently: every block starts with a fresh model and carries a checksum.
The first blob of a segment is a table of how often its ids occur, which all its blocks share (order 0). The model
predicts an id from the last two ids (order 2) or the last one (order 1): the id that followed them last time. One
binary decision says whether the prediction holds; its probability mixes, in the logistic domain and with weights that
adapt, what each order knows. A missed id is coded by its frequency in the table. All numbers are integers, those of
the coder below 2**49 and so exact in doubles, and every machine decodes the same.

Blocks are coded side by side: each step takes one id of every block of a segment. The model learns after a round of
steps, so that within a round it only looks up.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np

BLOCK_IDS = 4096
TABLE_BITS = 10
# Probabilities of hits have 12 bits, frequencies 16; the range is held between 2**32 and 2**48 and leaves 16 bits at a time.
BITS = 12
ONE = 1 << BITS
ALL = 1 << 16
PART = 1 << 18
TOP, LOW, WORD = 2.0**48, 2.0**32, 2.0**16
# Steps of a round: few at first. The first rounds are weighed, and then one of WEIGH.
ROUNDS, ROUND, WEIGH = (8,), 16, 16
# Of an entry's bits, the lowest four count how often its id came again.
SURE = 15

_LOGIT = np.log((np.arange(ONE) + 0.5) / (ONE - 0.5 - np.arange(ONE)))
STRETCH = np.rint(_LOGIT * 256).astype(np.int64)
SQUASH = np.clip(np.rint(ONE / (1 + np.exp(-np.arange(-2048, 2048) / 256))), 1, ONE - 1)
# By rank of an id: where a block's tables hold what followed it, and how the id before it moves that place.
PLACE = np.arange(ALL) * 40503 >> 4 & (1 << TABLE_BITS) - 1
SECOND = np.arange(ALL) * 60493 >> 5 & (1 << TABLE_BITS) - 1


def rounds(width: int) -> Iterator[tuple[int, int, bool]]:
    """Where each round begins and ends, and whether its predictions are weighed."""
    start, k = 0, 0
    while start < width:
        end = min(start + (ROUNDS[k] if k < len(ROUNDS) else ROUND), width)
        yield start, end, k < WEIGH or k % WEIGH == 0
        start, k = end, k + 1


class Frequencies:
    """How often each id occurs in a segment, out of ALL; at least once if it occurs at all.

    The coder works on the ranks of the ids that occur, so that all tables by id are as small as can be.
    """

    def __init__(self, known: np.ndarray, freq: np.ndarray):
        self.known, self.given = known, freq
        self.freq = freq.astype(np.float64)
        self.start = np.cumsum(self.freq) - self.freq
        self.inputs = STRETCH[np.clip(freq >> 4, 1, ONE - 1)]

    def ranks(self, ids: np.ndarray) -> np.ndarray:
        by_id = np.zeros(ALL, dtype=np.uint16)
        by_id[self.known] = np.arange(len(self.known))
        return by_id.take(ids)

    @classmethod
    def of_ids(cls, ids: np.ndarray) -> Frequencies:
        counts = sum(np.bincount(ids[i : i + PART], minlength=ALL) for i in range(0, len(ids), PART))
        known = np.flatnonzero(counts)
        freq = 1 + counts[known] * (ALL - len(known)) // len(ids)
        freq[freq.argmax()] += ALL - freq.sum()
        return cls(known, freq)

    @classmethod
    def from_blob(cls, blob: bytes) -> Frequencies:
        known, freq = np.frombuffer(zlib.decompress(blob), dtype="<u2").reshape(2, -1).astype(np.int64)
        return cls(known, freq + 1)

    def blob(self) -> bytes:
        return zlib.compress(np.stack([self.known, self.given - 1]).astype("<u2").tobytes())

    def ranks_by_slot(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.known), dtype=np.uint16), self.given)


class Model:
    """The state of all blocks of a segment."""

    def __init__(self, n: int, order0: Frequencies):
        self.lane, self.row = np.arange(n), np.arange(n) * (SURE + 1)
        # What blocks know of one place lies together: many of them look up the same frequent ids.
        shift = (n - 1).bit_length()
        self.place, self.second = (table[: len(order0.known)] << shift for table in (PLACE, SECOND))
        self.last1, self.last2 = (np.zeros(1 << TABLE_BITS + shift, np.uint32) for _ in range(2))
        self.order0 = order0.inputs
        self.seen = np.tile([1, 4], (2, n * (SURE + 1), 1))  # hits and misses by order and sureness
        self.weights = np.full((3, n), 1 << 15)
        self.renew()

    def renew(self) -> None:
        """What each order says, and that by its weight, for the next round."""
        self.inputs = STRETCH.take(self.seen[:, :, 0] * ONE // self.seen.sum(axis=2))
        heavy = self.inputs.reshape(2, -1, SURE + 1) * self.weights[:2, :, None]
        self.heavy1, self.heavy2 = (heavy.reshape(2, -1) + ((ONE // 4) << 16))

    def predict(self, before: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, ...]:
        """The predicted ids, the probabilities, of ONE, that they come, and what :meth:`learn` needs."""
        at1 = self.place.take(last) + self.lane
        at2 = at1 ^ self.second.take(before)
        one, two = self.last1.take(at1), self.last2.take(at2)
        guess = np.where(two, two, one) >> 4
        total = self.heavy1.take((one & SURE) + self.row)
        total += self.heavy2.take((two & SURE) + self.row)
        total += self.order0.take(guess) * self.weights[2]
        return guess, SQUASH.take(total >> 16, mode="clip"), at1, at2, one, two

    def learn(self, ids: np.ndarray, found: tuple[np.ndarray, ...], weigh: bool) -> None:
        """Takes in a round: its ids, a row for each step, and its predictions; ``weigh``: how good they were as well."""
        guess, chance, at1, at2, one, two = found
        ids = ids.astype(np.uint32)
        new = ids << 4 | 1
        if weigh:
            error = ((guess == ids) * float(ONE)) - chance
            self.weights[2] += (self.order0.take(guess) * error).sum(axis=0).astype(np.int64) >> 13
        for k, table, at, entry in ((0, self.last1, at1, one), (1, self.last2, at2, two)):
            sure, right = entry & SURE, entry >> 4 == ids
            if weigh:
                place = sure + self.row
                self.weights[k] += (self.inputs[k].take(place) * error).sum(axis=0).astype(np.int64) >> 13
                self.seen[k] += np.bincount((place << 1 | ~right).ravel(), minlength=self.seen[k].size).reshape(-1, 2)
            # Of equal places the last one stays.
            table[at.ravel()] = np.where(right & (sure > 0), entry + (sure < SURE), new).ravel()
        if weigh:
            np.clip(self.weights, -(1 << 19), 1 << 19, out=self.weights)
            self.renew()


def encode_segment(ids: np.ndarray, block: int = BLOCK_IDS) -> tuple[list[bytes], list[int]]:
    """The table of ``ids`` and their coded blocks, and the checksums of the table and of each block's ids."""
    n = -(-len(ids) // block)
    if not n:
        return [], []
    width = min(block, len(ids))
    order0 = Frequencies.of_ids(ids)
    columns = np.full(n * width, order0.given.argmax(), dtype=np.uint16)
    columns[: len(ids)] = order0.ranks(ids)
    columns = columns.reshape(n, width).T.copy()
    model = Model(n, order0)
    most = 2 * width + 8  # a step leaves two words at most
    out, first = np.zeros(n * most, dtype=np.uint32), np.arange(n) * most
    at = first.copy()
    low, span = np.zeros(n), np.full(n, TOP)
    before = last = np.zeros(n, dtype=np.int64)

    for begin, end, weigh in rounds(width):
        now = columns[begin:end].astype(np.int64)
        history = np.concatenate([[before, last], now])
        found = model.predict(history[:-2], history[1:-1])
        missed = found[0] != now
        starts, freqs, chances, moved = order0.start.take(now), order0.freq.take(now), found[1], missed.astype(float)
        for step in range(end - begin):
            bound = np.floor(span * (1 / ONE)) * chances[step]
            part = np.floor((span - bound) * (1 / ALL))
            low += (bound + part * starts[step]) * moved[step]
            span = np.where(missed[step], part * freqs[step], bound)
            small = span < LOW
            word = np.floor(low * (1 / LOW))
            out[at] = word.astype(np.uint32)  # stays where the place moves on
            low = np.where(small, (low - word * LOW) * WORD, low)
            span = np.where(small, span * WORD, span)
            at += small
            few = (span < LOW).nonzero()[0]  # those that leave a second word
            if len(few):
                word = np.floor(low[few] * (1 / LOW))
                out[at[few]] = word.astype(np.uint32)
                low[few] = (low[few] - word * LOW) * WORD
                span[few] *= WORD
                at[few] += 1
        model.learn(now, found, weigh)
        before, last = history[-2], history[-1]
    for _ in range(3):
        word = np.floor(low * (1 / LOW))
        out[at] = word
        low = (low - word * LOW) * WORD
        at += 1
    over = (out >= ALL).nonzero()[0]
    while len(over):  # a word's 17th bit is a carry to the word before it
        out[over] -= ALL
        over = over - 1
        out[over] += 1
        over = over[out[over] >= ALL]
    raw, words, table = ids.astype("<u2").tobytes(), out.astype("<u2"), order0.blob()
    sums = [zlib.crc32(raw[2 * i : 2 * (i + width)]) for i in range(0, len(ids), width)]
    return [table, *(words[b:e].tobytes() for b, e in zip(first, at))], [zlib.crc32(table), *sums]


def decode_segment(blocks: list[bytes], sums: list[int], total: int, block: int = BLOCK_IDS) -> np.ndarray:
    """The ids of a segment; raises ``ValueError`` if its table or a block's ids do not have their checksum."""
    if not blocks:
        return np.zeros(0, dtype="<u2")
    table, *blocks = blocks
    if zlib.crc32(table) != sums[0]:
        raise ValueError("the table of frequencies is damaged")
    order0 = Frequencies.from_blob(table)
    by_slot, n, width = order0.ranks_by_slot(), len(blocks), min(block, total)
    lengths = np.fromiter(map(len, blocks), dtype=np.int64, count=n) // 2
    words = np.concatenate([np.frombuffer(b"".join(blocks), dtype="<u2"), np.zeros(4, dtype="<u2")])
    at = np.cumsum(lengths) - lengths
    code = words.take(at, mode="clip") * LOW + words.take(at + 1, mode="clip") * WORD + words.take(at + 2, mode="clip")
    at += 3
    model, span = Model(n, order0), np.full(n, TOP)
    columns = np.empty((width, n), dtype=np.uint16)
    before = last = np.zeros(n, dtype=np.int64)

    for begin, end, weigh in rounds(width):
        kept, now = [], np.empty((end - begin, n), dtype=np.int64)
        for step in range(end - begin):
            found = model.predict(before, last)
            kept.append(found)
            bound = np.floor(span * (1 / ONE)) * found[1]
            rest, part = code - bound, np.floor((span - bound) * (1 / ALL))
            symbol = by_slot.take((rest / part).astype(np.int64), mode="clip")  # exact: both are below 2**49
            missed = rest >= 0
            now[step] = ids = np.where(missed, symbol, found[0])
            code = np.where(missed, rest - part * order0.start.take(symbol), code)
            span = np.where(missed, part * order0.freq.take(symbol), bound)
            small = span < LOW
            code = np.where(small, code * WORD + words.take(at, mode="clip"), code)
            span = np.where(small, span * WORD, span)
            at += small
            few = (span < LOW).nonzero()[0]
            if len(few):
                code[few] = code[few] * WORD + words.take(at[few], mode="clip")
                span[few] *= WORD
                at[few] += 1
            before, last = last, ids
        wrong = (code >= span).nonzero()[0]
        if len(wrong):
            raise ValueError(f"block {wrong[0]} is damaged")
        model.learn(now, tuple(map(np.stack, zip(*kept))), weigh)
        columns[begin:end] = now
    found = order0.known.astype("<u2").take(columns.T.reshape(-1)[:total])
    raw = found.tobytes()
    for i, expected in enumerate(sums[1:]):
        if zlib.crc32(raw[2 * i * width : 2 * (i + 1) * width]) != expected:
            raise ValueError(f"block {i} is damaged")
    return found
