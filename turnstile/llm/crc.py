"""CRC-32 of any substring from two running CRCs, by cancelling the shifted prefix over GF(2).

For texts A and B, ``crc(AB) = shift(crc(A), len(B)) xor crc(B)``, where ``shift`` appends zero bytes to the register: a
linear map on 32 bits. So a substring's CRC is the CRC up to its end, xor the shifted CRC up to its start.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import cache
from itertools import accumulate
from zlib import crc32

import numpy as np

# Fixed value: the CRC-32 polynomial, lowest power first.
POLYNOMIAL = 0xEDB88320
# Lengths below this have a map of their own; longer ones are composed of this one's powers of two.
DIRECT = 128
BLANK = ord(" ")


def shifted_by(table: np.ndarray, crcs: np.ndarray) -> np.ndarray:
    """One map, given by its values on the four bytes of a register, applied to every CRC."""
    found = table[0][crcs & 255]
    for k in (1, 2, 3):
        found = found ^ table[k][(crcs >> np.uint32(8 * k)) & 255]
    return found


@cache
def byte_table() -> np.ndarray:
    """The map of one byte, for each value of the register's low byte."""
    values = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        values = np.where(values & 1, (values >> 1) ^ np.uint32(POLYNOMIAL), values >> 1).astype(np.uint32)
    return values


@cache
def shift_tables() -> np.ndarray:
    """For each length below ``DIRECT``: where that many zero bytes take every value of each byte of a register."""
    one = byte_table()
    tables = np.empty((DIRECT, 4, 256), dtype=np.uint32)
    tables[0] = np.arange(256, dtype=np.uint32) << (8 * np.arange(4, dtype=np.uint32))[:, None]
    for n in range(1, DIRECT):
        tables[n] = one[tables[n - 1] & 255] ^ (tables[n - 1] >> np.uint32(8))
    return tables


@cache
def power_table(power: int) -> np.ndarray:
    """The map of ``DIRECT * 2 ** power`` zero bytes."""
    half = power_table(power - 1) if power else None
    if half is None:
        last, one = shift_tables()[DIRECT - 1], byte_table()
        return one[last & 255] ^ (last >> np.uint32(8))
    return shifted_by(half, half)


def shift(crcs: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Each CRC after as many zero bytes as ``lengths`` says."""
    tables, low = shift_tables(), lengths % DIRECT
    found = tables[low, 0, crcs & 255]
    for k in (1, 2, 3):
        found = found ^ tables[low, k, (crcs >> np.uint32(8 * k)) & 255]
    rest, power = lengths // DIRECT, 0
    while rest.any():
        odd = np.flatnonzero(rest & 1)
        found[odd] = shifted_by(power_table(power), found[odd])
        rest, power = rest >> 1, power + 1
    return found


class RunningCrcs:
    """CRCs up to the start and to the end of every word of a text whose words are parted by one blank."""

    def __init__(self, words: Sequence[bytes]):
        count = len(words)
        self.lengths = np.fromiter(map(len, words), dtype=np.int64, count=count)
        # A blank before the first word as well changes no substring's CRC.
        running = accumulate(map(b" ".__add__, words), lambda crc, word: crc32(word, crc), initial=0)
        crcs = np.fromiter(running, dtype=np.uint32, count=count + 1)
        self.ends, before = crcs[1:], ~crcs[:-1]
        self.starts = ~(byte_table()[(before ^ np.uint32(BLANK)) & 255] ^ (before >> np.uint32(8)))
        self.bounds = np.concatenate([[0], np.cumsum(self.lengths + 1)])

    def of_runs(self, n: int) -> np.ndarray:
        """CRC of every run of ``n`` consecutive words with single blanks between, in order."""
        runs = max(len(self.lengths) - n + 1, 0)
        lengths = self.bounds[n : n + runs] - self.bounds[:runs] - 1
        return self.ends[n - 1 : n - 1 + runs] ^ shift(self.starts[:runs], lengths)
