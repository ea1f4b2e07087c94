"""Hashes of stretches of bytes or words over whole batches of texts, and filters of hashes that are of bounded size."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bits of a filter per hash, and in all at most (as a power of two).
_BITS_EACH, _MOST_BITS = 16, 27
#: Hashes that a task gathers before it hands on their counts.
_GATHERED = 2_000_000
_ODD = np.uint64(0x9E3779B97F4A7C15)
#: A random number for each byte.
RANDOM = np.random.default_rng(35).integers(1, 1 << 63, 256, dtype=np.uint64)
#: Odd bases of the sums below, and their inverses modulo 2^64.
_BASES = {"bytes": 0xD1342543DE82EF95, "words": 0xAF251AF3B0F025B5}
_POWERS: dict[str, tuple[np.ndarray, np.ndarray]] = {}


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _powers(base: str, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of a base and of its inverse, kept for the next batch."""
    known = _POWERS.get(base)
    if known is None or len(known[0]) < size:
        number = _BASES[base]
        tables = []
        for factor in (number, pow(number, -1, 1 << 64)):
            table = np.full(max(size, 1 << 16), factor, dtype=np.uint64)
            table[0] = 1
            tables.append(np.cumprod(table, dtype=np.uint64))
        known = _POWERS[base] = (tables[0], tables[1])
    return known[0][:size], known[1][:size]


class Sums:
    """Hashes of any stretch of a row of numbers, from running sums of numbers times powers of an odd base."""

    def __init__(self, values: np.ndarray, base: str):
        powers, self._back = _powers(base, len(values) + 1)
        self._sums = np.zeros(len(values) + 1, dtype=np.uint64)
        np.cumsum(values * powers[:-1], dtype=np.uint64, out=self._sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self._sums[end] - self._sums[start]) * self._back[start] + (end - start).astype(np.uint64) * _ODD)

    def runs(self, size: int) -> np.ndarray:
        """The hashes of all stretches of ``size`` numbers, in order; the same as ``of`` gives."""
        if len(self._sums) <= size:
            return np.empty(0, dtype=np.uint64)
        return mix((self._sums[size:] - self._sums[:-size]) * self._back[: len(self._sums) - size] + np.uint64(size * int(_ODD) % (1 << 64)))


def slices(rows: list[bytes], most: int) -> Iterator[tuple[int, list[bytes]]]:
    """The rows in stretches of about ``most`` bytes, each with the number of its first row."""
    start, size = 0, 0
    for n, row in enumerate(rows):
        size += len(row)
        if size >= most or n + 1 == len(rows):
            yield start, rows[start : n + 1]
            start, size = n + 1, 0


class Counts:
    """Counts of hashes within a task; ``take`` gives those that are due, so that their number stays bounded."""

    def __init__(self) -> None:
        self._keys: list[np.ndarray] = []
        self._numbers: list[np.ndarray] = []
        self._size = 0

    def add(self, hashes: np.ndarray) -> None:
        keys, numbers = np.unique(hashes, return_counts=True)
        self._keys.append(keys), self._numbers.append(numbers)
        self._size += len(keys)
        if self._size > _GATHERED and len(self._keys) > 1:
            self._merge()

    def _merge(self) -> None:
        keys, numbers = np.concatenate(self._keys), np.concatenate(self._numbers)
        order = np.argsort(keys)
        keys = keys[order]
        first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
        self._keys, self._numbers = [keys[first]], [np.add.reduceat(numbers[order], first)]
        self._size = len(first)

    def due(self) -> bool:
        return self._size > _GATHERED

    def take(self) -> tuple[np.ndarray, np.ndarray]:
        if len(self._keys) > 1:
            self._merge()
        keys = self._keys[0] if self._keys else np.empty(0, dtype=np.uint64)
        numbers = self._numbers[0] if self._numbers else np.empty(0, dtype=np.int64)
        self.__init__()
        return keys.view(np.int64), numbers


class BitFilter:
    """A table of bits that holds a set of hashes: it may pass others, but none of the set is held back."""

    def __init__(self, packed: np.ndarray, shift: int):
        self._packed, self._shift = packed, np.uint64(shift)

    def passes(self, hashes: np.ndarray) -> np.ndarray:
        place = hashes.view(np.uint64) >> self._shift
        return (self._packed[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8)) & 1 > 0


def bit_filter(hashes: DataFrame, column: str) -> BitFilter:
    """The filter of a written table of distinct hashes (bigint). At most 2^27 bits come to the driver, whatever it holds."""
    bits = min(_MOST_BITS, max(10, math.ceil(math.log2(_BITS_EACH * max(1, hashes.count())))))
    shift = 64 - bits
    # The leading bits of a hash name its bit; bits come as bitmaps of 4,096 bytes, of which there are 4,096 at most.
    place = F.shiftrightunsigned(column, shift) + 1
    bitmaps = hashes.select(place.alias("place"), F.bitmap_bucket_number(place).alias("bucket")).repartition("bucket").groupBy("bucket")
    table = np.zeros(max(1 << (bits - 3), 4096), dtype=np.uint8)
    # 16 MB at most, in one job; an iterator would run one for each partition.
    for bucket, bitmap in bitmaps.agg(F.bitmap_construct_agg(F.bitmap_bit_position("place"))).collect():
        table[(bucket - 1) * 4096 : bucket * 4096] = np.frombuffer(bitmap, dtype=np.uint8)
    return BitFilter(table, shift)
