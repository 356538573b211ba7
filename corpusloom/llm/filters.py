"""Filters of bounded size that keep what cannot match from being moved."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class Filter:
    """A bit map of hashes: what it does not hold is none of them. Its size is bounded, whatever their number."""

    def __init__(self, words: np.ndarray, values: np.ndarray, bits: int):
        self.bits, self.map = bits, np.zeros(max(1, (1 << bits) // 64), dtype=np.uint64)
        self.map[words] = values.view(np.uint64)

    def holds(self, hashes: np.ndarray) -> np.ndarray:
        """Where the hashes may be held."""
        at = (hashes >> np.uint64(64 - self.bits)).astype(np.int64)
        return np.flatnonzero((self.map[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1))


def hash_filter(hashes: DataFrame, each: int = 10, most: int = 27) -> Filter:
    """The filter of the column ``hash``: 2^``each`` bits a hash, but 2^``most`` at most (16 MB), so what comes to
    the driver is bounded. With more hashes it lets more through, which a join then drops."""
    many = hashes.select("hash").distinct().count()
    bits = min(most, max(12, each + many.bit_length()))
    place = F.shiftrightunsigned("hash", 64 - bits)
    bit = F.expr("shiftleft(1L, cast(place & 63 as int))")
    words = hashes.select(place.alias("place")).groupBy(F.shiftright("place", 6).alias("word")).agg(F.bit_or(bit).alias("bits")).toArrow()
    return Filter(words.column("word").to_numpy().astype(np.int64), words.column("bits").to_numpy().astype(np.int64), bits)
