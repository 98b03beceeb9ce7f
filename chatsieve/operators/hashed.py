"""Looking terms up by two independent hashes, in arrays that every task holds."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def hashed_terms(terms: Column, salt: int) -> Column:
    """Two independent hashes of every term of an array."""
    return F.transform(terms, lambda t: F.struct(F.xxhash64(t, F.lit(salt)).alias("h"), F.hash(t).alias("c")))


class Hashed:
    """Places of terms in the order of their hashes."""

    def __init__(self, h: np.ndarray, c: np.ndarray) -> None:
        self.order = np.argsort(h)
        self.h, self.c = h[self.order], c[self.order]
        self.unique = bool((self.h[1:] != self.h[:-1]).all())

    def places(self, h: np.ndarray, c: np.ndarray) -> np.ndarray:
        """The place of every term, -1 of one that is not known."""
        if not len(self.h):
            return np.full(len(h), -1)
        some, back = np.unique(h, return_inverse=True)
        at = np.minimum(np.searchsorted(self.h, some), len(self.h) - 1)
        at = np.where(self.h[at] == some, at, -1)[back]
        return np.where((at >= 0) & (self.c[at] == c), at, -1)


def list_parts(lists: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(how many of each row, h, c) of a column of hashed terms."""
    flat = lists.flatten()
    sizes = np.diff(lists.offsets.to_numpy())
    return sizes, flat.field("h").to_numpy(), flat.field("c").to_numpy()


def pieces(sizes: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows with about ``most`` tokens in each."""
    ends = np.cumsum(sizes)
    start = 0
    while start < len(sizes):
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + most, "right")))
        yield start, stop
        start = stop


def hashed(table: DataFrame, key: str, *values: str | Column) -> tuple[Hashed, int, pa.Table]:
    """(the distinct keys of a table by their hashes, the salt for which no two hashes are equal, the
    table with its values, in its own order)."""
    salt = 0
    while True:
        rows = table.select(F.xxhash64(key, F.lit(salt)).alias("h"), F.hash(key).alias("c"), *values).toArrow().combine_chunks()
        known = Hashed(rows.column("h").to_numpy(), rows.column("c").to_numpy())
        if known.unique:
            return known, salt, rows
        salt += 1
