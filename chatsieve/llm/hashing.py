"""Words and rolling hashes of whole Arrow text columns, as NumPy arrays.

A word is a maximal run of bytes other than ASCII white space. All hashes are
64-bit and depend on the word alone, never on where it stands.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 4 << 20
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_STEP = np.uint64(0xD6E8FEB86659FD93)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_powers: dict[str, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser (splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_LETTER = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x632BE59BD9B4E019))


def _powers_of(name: str, base: np.uint64, n: int) -> np.ndarray:
    if name not in _powers or len(_powers[name]) < n:
        grown = np.full(max(n, CHUNK_BYTES + 1), base, dtype=np.uint64)
        grown[0] = 1
        _powers[name] = np.cumprod(grown)
    return _powers[name][:n]


def text_chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, row offsets) for runs of rows of about ``limit`` bytes.
    A text longer than that is a chunk by itself; NULL reads as empty."""
    column = column.cast(pa.large_string()).fill_null("")
    if not len(column):
        return
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    row = 0
    while row < len(column):
        stop = int(np.searchsorted(offsets, offsets[row] + limit, side="right")) - 1
        stop = min(max(stop, row + 1), len(column))
        yield row, data[offsets[row] : offsets[stop]], offsets[row : stop + 1] - offsets[row]
        row = stop


def words_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start byte, end byte, words per row) of the words of every row."""
    solid = np.zeros(len(data) + 2, dtype=bool)
    solid[1:-1] = ~_SPACE[data]
    cut = np.zeros(len(data) + 1, dtype=bool)
    cut[offsets] = True
    starts = np.flatnonzero(solid[1:] & (~solid[:-1] | cut)) if len(data) else np.zeros(0, np.int64)
    ends = np.flatnonzero(solid[:-1] & (~solid[1:] | cut)) if len(data) else np.zeros(0, np.int64)
    counts = np.diff(np.searchsorted(starts, offsets))
    return starts, ends, counts


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """One hash per word from prefix sums of a polynomial over its bytes."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    total = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(_LETTER[data] * _powers_of("up", _BASE, len(data)), out=total[1:])
    span = total[ends] - total[starts]
    return mix(span * _powers_of("down", _INVERSE, len(data))[starts])


def ngram_hashes(words: np.ndarray, counts: np.ndarray, n: int, whole: bool) -> tuple[np.ndarray, np.ndarray]:
    """(hash, number per row) of the n-word runs of every row. With ``whole``, a row of
    fewer words (but one at least) counts as one run."""
    stops = np.cumsum(counts)
    value = np.zeros(len(words), np.uint64)
    left = np.repeat(stops, counts) - np.arange(len(words))  # words from here to the row's end
    short = np.repeat(counts, counts) < n
    for k in range(n):
        here = np.zeros(len(words), np.uint64)
        here[: len(words) - k] = words[k:]
        inside = left > k
        value += np.where(inside, here, np.uint64(k + 1)) * np.uint64(pow(int(_STEP), k, 1 << 64))
    first = np.zeros(len(words), bool)
    first[(stops - counts)[counts > 0]] = True
    keep = (left >= n) | (short & first if whole else False)
    per_row = np.maximum(counts - n + 1, np.minimum(counts, 1) if whole else 0)
    return mix(value[keep]), per_row
