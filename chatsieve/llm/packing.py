"""Packing of tokenised documents into sequences by bulk-synchronous best fit.

Lengths are whole numbers up to the sequence length, so documents of one length are
interchangeable, and so are gaps of one size with one history. A super-step takes all
documents of the next length (longest first) against all gaps in order of size: each
group of documents goes to its successor, the smallest gap that holds it; where more
documents than gaps meet, ranks decide who goes first and the rest move on to the next
gap or open sequences; then the gaps are updated. The state of a step is a count per
size, whatever the size of the corpus, so the driver holds at most a few runs per length.
Spark numbers the documents within each length and applies the runs by rank.
"""

from __future__ import annotations

import base64
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatsieve.llm.hashing import mix, text_chunks, word_hashes, words_of
from chatsieve.llm.tables import settled, texts_of

LENGTH, END_ID, MEMO = 1024, 2, 1_000_000
_ODD_BYTE = np.zeros(256, dtype=bool)
_ODD_BYTE[[c for c in range(32) if c != 10]] = True


class UnitTable:
    """Token ids of the units seen so far. A unit is a word with the one blank or line end
    before it, which the tokenizer never joins with its neighbours. Keys are 64-bit
    hashes in a sorted array; the table starts anew when it is full."""

    def __init__(self, encode) -> None:
        self.encode = encode
        self.clear()

    def clear(self) -> None:
        self.keys = np.zeros(0, np.uint64)
        self.at = np.zeros(0, np.int64)
        self.size = np.zeros(0, np.int64)
        self.flat = np.zeros(0, np.uint32)

    def add(self, keys: np.ndarray, units: list[str]) -> None:
        """``keys`` sorted and new."""
        coded = [self.encode(u) for u in units]
        size = np.fromiter(map(len, coded), np.int64, len(coded))
        slot = np.searchsorted(self.keys, keys)
        at = len(self.flat) + np.cumsum(size) - size
        self.flat = np.concatenate([self.flat, np.fromiter((i for c in coded for i in c), np.uint32, int(size.sum()))])
        self.keys = np.insert(self.keys, slot, keys)
        self.at, self.size = np.insert(self.at, slot, at), np.insert(self.size, slot, size)

    def ids(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, opening: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words in order, ids per word); ``opening`` marks words nothing precedes."""
        before = np.where(opening, 0, data[starts - 1]).astype(np.uint64)
        codes, first, slots = np.unique(
            mix(word_hashes(data, starts, ends) + before), return_index=True, return_inverse=True
        )
        for _ in range(2):
            fresh = np.ones(len(codes), bool)
            if len(self.keys):
                fresh = self.keys[np.minimum(np.searchsorted(self.keys, codes), len(self.keys) - 1)] != codes
            if len(self.keys) + fresh.sum() <= MEMO:
                break
            self.clear()
        raw = data.tobytes()
        lead = np.where(opening, starts, starts - 1)
        self.add(codes[fresh], [raw[lead[k] : ends[k]].decode() for k in first[fresh]])
        place = np.searchsorted(self.keys, codes)
        at, size = self.at[place][slots], self.size[place][slots]
        stop = np.cumsum(size)
        return self.flat[np.repeat(at - stop + size, size) + np.arange(stop[-1] if len(stop) else 0)], size


def _regular(data: np.ndarray, offsets: np.ndarray, starts: np.ndarray, ends: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Rows whose words are parted by exactly one blank or line end each, with nothing before
    the first and after the last, and without control characters and control strings."""
    odd = _ODD_BYTE[data]
    odd[:-1] |= ((data[:-1] == 60) & (data[1:] == 124)) | ((data[:-1] == 0xC2) & (data[1:] == 0x85))
    spoilt = np.append(0, np.cumsum(odd))[offsets]
    inside = np.append(0, np.cumsum(ends - starts))
    last = np.cumsum(counts)
    solid = inside[last] - inside[last - counts]
    return (spoilt[1:] == spoilt[:-1]) & (np.diff(offsets) == solid + np.maximum(counts - 1, 0))


def _ids_of(column: pa.Array, table: UnitTable, whole) -> Iterator[bytes]:
    """Little-endian 32-bit ids of every text."""
    for first, data, offsets in text_chunks(column):
        starts, ends, counts = words_of(data, offsets)
        regular = _regular(data, offsets, starts, ends, counts)
        keep = np.repeat(regular, counts)
        opening = np.zeros(len(starts), bool)
        opening[(np.cumsum(counts) - counts)[counts > 0]] = True
        ids, size = table.ids(data, starts[keep], ends[keep], opening[keep])
        per_word = np.zeros(len(starts), np.int64)
        per_word[keep] = size
        bounds = np.append(0, np.cumsum(per_word))[np.append(0, np.cumsum(counts))]
        for row in range(len(counts)):
            if regular[row]:
                yield ids[bounds[row] : bounds[row + 1]].astype("<u4", copy=False).tobytes()
            else:
                yield np.array(whole(column[first + row].as_py()), dtype="<u4").tobytes()


def _encoders(path: str, ranks_path: str | None):
    """(for a unit, for a whole text). With a file of the same vocabulary as ranks, units
    are encoded by the library that is quicker on short strings; ids are the same."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    whole = lambda text: tokenizer.encode(text, add_special_tokens=False).ids
    if not ranks_path:
        return whole, whole
    import public_tokenizers
    import tiktoken

    with open(ranks_path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    coding = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return coding.encode_ordinary, whole


def _piece_batches(batches: Iterator[pa.RecordBatch], path: str, ranks_path: str | None, length: int, end_id: int):
    encode, whole = _encoders(path, ranks_path)
    table = UnitTable(encode)
    end = np.array([end_id], dtype="<u4").tobytes()
    types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
    names = ["doc_id", "piece", "start", "length", "ids_crc32"]
    for batch in batches:
        out = []
        for doc_id, ids in zip(batch.column("doc_id").to_pylist(), _ids_of(batch.column("text"), table, whole), strict=True):
            ids += end
            count = len(ids) // 4
            start, piece = 0, 0
            while start < count:
                size = (count - start) % length or length
                out.append((doc_id, piece, start, size, zlib.crc32(ids[4 * start : 4 * (start + size)])))
                start, piece = start + size, piece + 1
        columns = zip(*out, strict=True) if out else [[]] * 5
        yield pa.RecordBatch.from_arrays([pa.array(list(x), t) for x, t in zip(columns, types, strict=True)], names)


def pieces(
    docs: DataFrame, tokenizer_path: str, ranks_path: str | None = None, length: int = LENGTH, end_id: int = END_ID
) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32): every document and its end id, cut into
    pieces of ``length`` tokens of which the first may be shorter. ``ranks_path`` may name
    the same vocabulary as ranks. The files must be readable by every executor."""
    return texts_of(docs).mapInArrow(
        lambda it: _piece_batches(it, tokenizer_path, ranks_path, length, end_id),
        "doc_id long, piece int, start long, length long, ids_crc32 long",
    )


def best_fit_runs(counts: dict[int, int], length: int = LENGTH) -> list[tuple[int, int, int, int, int]]:
    """(length, first rank, last rank + 1, first sequence, offset): runs of documents of one
    length, in rank order, each laid into consecutive sequences at one offset."""
    gaps: dict[int, list[tuple[int, int]]] = {}  # gap -> runs of sequences (first, count)
    opened, runs = 0, []
    for size in sorted(counts, reverse=True):
        rank, left = 0, counts[size]
        gap = size
        while left:
            while gap <= length and not gaps.get(gap):
                gap += 1
            if gap <= length:
                first, n = gaps[gap].pop()
            else:  # no gap holds this length: a sequence for each that fits side by side
                gap, n = length, -(-left // (length // size))
                first, opened = opened, opened + n
            put = min(n, left)
            runs.append((size, rank, rank + put, first, length - gap))
            rank, left = rank + put, left - put
            if put < n:
                gaps.setdefault(gap, []).append((first + put, n - put))
            if gap > size:
                gaps.setdefault(gap - size, []).append((first, put))
            gap = size
    return runs


def ranked(items: DataFrame, per_deal: int = 50_000) -> DataFrame:
    """``items`` with ``rank``, from 0 within each length. Rows are numbered within (length,
    deal) and deals are added up, so that a length that a third of all rows share is
    numbered by many tasks."""
    deals = max(1, -(-items.count() // per_deal))
    dealt = items.withColumn("deal", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(deals)))
    sizes = dealt.groupBy("length", "deal").agg(F.count("*").alias("n"))
    before = sizes.selectExpr(
        "length", "deal", "sum(n) OVER (PARTITION BY length ORDER BY deal) - n AS before"
    )
    numbered = dealt.selectExpr(
        "*", "row_number() OVER (PARTITION BY length, deal ORDER BY doc_id, piece, ids_crc32) - 1 AS at"
    )
    return numbered.join(before, ["length", "deal"]).withColumn("rank", F.col("before") + F.col("at")).drop("deal", "before", "at")


def pack(
    docs: DataFrame, tokenizer_path: str, ranks_path: str | None = None, length: int = LENGTH, end_id: int = END_ID
) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset), one row per piece.

    Best fit decreasing: no document could have gone to a gap when it was placed that was
    smaller than the one it took. NULL and empty texts are the end id alone. Repeated rows
    are packed each; a NULL id is packed like any other. Other columns are not looked at.
    An empty table gives no rows.
    """
    spark = docs.sparkSession
    items = settled(pieces(docs, tokenizer_path, ranks_path, length, end_id), "pieces")
    counts = {r.length: r.n for r in items.groupBy("length").agg(F.count("*").alias("n")).collect()}
    runs = best_fit_runs(counts, length)
    plan = spark.createDataFrame(runs, "length long, lo long, hi long, first long, offset long")
    placed = ranked(items).join(F.broadcast(plan), "length").where("rank >= lo AND rank < hi")
    return placed.select(
        "doc_id", "piece", "start", "length", "ids_crc32", (F.col("first") + F.col("rank") - F.col("lo")).alias("sequence_id"), "offset"
    )
