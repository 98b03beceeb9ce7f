"""Alignment of two tokenizers on the same texts.

Both token sequences tile the bytes of a text. Per batch, one ``merge_asof`` keyed by
document finds for each token start the other side's token that covers it; the two
directions together are all overlaps, and overlaps that end at the same byte cut both
sequences into groups. Everything in a group is linked. Links are counted over the corpus
as Spark tables: documents carry their distinct linked pairs, partial sums meet by pair, and
counts go back by a broadcast of the frequent pairs and an equi join for all others.
"""

from __future__ import annotations

import base64
import json
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from chatsieve.llm.hashing import text_chunks
from chatsieve.llm.tables import settled, texts_of

CHUNK_BYTES = 2 << 20
#: Pairs whose counts are broadcast: about 50 bytes a row in a hash table, so 50 MB at most.
BROADCAST_PAIRS = 1_000_000
_NAMES = ["row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups", "pairs", "times"]
_SCHEMA = (
    "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups string, pairs array<long>, times array<long>"
)


def byte_letters() -> dict[str, int]:
    """The byte that each letter of a byte-level vocabulary stands for: printable bytes stand
    for themselves, all others for the letters from 256 on, in order."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class Side:
    """A tokenizer and the bytes of each of its ids."""

    def __init__(self, encode: Callable[[str], list[int]], entries: dict[int, bytes]) -> None:
        self.encode = encode
        held = [entries.get(i, b"") for i in range(max(entries) + 1)]
        self.size = np.fromiter(map(len, held), np.int64, len(held))
        self.at = np.cumsum(self.size) - self.size
        self.flat = np.frombuffer(b"".join(held), np.uint8)

    def joined(self, ids: np.ndarray) -> bytes:
        size = self.size[ids]
        stop = np.cumsum(size)
        where = np.repeat(self.at[ids] - stop + size, size) + np.arange(stop[-1] if len(stop) else 0)
        return self.flat[where].tobytes()


def byte_level_side(path: str, ranks_path: str | None = None) -> Side:
    """A byte-level vocabulary; special strings inside texts are plain text. With a file of
    the same vocabulary as ranks the quicker library encodes; ids are the same. A text that
    it gives up (runs of blanks beyond its stack) goes to the other one."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    letters = byte_letters()
    with open(path, encoding="utf-8") as file:
        vocabulary = json.load(file)["model"]["vocab"]
    entries = {i: bytes(letters[c] for c in entry) for entry, i in vocabulary.items()}

    def slow(text: str) -> list[int]:
        return tokenizer.encode(text, add_special_tokens=False).ids

    if not ranks_path:
        return Side(slow, entries)
    import public_tokenizers
    import tiktoken

    with open(ranks_path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    coding = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def quick(text: str) -> list[int]:
        try:
            return coding.encode_ordinary(text)
        except BaseException as error:  # the library's panic is no Exception
            if type(error).__name__ != "PanicException" and not isinstance(error, ValueError):
                raise
            return slow(text)

    return Side(quick, entries)


def piece_side(path: str) -> Side:
    """A sentence-piece vocabulary, which puts a blank before a text by itself."""
    import sentencepiece

    pieces = sentencepiece.SentencePieceProcessor(model_file=path)
    entries = {}
    for i in range(pieces.get_piece_size()):
        piece = pieces.id_to_piece(i)
        entries[i] = bytes([int(piece[3:5], 16)]) if pieces.is_byte(i) else piece.replace("▁", " ").encode()
    return Side(lambda text: pieces.encode(text, num_threads=1), entries)


def overlaps(doc_a: np.ndarray, start_a: np.ndarray, doc_b: np.ndarray, start_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(a, b): positions of all tokens that share a byte. Starts rise over all documents."""
    left = pd.DataFrame({"doc": doc_a, "at": start_a, "a": np.arange(len(doc_a))})
    right = pd.DataFrame({"doc": doc_b, "at": start_b, "b": np.arange(len(doc_b))})
    of_a = pd.merge_asof(left, right, on="at", by="doc")
    of_b = pd.merge_asof(right, left, on="at", by="doc")
    a, b = of_b["a"].to_numpy(), of_b["b"].to_numpy()
    new = start_a[a] != start_b[b]  # tokens that start together are found from both sides
    return np.concatenate([of_a["a"].to_numpy(), a[new]]), np.concatenate([of_a["b"].to_numpy(), b[new]])


def decimals(n: int) -> tuple[np.ndarray, np.ndarray]:
    """(digits of 0 to n - 1 from the left in rows of eight bytes, number of digits)."""
    ids = np.arange(n)
    width = np.ones(n, np.int64)
    for k in range(1, 7):
        width += ids >= 10**k
    digits = np.zeros((n, 8), np.uint8)
    for k in range(7):
        there = width > k
        digits[there, k] = 48 + ids[there] // 10 ** (width[there] - 1 - k) % 10
    return digits.view(np.uint64).ravel(), width


def groups_text(ids_a, ids_b, group_a, group_b, doc_of_group, digits) -> tuple[bytes, np.ndarray]:
    """(``a1,a2|b1;a3|b2`` of all documents in a row, bytes per group). Every id is a row of
    eight bytes, its digits and the sign after it, of which those in use are kept."""
    n = len(doc_of_group)
    if not n:
        return b"", np.zeros(0, np.int64)
    till_a, till_b = np.cumsum(np.bincount(group_a, minlength=n)), np.cumsum(np.bincount(group_b, minlength=n))
    ids = np.empty(len(ids_a) + len(ids_b), np.int64)
    slot_a = np.arange(len(ids_a)) + np.append(0, till_b[:-1])[group_a]
    slot_b = np.arange(len(ids_b)) + till_a[group_b]
    ids[slot_a], ids[slot_b] = ids_a, ids_b
    after = np.full(len(ids), ord(","), np.uint8)
    after[slot_a[till_a - 1]] = ord("|")
    last = slot_b[till_b - 1]
    after[last] = ord(";")
    rows = digits[0][ids].view(np.uint8).reshape(-1, 8)
    room = digits[1][ids]
    rows[np.arange(len(ids)), room] = after
    room += 1
    room[last[np.append(doc_of_group[1:] != doc_of_group[:-1], True)]] -= 1
    kept = (np.arange(8) < np.arange(9)[:, None])[room]
    return rows[kept].tobytes(), np.add.reduceat(room, np.append(0, last[:-1] + 1))


def linked_pairs(ids_a, ids_b, group_a, group_b, doc_of_group, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, a * width + b, times), sorted and distinct. A group's distinct ids meet, each
    with its number, so repeats within a group are never expanded."""
    n = len(doc_of_group)

    def distinct(group, ids):
        key, times = np.unique(group * np.int64(1 << 32) + ids, return_counts=True)
        return key >> 32, key & 0xFFFFFFFF, times

    single = (np.bincount(group_a, minlength=n) == 1) & (np.bincount(group_b, minlength=n) == 1)
    mixed_a, mixed_b = ~single[group_a], ~single[group_b]
    ga, a, times_a = distinct(group_a[mixed_a], ids_a[mixed_a])
    gb, b, times_b = distinct(group_b[mixed_b], ids_b[mixed_b])
    many = np.bincount(gb, minlength=n)
    first = np.cumsum(many) - many
    meets = many[ga]
    left = np.repeat(np.arange(len(ga)), meets)
    right = first[ga][left] + np.arange(len(left)) - np.repeat(np.cumsum(meets) - meets, meets)
    span = np.int64(width) * np.int64(max(int(ids_a.max(initial=0)) + 1, 1))
    key = np.concatenate(
        [
            doc_of_group[single] * span + ids_a[~mixed_a] * np.int64(width) + ids_b[~mixed_b],
            doc_of_group[ga[left]] * span + a[left] * np.int64(width) + b[right],
        ]
    )
    times = np.concatenate([np.ones(int(single.sum()), np.int64), times_a[left] * times_b[right]])
    order = np.argsort(key, kind="stable")
    key, times = key[order], times[order]
    new = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, np.int64)
    return key[new] // span, key[new] % span, np.add.reduceat(times, new) if len(new) else np.zeros(0, np.int64)


def _aligned(texts: list[str | None], a: Side, b: Side, digits: tuple[np.ndarray, np.ndarray]):
    """Columns n_a to times for one chunk of texts."""
    n = len(texts)
    ids_a, ids_b, kept = [], [], []
    for k, text in enumerate(texts):
        if not text:
            continue
        one, two = np.asarray(a.encode(" " + text), np.int64), np.asarray(b.encode(text), np.int64)
        whole = (" " + text).encode()
        if a.joined(one) == whole and b.joined(two) == whole:
            ids_a.append(one)
            ids_b.append(two)
            kept.append(k)
    kept = np.array(kept, np.int64)
    per_a, per_b = (np.fromiter(map(len, x), np.int64, len(x)) for x in (ids_a, ids_b))
    ids_a, ids_b = (np.concatenate([np.zeros(0, np.int64), *x]) for x in (ids_a, ids_b))
    doc_a, doc_b = np.repeat(kept, per_a), np.repeat(kept, per_b)
    size_a, size_b = a.size[ids_a], b.size[ids_b]
    end_a, end_b = np.cumsum(size_a), np.cumsum(size_b)
    left, right = overlaps(doc_a, end_a - size_a, doc_b, end_b - size_b)
    both = end_a[left] == end_b[right]
    closes_a, closes_b = np.zeros(len(ids_a), np.int64), np.zeros(len(ids_b), np.int64)
    closes_a[left[both]] = closes_b[right[both]] = 1
    group_a, group_b = np.cumsum(closes_a) - closes_a, np.cumsum(closes_b) - closes_b
    doc_of_group = doc_a[closes_a == 1]
    m = len(doc_of_group)
    written, room = groups_text(ids_a, ids_b, group_a, group_b, doc_of_group, digits)
    links = np.bincount(group_a, minlength=m) * np.bincount(group_b, minlength=m)

    def total(of: np.ndarray, doc: np.ndarray) -> np.ndarray:
        out = np.zeros(n, np.int64)
        np.add.at(out, doc, of)
        return out

    doc, pair, times = linked_pairs(ids_a, ids_b, group_a, group_b, doc_of_group, len(b.size))
    bounds = np.append(0, np.cumsum(total(room, doc_of_group)))
    lists = pa.array(np.append(0, np.cumsum(np.bincount(doc, minlength=n))), pa.int32())
    counts = [np.bincount(doc_a, minlength=n), np.bincount(doc_b, minlength=n), np.bincount(doc_of_group, minlength=n)]
    return [
        *[pa.array(x, pa.int64()) for x in (*counts, total(links, doc_of_group))],
        pa.array([written[x:y].decode() for x, y in zip(bounds[:-1], bounds[1:], strict=True)], pa.string()),
        pa.ListArray.from_arrays(lists, pa.array((pair // len(b.size) << 32) + pair % len(b.size), pa.int64())),
        pa.ListArray.from_arrays(lists, pa.array(times, pa.int64())),
    ]


def _align_batches(batches: Iterator[pa.RecordBatch], a_path: str, b_path: str, a_ranks_path: str | None):
    a, b = byte_level_side(a_path, a_ranks_path), piece_side(b_path)
    digits = decimals(max(len(a.size), len(b.size)))
    row = TaskContext.get().partitionId() << 40
    for batch in batches:
        texts = batch.column("text")
        for first, _, offsets in text_chunks(texts, CHUNK_BYTES):
            n = len(offsets) - 1
            rows = pa.array(np.arange(row, row + n), pa.int64())
            row += n
            columns = _aligned(texts.slice(first, n).to_pylist(), a, b, digits)
            yield pa.RecordBatch.from_arrays([rows, batch.column("doc_id").slice(first, n), *columns], _NAMES)


def align(docs: DataFrame, a_path: str, b_path: str, a_ranks_path: str | None = None) -> DataFrame:
    """(row, doc_id, n_a, n_b, n_groups, n_links, groups, pairs, times), one row per document.

    ``a_path`` is a byte-level vocabulary, which encodes a blank and the text; ``b_path`` a
    sentence-piece model, which adds the blank itself. ``groups`` lists the ids of both sides
    group by group (``a1,a2|b1;a3|b2``); ``n_links`` counts all pairs of occurrences that share
    a group; ``pairs`` holds each linked (a << 32) + b once and ``times`` its number of
    links; ``row`` tells apart rows that repeat an id. NULL and empty texts, and texts that
    either side does not give back byte by byte, have no tokens: zeros, an empty string
    and empty lists. Other columns are not looked at; an empty table gives no rows. Texts are
    taken whole, in chunks of about 2 MB; a longer one is a chunk by itself. The files must be
    readable by every executor.
    """
    return texts_of(docs).mapInArrow(lambda it: _align_batches(it, a_path, b_path, a_ranks_path), _SCHEMA)


def count_links(aligned: DataFrame) -> DataFrame:
    """(pair, documents, best): in how many rows of ``align`` a pair is linked, and whether no
    other pair of its first id is in more. Settled in the shared folder."""
    counted = aligned.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count("*").alias("documents"))
    most = F.max("documents").over(Window.partitionBy(F.shiftright("pair", 32)))
    return settled(counted.withColumn("best", F.col("documents") == most), "pairs")


def frequent(counts: DataFrame, limit: int) -> int:
    """The least number of documents such that at most ``limit`` pairs are in as many, from
    the numbers of pairs per power of two."""
    sizes = counts.groupBy(F.length(F.bin("documents")).alias("bits")).agg(F.count("*").alias("n")).collect()
    total, least = 0, (1 << 63) - 1
    for r in sorted(sizes, key=lambda r: -r.bits):
        total += r.n
        if total > limit:
            break
        least = 1 << (r.bits - 1)
    return least


def score_links(aligned: DataFrame, counts: DataFrame, broadcast_pairs: int = BROADCAST_PAIRS) -> DataFrame:
    """(row, n_best, count_sum) of every row with links: how many links are of a pair that is
    the most frequent of its first id (ties included), and the sum of all links' counts.

    ``aligned`` should be settled. Counts of at most ``broadcast_pairs`` pairs are broadcast, the
    most frequent ones; the links of all other pairs, which are rare, meet their counts in an
    equi join. Both are first added up per row.
    """
    least = frequent(counts, broadcast_pairs)
    links = aligned.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("link")).select(
        "row", F.col("link.pairs").alias("pair"), F.col("link.times").alias("times")
    )
    sums = [
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"),
        F.sum(F.col("times") * F.col("documents")).alias("count_sum"),
    ]
    hot = F.broadcast(counts.where(F.col("documents") >= least))
    if counts.where(F.col("documents") < least).isEmpty():
        return links.join(hot, "pair").groupBy("row").agg(*sums)
    marked = links.join(hot, "pair", "left")
    near = marked.where("documents IS NOT NULL").groupBy("row").agg(*sums)
    far = marked.where("documents IS NULL").select("row", "pair", "times")
    far = far.join(counts.where(F.col("documents") < least), "pair").groupBy("row").agg(*sums)
    return near.unionByName(far).groupBy("row").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
