"""Packing of tokenised documents by non-negative least squares over their lengths.

Combinations of up to three lengths that fill a window exactly are enumerated. Their
repeat counts are solved against the histogram of lengths by non-negative least squares,
rounded, and held within the supply; combinations that still fit are then taken greedily,
and what is left is laid end to end and cut at the window ends. All of this sees one number
per length, whatever the size of the corpus. Spark tokenises, numbers the documents of
each length and applies the plan by rank.

A window is the sequence length, or a smaller size at which a sequence is not padded
(powers of two), so that in the end no sequence needs padding.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chatsieve.llm.alignment import byte_letters
from chatsieve.llm.hashing import text_chunks, words_of
from chatsieve.llm.packing import UnitTable
from chatsieve.llm.tables import settled, texts_of

LENGTH, END_ID = 2048, 1
#: Rows of cut documents (16 bytes each) that are broadcast to fetch their ids; more are joined.
BROADCAST_CUTS = 200_000
FLUSH_BYTES = CHUNK_BYTES = 1 << 20
_NAMES = ["row", "doc_id", "start", "length", "ids_crc32", "doc_tokens", "ids"]
_TYPES = [*[pa.int64()] * 6, pa.binary()]
_SCHEMA = "row long, doc_id long, start long, length long, ids_crc32 long, doc_tokens long, ids binary"


def free_sizes(length: int) -> tuple[int, ...]:
    """Sizes at which a sequence is not padded: the length itself and powers of two."""
    return tuple(sorted({length} | {1 << k for k in range(length.bit_length()) if 1 << k <= length}, reverse=True))


#: ASCII signs that may end a word; the other signs can be part of a contraction or a control string.
_SIGN = np.zeros(256, dtype=bool)
_SIGN[[c for c in range(33, 127) if not chr(c).isalnum() and chr(c) not in "'<>|"]] = True
_LETTER = np.zeros(256, dtype=bool)
_LETTER[[c for c in range(65, 123) if chr(c).isalpha()]] = True
_tables: dict[str, UnitTable] = {}


def _ended(body: bytes) -> bytes | None:
    """Letters with the end of the word marked on their last byte: it becomes a byte that
    letters have nowhere else (A to Z, or one below 64), or None if it is no letter's."""
    last = body[-1]
    if 97 <= last <= 122:
        return body[:-1] + bytes([last - 32])
    return body[:-1] + bytes([last - 128]) if 128 <= last < 192 else None


def _word_encoder(path: str):
    """Ids of one unit. Words of Latin letters, which are most, go by the vocabulary's merge
    ranks to the library that is quicker on short strings, the word end as part of the last
    byte; ids are the same. All other units go to the tokenizer."""
    import tiktoken
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    letters = byte_letters()
    with open(path, encoding="utf-8") as file:
        vocabulary = json.load(file)["model"]["vocab"]
    ranks = {}
    for entry, i in vocabulary.items():
        end = entry.endswith("</w>") and entry != "</w>"
        body = bytes(letters.get(c, 0) for c in (entry[:-4] if end else entry))
        if all(97 <= c <= 122 or c >= 128 for c in body) and (marked := _ended(body) if end else body):
            ranks[marked] = i
    coding = tiktoken.Encoding("words", pat_str=r"[a-z]+", mergeable_ranks=ranks, special_tokens={})
    piece = coding._core_bpe.encode_single_piece

    def encode(unit: str) -> list[int]:
        if unit.isalpha() and (unit.isascii() or max(unit) <= "\u024f"):
            low = unit.lower()
            if max(low) <= "\u024f":
                return piece(_ended(low.encode()))
        return tokenizer.encode(unit, add_special_tokens=False).ids

    return encode


def _units_of(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(bytes with A-Z in lower case but for words with a ``<``, start and end of every unit, units
    per word). A unit is a word, or its part up to the last ASCII letter before the signs that
    end it, and these signs."""
    low = data + ((data >= 65) & (data <= 90)).astype(np.uint8) * 32
    held = np.append(0, np.cumsum(data == 60))
    for k in np.flatnonzero(held[ends] > held[starts]):
        low[starts[k] : ends[k]] = data[starts[k] : ends[k]]
    before = np.maximum.accumulate(np.where(_SIGN[data], -1, np.arange(len(data)))) if len(data) else np.zeros(0, np.int64)
    at = before[ends - 1]
    split = (at >= starts) & (at < ends - 1) & _LETTER[data[np.maximum(at, 0)]]
    per_word = 1 + split.astype(np.int64)
    first = np.cumsum(per_word) - per_word
    unit_starts, unit_ends = np.repeat(starts, per_word), np.repeat(ends, per_word)
    unit_ends[first[split]] = unit_starts[first[split] + 1] = at[split] + 1
    return low, unit_starts, unit_ends, per_word


def _ids_of(column: pa.Array, table: UnitTable) -> Iterator[np.ndarray]:
    """Ids of every text."""
    for _, data, offsets in text_chunks(column, CHUNK_BYTES):
        starts, ends, counts = words_of(data, offsets)
        low, starts, ends, per_word = _units_of(data, starts, ends)
        ids, size = table.ids(low, starts, ends, np.ones(len(starts), bool))
        words = np.append(0, np.cumsum(per_word))[np.append(0, np.cumsum(counts))]
        bounds = np.append(0, np.cumsum(size))[words]
        for start, end in zip(bounds[:-1], bounds[1:], strict=True):
            yield ids[start:end]


def _table_of(path: str) -> UnitTable:
    """The units that this worker has seen, also in tasks before."""
    if path not in _tables:
        _tables[path] = UnitTable(_word_encoder(path))
    return _tables[path]


def _piece_batches(batches: Iterator[pa.RecordBatch], path: str, length: int, end_id: int):
    table = _table_of(path)
    row = TaskContext.get().partitionId() << 40
    out: list[tuple] = []
    held = 0

    def flushed() -> pa.RecordBatch:
        columns = zip(*out, strict=True)
        return pa.RecordBatch.from_arrays([pa.array(list(x), t) for x, t in zip(columns, _TYPES, strict=True)], _NAMES)

    for batch in batches:
        for doc_id, ids in zip(batch.column("doc_id").to_pylist(), _ids_of(batch.column("text"), table), strict=True):
            written = np.append(ids, end_id).astype("<u4").tobytes()
            tokens = len(written) // 4
            for start in range(0, tokens, length):
                part = written[4 * start : 4 * (start + length)]
                whole = len(part) == 4 * length
                out.append((row, doc_id, start, len(part) // 4, zlib.crc32(part), tokens, None if whole else part))
                row += 1
                held += 100 + (0 if whole else len(part))
                if held >= FLUSH_BYTES:
                    yield flushed()
                    out, held = [], 0
    if out:
        yield flushed()


def pieces(docs: DataFrame, tokenizer_path: str, length: int = LENGTH, end_id: int = END_ID) -> DataFrame:
    """(row, doc_id, start, length, ids_crc32, doc_tokens, ids): every document and its end id;
    full windows come first, and the rest, if any, keeps its ids (little-endian, 32 bits).
    ``row`` tells all pieces apart. The vocabulary is one whose tokens never span white space;
    its file must be readable by every executor."""
    return texts_of(docs).mapInArrow(lambda it: _piece_batches(it, tokenizer_path, length, end_id), _SCHEMA)


def combinations(present: np.ndarray, sizes: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray]:
    """(parts, size): every way to fill one of ``sizes`` with one to three of the lengths in
    ``present``; parts are in falling order, 0 where there is none."""
    there = np.zeros(max(sizes) + 1, bool)
    there[present] = True
    a, b = (x.ravel() for x in np.meshgrid(present, np.append(0, present), indexing="ij"))
    a, b = a[b <= a], b[b <= a]
    parts, filled = [], []
    for size in sizes:
        c = size - a - b
        fits = (c >= 0) & (c <= b)
        rest = c[fits]
        fits[fits] = (rest == 0) | there[rest]
        parts.append(np.stack([a[fits], b[fits], c[fits]], axis=1))
        filled.append(np.full(int(fits.sum()), size))
    return np.concatenate(parts), np.concatenate(filled)


def solve_repeats(parts: np.ndarray, supply: np.ndarray, sweeps: int = 300, tolerance: float = 1e-4) -> np.ndarray:
    """Non-negative least squares: repeat counts x >= 0 of the combinations that bring the
    number of parts of each length nearest to ``supply`` (index = length; 0 is no part).

    Descent by blocks of coordinates: in each sweep the combinations that gain most and have
    no length in common each take their exact one-dimensional minimum. From zero this
    keeps the solution sparse, so that most counts are large enough to survive rounding.
    """
    x = np.zeros(len(parts))
    if not len(parts):
        return x
    a, b, c = parts.T
    norm = 1.0 + (b > 0) * np.where(b == a, 3.0, 1.0) + (c > 0) * np.where(c == a, 5.0, np.where(c == b, 3.0, 1.0))
    left = supply.astype(float)
    left[0] = 0.0
    start = np.linalg.norm(left)
    for _ in range(sweeps):
        step = np.maximum((left[a] + left[b] + left[c]) / norm, -x)
        gain = step * step * norm
        most = min(len(gain), 4 * len(supply))
        best = np.argpartition(-gain, most - 1)[:most]
        best = best[np.argsort(-gain[best], kind="stable")]
        used = np.zeros(len(supply), bool)
        chosen = []
        for j, (p, q, r) in zip(best.tolist(), parts[best].tolist()):
            if not (used[p] or used[q] or used[r]):
                chosen.append(j)
                used[[p, q, r]] = True
                used[0] = False
        chosen = np.array(chosen)
        if gain[chosen].sum() <= (tolerance * start) ** 2:
            break
        x[chosen] += step[chosen]
        for part in parts[chosen].T:
            np.subtract.at(left, part, step[chosen])
        left[0] = 0.0
    return x


def _take(parts: np.ndarray, wanted: np.ndarray, supply: np.ndarray) -> np.ndarray:
    """How often each combination is taken, in the given order, from what is left of
    ``supply``, which is lowered."""
    taken = np.zeros(len(parts), np.int64)
    for j, (p, q, r) in enumerate(parts.tolist()):
        need: dict[int, int] = {}
        for k in (p, q, r):
            if k:
                need[k] = need.get(k, 0) + 1
        n = min(int(wanted[j]), *(int(supply[k]) // m for k, m in need.items()))
        if n > 0:
            taken[j] = n
            for k, m in need.items():
                supply[k] -= n * m
    return taken


@dataclass
class Plan:
    """``runs``: (length, lo, hi, first sequence, offset): documents of one length and of rank lo
    to hi - 1 lie in consecutive sequences at one offset. ``rest``: (length, lo, place): those of
    rank lo and above lie end to end from ``place`` on the line of what is left. The line is
    cut into windows of the full length from sequence ``first`` on, then at ``cuts``."""

    runs: list[tuple[int, int, int, int, int]]
    rest: list[tuple[int, int, int]]
    first: int
    full: int
    cuts: list[int]


def plan_packing(counts: dict[int, int], length: int, sizes: tuple[int, ...]) -> Plan:
    """The plan for so many documents of each length below ``length``."""
    supply = np.zeros(length + 1, np.int64)
    for size, n in counts.items():
        supply[size] = n
    parts, _ = combinations(np.flatnonzero(supply), sizes)
    wanted = np.rint(solve_repeats(parts, supply)).astype(np.int64)
    picked = np.flatnonzero(wanted)
    picked = picked[np.argsort(-wanted[picked], kind="stable")]
    chosen = [(parts[picked], _take(parts[picked], wanted[picked], supply))]
    open_ = np.flatnonzero(((supply[parts] > 0) | (parts == 0)).all(axis=1))
    open_ = open_[np.lexsort((-parts[open_, 1], -parts[open_, 0], -parts[open_].sum(axis=1)))]
    chosen.append((parts[open_], _take(parts[open_], np.full(len(open_), supply.sum()), supply)))

    runs, used, sequence = [], np.zeros(length + 1, np.int64), 0
    for combos, taken in chosen:
        for j in np.flatnonzero(taken):
            n, offset = int(taken[j]), 0
            for part in combos[j].tolist():
                if part:
                    runs.append((part, int(used[part]), int(used[part]) + n, sequence, offset))
                    used[part] += n
                    offset += part
            sequence += n
    rest, place = [], 0
    for size in np.flatnonzero(supply)[::-1].tolist():
        rest.append((size, int(used[size]), place))
        place += size * int(supply[size])
    full = place // length
    cuts, at = [], full * length
    for size in sizes:
        while at + size <= place:
            cuts.append(at)
            at += size
    if at < place:
        cuts.append(at)
    return Plan(runs, rest, sequence, full, cuts)


def ranked(items: DataFrame, counts: dict[int, int]) -> DataFrame:
    """``items`` with ``rank``, from 0 within each length. The rows of a length are dealt to so
    many groups that none is above a quarter of an even shuffle partition, numbered there,
    and the groups are added up. There are at most four groups per partition and one per
    length, so their sizes are broadcast."""
    spark = items.sparkSession
    per_deal = max(64, sum(counts.values()) // (4 * int(spark.conf.get("spark.sql.shuffle.partitions"))))
    deals = spark.createDataFrame([(k, -(-n // per_deal)) for k, n in counts.items()], "length long, deals long")
    dealt = items.join(F.broadcast(deals), "length").withColumn("deal", F.pmod(F.xxhash64("row"), "deals")).drop("deals")
    sizes = dealt.groupBy("length", "deal").agg(F.count("*").alias("n"))
    before = sizes.selectExpr("length", "deal", "sum(n) OVER (PARTITION BY length ORDER BY deal) - n AS before")
    numbered = dealt.selectExpr("*", "row_number() OVER (PARTITION BY length, deal ORDER BY row) - 1 AS at")
    return numbered.join(F.broadcast(before), ["length", "deal"]).withColumn("rank", F.col("before") + F.col("at"))


def _cut_places(place: Column, size: Column, plan: Plan, length: int) -> Column:
    """Where the windows that a document on the line meets begin, its own place first."""
    ends = (F.floor(place / length) + 1) * length
    later = F.array(ends, *[F.lit(c).cast("long") for c in plan.cuts])
    inside = F.filter(later, lambda c: (c > place) & (c < place + size) & ((c <= plan.full * length) | (c != ends)))
    return F.array_sort(F.array_distinct(F.concat(F.array(place), inside)))


def _window_of(at: Column, plan: Plan, length: int) -> tuple[Column, Column]:
    """(window, offset in it) of a place on the line."""
    begins = F.array(*[F.lit(c).cast("long") for c in plan.cuts]) if plan.cuts else F.array().cast("array<long>")
    passed = F.filter(begins, lambda c: c <= at)
    in_full = at < plan.full * length
    window = F.when(in_full, F.floor(at / length)).otherwise(F.lit(plan.full - 1) + F.size(passed))
    return window.cast("long"), F.when(in_full, at % length).otherwise(at - F.array_max(passed))


def pack(docs: DataFrame, tokenizer_path: str, length: int = LENGTH, end_id: int = END_ID) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset), one row per piece.

    Every sequence holds ``length`` tokens or a power of two, so none needs padding. Documents
    are cut only into full windows and, few of them, at window ends of the line that holds
    what no combination takes. NULL and empty texts are the end id alone. Rows that repeat
    are packed each, and a NULL id like any other; of documents of one length it does not
    matter which goes where. Other columns are not looked at; an empty table gives no rows.
    A long text is tokenised whole, by its words.
    """
    spark = docs.sparkSession
    items = settled(pieces(docs, tokenizer_path, length, end_id), "items", compression="zstd")
    slim = items.drop("ids")
    parts = slim.where(F.col("length") < length)
    counts = {r.length: r.n for r in parts.groupBy("length").agg(F.count("*").alias("n")).collect()}
    plan = plan_packing(counts, length, free_sizes(length))
    out = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    filled = slim.where(F.col("length") == length).withColumns({"sequence_id": -1 - F.col("row"), "offset": F.lit(0).cast("long")})
    if not counts:
        return filled.select(out)

    runs = [(*r, None) for r in plan.runs] + [(size, lo, 1 << 62, None, None, place) for size, lo, place in plan.rest]
    runs = spark.createDataFrame(runs, "length long, lo long, hi long, first long, offset long, place long")
    number = settled(
        ranked(parts, counts).join(F.broadcast(runs), "length").where("rank >= lo AND rank < hi").select(
            *slim.columns, (F.col("first") + F.col("rank") - F.col("lo")).alias("sequence_id"), "offset",
            (F.col("place") + (F.col("rank") - F.col("lo")) * F.col("length")).alias("place"),
        ),
        "numbered",
    )
    line = number.where("place IS NOT NULL").withColumn("cuts", _cut_places(F.col("place"), F.col("length"), plan, length))

    def laid(of: DataFrame, at: Column, start: Column, size: Column, crc: Column) -> DataFrame:
        window, offset = _window_of(at, plan, length)
        columns = (start, size, crc, F.col("doc_tokens"), window + plan.first, offset)
        return of.select("doc_id", *[c.alias(name) for c, name in zip(columns, out[1:])])

    uncut = laid(line.where(F.size("cuts") == 1), F.col("place"), F.col("start"), F.col("length"), F.col("ids_crc32"))
    cut = line.where(F.size("cuts") > 1).select("row", "doc_id", "start", "length", "doc_tokens", "place", "cuts")
    few = plan.full + len(plan.cuts) <= BROADCAST_CUTS
    cut = items.select("row", "ids").where("ids IS NOT NULL").join(F.broadcast(cut) if few else cut, "row")
    cut = cut.select("*", F.posexplode("cuts").alias("k", "at"))
    till = F.coalesce(F.get("cuts", F.col("k") + 1), F.col("place") + F.col("length"))
    before, size = F.col("at") - F.col("place"), till - F.col("at")
    crc = F.crc32(F.substring("ids", (before * 4 + 1).cast("int"), (size * 4).cast("int")))
    cut = laid(cut, F.col("at"), F.col("start") + before, size, crc)
    return filled.select(out).unionByName(number.where("place IS NULL").select(out)).unionByName(uncut).unionByName(cut)
