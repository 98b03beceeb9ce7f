"""The matched models of ``scoring``, for a corpus that is scored by its own counts.

Counts of pairs are needed once, by the documents that hold the pairs, so they are never
a table. Every document sends each rare word and pair once, with its number, to a bucket;
there the numbers are added up and the terms are handed back, summed per document. A
pair goes to the bucket of its rare word, whose count is known there too; frequent words and
pairs are broadcast. Pairs of two rare words leave their first bucket with all but the
count of the second word, which an equi join adds.

Entries travel in columns: per bucket and flush one row of packed arrays. A bucket holds those
of about ``BUCKET`` tokens whatever the size of the corpus; a task settles several, one at
a time, and sums their terms per document before it hands them back.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chatsieve.llm.hashing import mix
from chatsieve.llm.scoring import SIDES, WEIGHT, WORD_SHARE, Hot, _pairs_of, _tokens
from chatsieve.llm.tables import settled

#: One document in so many is looked at to guess which pairs are frequent; a pair is taken for
#: frequent from this share of their pairs on, and 3 times. A wrong guess costs time only.
SAMPLE, PAIR_SHARE = 16, 1e-6
BUCKET, FLUSH, ROWS, CHUNK = 1_000_000, 400_000, 1 << 16, 1 << 20
#: Buckets that a task handles one after the other at most, and the least number of such groups.
TOGETHER, GROUPS = 16, 16
#: Ids of wanted documents that are broadcast (16 bytes each); more are joined once.
BROADCAST_IDS = 2_000_000
RARE_WORD, BOTH_FREQUENT, RARE_HEAD, RARE_TAIL, BOTH_RARE = range(5)
_ENTRY = "bucket int, packed binary"  # buckets of one group are equal modulo the number of groups
_FIELDS = ((np.uint8, "kind"), (np.uint64, "u"), (np.uint64, "v"), (np.uint32, "slot"), (np.uint32, "n"), (np.int64, "keys"), (np.uint8, "wanted"))


def _summed(parts: list[list[np.ndarray]]) -> list[np.ndarray]:
    """(kind, gram, sums) with equal ones added up."""
    kind, gram, *sums = (np.concatenate(c) for c in zip(*parts, strict=True))
    order = np.lexsort((gram, kind))
    kind, gram = kind[order], gram[order]
    new = np.flatnonzero(np.append(True, (kind[1:] != kind[:-1]) | (gram[1:] != gram[:-1])))
    return [kind[new], gram[new], *[np.add.reduceat(s[order], new) for s in sums]]


def _count_rows(columns: list[np.ndarray]) -> pa.RecordBatch:
    kind, gram, *sums = columns
    return pa.RecordBatch.from_arrays([pa.array(kind), pa.array(gram.view(np.int64)), *[pa.array(s.astype(np.int64)) for s in sums]], ["kind", "gram", *SIDES])


def _sample_batches(batches: Iterator[pa.RecordBatch]):
    """Pairs with their words and number, combined per chunk."""
    for batch in batches:
        for _, words, counts in _tokens(batch.column("text"), CHUNK):
            pairs, inner = _pairs_of(words, counts)
            at = np.flatnonzero(inner)
            grams, index, n = np.unique(pairs, return_index=True, return_counts=True)
            columns = [x.view(np.int64) for x in (grams, words[at - 1][index], words[at][index])]
            yield from _sliced(pa.RecordBatch.from_arrays([*map(pa.array, columns), pa.array(n)], ["gram", "head", "tail", "n"]))


def _frequency_batches(batches: Iterator[pa.RecordBatch], sent):
    """Counts of all words (kind 0) and of the pairs that may be frequent (kind 1), combined in the task."""
    parts, held = [], 0
    listed = sent.value
    for batch in batches:
        wanted = batch.column("wanted").to_numpy(zero_copy_only=False)
        for first, words, counts in _tokens(batch.column("text"), CHUNK):
            target = np.repeat(wanted[first : first + len(counts)], counts).astype(float)
            pairs, inner = _pairs_of(words, counts)
            at = np.minimum(np.searchsorted(listed, pairs), max(len(listed) - 1, 0))
            likely = listed[at] == pairs if len(listed) else np.zeros(len(pairs), bool)
            for kind, keys, marks in ((0, words, target), (1, pairs[likely], target[inner][likely])):
                grams, slot = np.unique(keys, return_inverse=True)
                sums = [np.bincount(slot, marks, len(grams)), np.bincount(slot, minlength=len(grams)).astype(float)]
                parts.append([np.full(len(grams), kind, np.int32), grams, *sums])
                held += len(grams)
            if held > FLUSH:
                parts = [_summed(parts)]
                held = len(parts[0][0])
                if held > FLUSH // 2:
                    yield from _sliced(_count_rows(parts[0]))
                    parts, held = [], 0
    if held:
        yield from _sliced(_count_rows(_summed(parts)))


def _sliced(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    for k in range(0, len(batch), ROWS):
        yield batch.slice(k, ROWS)


@dataclass
class Frequent:
    """What every task holds: words by sorted hash with their counts, pairs with their terms,
    token and vocabulary totals."""

    words: Hot
    pairs: Hot
    totals: np.ndarray
    weight: float

    def place(self, words: np.ndarray) -> np.ndarray:
        """Number of each frequent word, -1 for a rare one."""
        held = self.words.grams
        if not len(held):
            return np.full(len(words), -1)
        at = np.minimum(np.searchsorted(held, words), len(held) - 1)
        return np.where(held[at] == words, at, -1)

    def pair_terms(self, pair: np.ndarray, head: np.ndarray, tail: np.ndarray) -> np.ndarray:
        """Terms from counts, a row of two each."""
        share = pair / np.maximum(head, 1.0)
        return -np.log1p(self.weight / (1 - self.weight) * share / ((tail + 1.0) / self.totals))


def _frequent_pairs(likely, counts: Hot, known: Frequent) -> Hot:
    """Terms of the pairs that may be frequent and whose words both are."""
    head, tail = (likely[c].to_numpy(np.int64).view(np.uint64) for c in ("head", "tail"))
    grams = likely["gram"].to_numpy(np.int64).view(np.uint64)
    (of_head, there), (of_tail, too), (of_pair, _) = known.words.look(head), known.words.look(tail), counts.look(grams)
    both = there & too
    order = np.argsort(grams[both])
    return Hot(grams[both][order], known.pair_terms(of_pair, of_head, of_tail)[both][order])


def _held_batches(batches: Iterator[pa.RecordBatch], sent):
    """Tokens and losses of every row, as far as frequent words and pairs go."""
    known = sent.value
    unseen, backoff = np.log(known.totals), -np.log(1 - known.weight)
    for batch in batches:
        sums, sizes = [np.zeros((0, 2))], [np.zeros(0, np.int64)]
        for _, words, counts in _tokens(batch.column("text"), CHUNK):
            loss = unseen - np.log1p(known.words.look(words)[0])
            pairs, inner = _pairs_of(words, counts)
            loss[inner] += backoff + known.pairs.look(pairs)[0]
            total = np.vstack([np.zeros(2), np.cumsum(loss, axis=0)])
            stops = np.cumsum(counts)
            sums.append(total[stops] - total[stops - counts])
            sizes.append(counts)
        both, size = np.vstack(sums), np.concatenate(sizes)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("key"), pa.array(size.astype(np.int64)), pa.array(both[:, 0]), pa.array(both[:, 1])],
            ["doc_id", "key", "n_tokens", "held_target", "held_background"],
        )


def _entries(words: np.ndarray, counts: np.ndarray, known: Frequent) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(kind, u, v, row of the chunk) of every rare word and pair. u is a rare word, or the
    numbers of two frequent ones; v is the other word of a pair."""
    row = np.repeat(np.arange(len(counts)), counts)
    place = known.place(words)
    rare = place < 0
    yield RARE_WORD, words[rare], np.zeros(int(rare.sum()), np.uint64), row[rare]
    pairs, inner = _pairs_of(words, counts)
    tail = np.flatnonzero(inner)[~known.pairs.look(pairs)[1]]
    head = tail - 1
    p, q = place[head], place[tail]
    for kind, some, u, v in (
        (BOTH_FREQUENT, (p >= 0) & (q >= 0), (p << 32) + q, None),
        (RARE_HEAD, (p < 0) & (q >= 0), words[head], q),
        (RARE_TAIL, (p >= 0) & (q < 0), words[tail], p),
        (BOTH_RARE, (p < 0) & (q < 0), words[head], words[tail]),
    ):
        other = np.zeros(int(some.sum()), np.uint64) if v is None else v[some].astype(np.uint64)
        yield kind, u[some].astype(np.uint64), other, row[tail[some]]


def _planes(values: np.ndarray) -> bytes:
    """The bytes of an array by their weight, so that those of small numbers are alike."""
    return values.view(np.uint8).reshape(len(values), -1).T.tobytes()


def _from_planes(data: memoryview, kind: type, n: int) -> np.ndarray:
    width = np.dtype(kind).itemsize
    return np.frombuffer(data, np.uint8, n * width).reshape(width, n).T.copy().view(kind).ravel()


def _pack(columns: list[np.ndarray]) -> bytes:
    """Arrays of the ``_FIELDS`` as one compressed string; u is sorted and goes as differences."""
    columns[1] = np.diff(columns[1], prepend=np.uint64(0))
    data = [np.array([len(columns[0]), len(columns[-1])], np.int64).tobytes()]
    return zstandard.compress(b"".join(data + [_planes(c.astype(t)) for c, (t, _) in zip(columns, _FIELDS, strict=True)]), 1)


def _unpack(packed: bytes) -> list[np.ndarray]:
    data = memoryview(zstandard.decompress(packed))
    n, docs = np.frombuffer(data, np.int64, 2)
    out, at = [], 16
    for kind, name in _FIELDS:
        size = docs if name in ("keys", "wanted") else n
        out.append(_from_planes(data[at:], kind, size))
        at += size * np.dtype(kind).itemsize
    out[1] = np.cumsum(out[1], dtype=np.uint64)
    return out


def _packed(parts: list, keys: np.ndarray, wanted: np.ndarray, buckets: int) -> Iterator[pa.RecordBatch]:
    """One row per bucket with all its entries, in the order of kind and u, and the documents
    that they lie in."""
    kind = np.concatenate([np.full(len(p[1]), p[0], np.uint8) for p in parts])
    u, v, row, n = (np.concatenate([p[k] for p in parts]) for k in range(1, 5))
    bucket = (mix(u) % np.uint64(buckets)).astype(np.int32)
    order = np.lexsort((u, kind, bucket))
    kind, u, v, row, n, bucket = (x[order] for x in (kind, u, v, row, n, bucket))
    cuts = np.append(np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])), len(bucket))
    out = []
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        rows, slot = np.unique(row[a:b], return_inverse=True)
        out.append((int(bucket[a]), _pack([kind[a:b], u[a:b], v[a:b], slot, n[a:b], keys[rows], wanted[rows]])))
    for k in range(0, len(out), 512):
        columns = zip(*out[k : k + 512], strict=True)
        yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, (pa.int32(), pa.binary()), strict=True)], ["bucket", "packed"])


def _entry_batches(batches: Iterator[pa.RecordBatch], sent, buckets: int):
    known = sent.value
    parts, keys, wanted, held, rows = [], [], [], 0, 0
    for batch in batches:
        all_keys, all_wanted = batch.column("key").to_numpy(), batch.column("wanted").to_numpy(zero_copy_only=False)
        for first, words, counts in _tokens(batch.column("text"), CHUNK):
            for kind, u, v, row in _entries(words, counts, known):
                same = mix(mix(u) + mix(v + np.uint64(kind)) * np.uint64(3) + row.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
                _, at, n = np.unique(same, return_index=True, return_counts=True)
                parts.append((kind, u[at], v[at], row[at] + rows, n))
                held += len(at)
            keys.append(all_keys[first : first + len(counts)])
            wanted.append(all_wanted[first : first + len(counts)])
            rows += len(counts)
            if held > FLUSH:
                yield from _packed(parts, np.concatenate(keys), np.concatenate(wanted), buckets)
                parts, keys, wanted, held, rows = [], [], [], 0, 0
    if held:
        yield from _packed(parts, np.concatenate(keys), np.concatenate(wanted), buckets)


def _grouped(u: np.ndarray, v: np.ndarray, n: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(u and v of the distinct entries, their counts on both sides, distinct entry of each)."""
    order = np.lexsort((v, u))
    new = np.append(True, (u[order][1:] != u[order][:-1]) | (v[order][1:] != v[order][:-1])) if len(u) else np.zeros(0, bool)
    group = np.empty(len(u), np.int64)
    group[order] = np.cumsum(new) - 1
    size = int(new.sum())
    counts = np.stack([np.bincount(group, n * wanted, size), np.bincount(group, n, size)], axis=1)
    return u[order][new], v[order][new], counts, group


def _settle_group(table: pa.Table, sent) -> pa.Table:
    """(key, target, background, tail, n): sums of terms per document, and what pairs of two rare
    words have without the count of their tail. One bucket is unpacked at a time."""
    known: Frequent = sent.value
    buckets = table.column("bucket").to_numpy()
    packed = table.column("packed")
    docs, sums, far = np.zeros(0, np.int64), np.zeros((0, 2)), []
    for bucket in np.unique(buckets):
        keys, values, rest = _settle_bucket([packed[int(k)].as_py() for k in np.flatnonzero(buckets == bucket)], known)
        docs, slot = np.unique(np.concatenate([docs, keys]), return_inverse=True)
        values = np.concatenate([sums, values])
        sums = np.stack([np.bincount(slot, values[:, k], len(docs)) for k in (0, 1)], axis=1)
        far.append(rest)
    far = [np.concatenate(c) for c in zip(*far, strict=True)]
    key, both = np.concatenate([docs, far[0]]), np.vstack([sums, far[1]])
    tail = pa.array(np.concatenate([np.zeros(len(docs), np.int64), far[2]]), mask=np.arange(len(key)) < len(docs))
    n = pa.array(np.concatenate([np.zeros(len(docs), np.int64), far[3]]))
    return pa.table({"key": pa.array(key), "target": pa.array(both[:, 0]), "background": pa.array(both[:, 1]), "tail": tail, "n": n})


def _settle_bucket(packed: list[bytes], known: Frequent):
    """(document keys, terms of their entries, (key, counts, tail, n) of pairs of two rare words)."""
    parts = [_unpack(x) for x in packed]
    kind, u, v = (np.concatenate([p[k] for p in parts]) for k in range(3))
    n = np.concatenate([p[4] for p in parts]).astype(float)
    keys = np.concatenate([p[5][p[3]] for p in parts])
    wanted = np.concatenate([p[6][p[3]] for p in parts]).astype(float)
    del parts
    merged = {k: [x[kind == k] for x in (u, v, n, keys, wanted)] for k in np.unique(kind).tolist()}
    none = [np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(0), np.zeros(0, np.int64), np.zeros(0)]
    u, v, n, keys, wanted = merged.pop(RARE_WORD, none)
    words, _, word_counts, group = _grouped(u, v, n, wanted)
    found = [(keys, n[:, None] * -np.log1p(word_counts)[group])]
    far = (np.zeros(0, np.int64), np.zeros((0, 2)), np.zeros(0, np.int64), np.zeros(0, np.int64))
    for kind, (u, v, n, keys, wanted) in merged.items():
        first, second, pair, group = _grouped(u, v, n, wanted)
        frequent = known.words.values
        if kind == BOTH_FREQUENT:
            terms = known.pair_terms(pair, frequent[(first >> np.uint64(32)).astype(np.int64)], frequent[(first & np.uint64(0xFFFFFFFF)).astype(np.int64)])
        else:
            own = word_counts[np.searchsorted(words, first)]
            if kind == BOTH_RARE:
                part = (pair / np.maximum(own, 1.0))[group]
                far = (keys, part, v.view(np.int64), n.astype(np.int64))
                continue
            other = frequent[second.astype(np.int64)]
            terms = known.pair_terms(pair, *((own, other) if kind == RARE_HEAD else (other, own)))
        found.append((keys, n[:, None] * terms[group]))
    keys, values = (np.concatenate(c) for c in zip(*found, strict=True))
    return keys, values, far


def score_corpus(
    docs: DataFrame, wanted: DataFrame, word_share: float = WORD_SHARE, pair_share: float = PAIR_SHARE, weight: float = WEIGHT, bucket: int = BUCKET
) -> DataFrame:
    """(doc_id, n_tokens, target_loss, background_loss, score) per row: what ``score_documents`` gives
    for ``docs`` with the models of ``docs`` and ``wanted``. The shares say only what is broadcast,
    1 / word_share words and 1 / pair_share pairs at most.

    NULL and empty texts have no tokens and NULL losses. With no wanted document the target
    model is uniform. Rows that repeat are counted and scored each. Other columns are not
    looked at; an empty table gives no rows. A long text is taken whole.
    """
    spark = docs.sparkSession
    marks = wanted.select(F.col("doc_id").cast("long").alias("doc_id"), F.lit(True).alias("wanted")).distinct()
    marks = settled(marks, "marks")
    few = marks.count() <= BROADCAST_IDS
    given = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    given = given.join(F.broadcast(marks) if few else marks, "doc_id", "left").select(
        "doc_id", "text", F.coalesce("wanted", F.lit(False)).alias("wanted"), F.xxhash64("doc_id", "text").alias("key")
    )
    given = given if few else settled(given, "marked", compression="zstd")
    sums = [F.sum(s).alias(s) for s in SIDES]

    pair = "gram long, head long, tail long, n long"
    some = given.where(F.pmod("key", F.lit(SAMPLE)) == 0).select("text").mapInArrow(_sample_batches, pair)
    some = settled(some.groupBy("gram", "head", "tail").agg(F.sum("n").alias("n")), "sampled", compression="zstd")
    least = max(3.0, pair_share * (some.agg(F.sum("n")).first()[0] or 0))
    likely = some.where(F.col("n") >= least).select("gram", "head", "tail").toPandas()
    listed = spark.sparkContext.broadcast(np.sort(likely["gram"].to_numpy(np.int64).view(np.uint64)))
    counted = "kind int, gram long, target long, background long"
    counts = given.select("text", "wanted").mapInArrow(lambda it: _frequency_batches(it, listed), counted).groupBy("kind", "gram").agg(*sums)
    counts = settled(counts, "counts", compression="zstd")
    words = counts.where("kind = 0")
    row = words.agg(*sums, F.count("*").alias("n")).first()
    tokens = np.array([float(row[s] or 0) for s in SIDES])
    totals = tokens + row["n"] + 1
    often = Hot.of(words.where(F.col("background") >= word_share * tokens[1]))
    known = Frequent(often, Hot(np.zeros(0, np.uint64), np.zeros((0, 2))), totals, weight)
    known.pairs = _frequent_pairs(likely, Hot.of(counts.where("kind = 1")), known)
    sent = spark.sparkContext.broadcast(known)

    held = given.mapInArrow(
        lambda it: _held_batches(it, sent), "doc_id long, key long, n_tokens long, held_target double, held_background double"
    )
    buckets = int(tokens[1] // bucket) + GROUPS
    groups = max(GROUPS, -(-buckets // TOGETHER))
    entries = given.mapInArrow(lambda it: _entry_batches(it, sent, buckets), _ENTRY)
    handed = entries.groupBy(F.pmod("bucket", F.lit(groups)).alias("group")).applyInArrow(
        lambda table: _settle_group(table, sent), "key long, target double, background double, tail long, n long"
    )
    handed = settled(handed, "handed", compression="zstd")
    near = handed.where("tail IS NULL").select("key", *SIDES)
    tails = words.select(F.col("gram").alias("tail"), *[F.col(s).alias(f"tail_{s}") for s in SIDES])

    def term(k: int, side: str) -> Column:
        chance = (F.col(f"tail_{side}") + 1) / F.lit(totals[k])
        return -F.log1p(F.lit(weight / (1 - weight)) * F.col(side) / chance) * F.col("n")

    far = handed.where("tail IS NOT NULL").join(tails, "tail").select("key", *[term(k, s).alias(s) for k, s in enumerate(SIDES)])
    others = near.unionByName(far).groupBy("key").agg(*sums)
    # Equal rows have one key: each gets its part of what all of them found.
    equal = given.groupBy("key").agg(F.count("*").alias("equal")).where("equal > 1")
    joined = held.join(equal, "key", "left").join(others, "key", "left")
    loss = {
        s: (F.col(f"held_{s}") + F.coalesce(F.col(s) / F.coalesce("equal", F.lit(1)), F.lit(0.0))) / F.col("n_tokens") for s in SIDES
    }
    loss = {s: F.when(F.col("n_tokens") > 0, x) for s, x in loss.items()}
    scored = joined.select("doc_id", "n_tokens", *[x.alias(f"{s}_loss") for s, x in loss.items()])
    return scored.withColumn("score", F.col("target_loss") - F.col("background_loss"))
