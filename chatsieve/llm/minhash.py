"""Near-duplicate documents by ProbMinHash over weighted word shingles.

A document is its five-word runs; a run that occurs c times weighs 1 + ln(c), and a text
of one to four words is one shingle. The signature estimates the probability Jaccard
index of two weightings, which is the plain Jaccard index where no shingle repeats.

Signature: every shingle is a Poisson process whose rate is its weight. Arrivals go to
uniformly drawn registers, each register keeps the shingle that arrived first, and the
processes of a document stop once they are later than its slowest register. Two
documents agree in a register with a probability equal to that index. Bands of
registers propose pairs, and every proposed pair is verified on the whole texts: the
Jaccard index of their distinct shingles must reach the threshold.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatsieve.llm.components import components
from chatsieve.llm.hashing import mix, ngram_hashes, text_chunks, word_hashes, words_of
from chatsieve.llm.tables import settled, texts_of

SHINGLE, SIMILARITY, BANDS, ROWS = 5, 0.8, 32, 4
#: Words of 64 bits in which the shingles of a text leave marks.
MARKS = 16
_LOW = np.uint64((1 << 44) - 1)


def weighted(shingles: np.ndarray, per_row: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, 44-bit shingle, count) of the distinct shingles of every row."""
    keys = (np.repeat(np.arange(len(per_row), dtype=np.uint64), per_row) << np.uint64(44)) | (shingles >> np.uint64(20))
    keys.sort()
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.zeros(0, np.int64)
    counts = np.diff(np.append(first, len(keys)))
    return (keys[first] >> np.uint64(44)).astype(np.int64), keys[first] & _LOW, counts


def prob_minhash(row: np.ndarray, shingle: np.ndarray, weight: np.ndarray, rows: int, registers: int) -> np.ndarray:
    """rows x registers: the shingle that reached each register first (0 in a row without any)."""
    first = np.full(rows * registers, np.inf)
    winner = np.zeros(rows * registers, dtype=np.uint64)
    latest = np.full(rows, np.inf)
    time, seed = np.zeros(len(row)), mix(shingle + np.uint64(1))
    while len(row):
        seed = mix(seed + np.uint64(0x9E3779B97F4A7C15))
        time = time - np.log(((seed >> np.uint64(12)) + np.uint64(1)) * 2.0**-52) / weight
        alive = time < latest[row]
        row, shingle, weight, time, seed = row[alive], shingle[alive], weight[alive], time[alive], seed[alive]
        slot = row * registers + (mix(seed ^ np.uint64(0xA5A5)) % np.uint64(registers)).astype(np.int64)
        np.minimum.at(first, slot, time)
        won = time == first[slot]
        winner[slot[won]] = shingle[won]
        live = np.unique(row)
        latest[live] = first.reshape(rows, registers)[live].max(axis=1)
    return winner.reshape(rows, registers)


def band_keys(registers: np.ndarray, bands: int) -> np.ndarray:
    """rows x bands: one hash for the registers of each band."""
    parts = registers.reshape(len(registers), bands, -1)
    key = np.broadcast_to(mix(np.arange(bands, dtype=np.uint64)), parts.shape[:2])
    for k in range(parts.shape[2]):
        key = mix(key ^ parts[:, :, k])
    return key.view(np.int64)


def _shingles(data, offsets, n):
    starts, ends, counts = words_of(data, offsets)
    return ngram_hashes(word_hashes(data, starts, ends), counts, n, whole=True)


def _signature_batches(batches: Iterator[pa.RecordBatch], shingle: int, bands: int, rows: int):
    for batch in batches:
        for start, data, offsets in text_chunks(batch.column("text")):
            n = len(offsets) - 1
            hashes, per_row = _shingles(data, offsets, shingle)
            row, ids, counts = weighted(hashes, per_row)
            keys = band_keys(prob_minhash(row, ids, 1 + np.log(counts), n, bands * rows), bands)
            sizes = np.where(per_row > 0, bands, 0)
            lists = pa.ListArray.from_arrays(
                pa.array(np.append(0, np.cumsum(sizes)), pa.int32()), pa.array(keys[per_row > 0].ravel())
            )
            part = batch.slice(start, n)
            distinct = pa.array(np.bincount(row, minlength=n), pa.int64())
            marks = np.zeros((n, MARKS), np.uint64)
            np.bitwise_or.at(marks, (row, ids.astype(np.int64) % MARKS), np.uint64(1) << (ids >> np.uint64(8)) % np.uint64(64))
            marks = pa.FixedSizeListArray.from_arrays(pa.array(marks.view(np.int64).ravel()), MARKS).cast(pa.list_(pa.int64()))
            names = ["doc_id", "digest", "bands", "n_shingles", "marks"]
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("digest"), lists, distinct, marks], names)


def signatures(docs: DataFrame, shingle: int = SHINGLE, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """(doc_id, digest, bands, n_shingles, marks) per row, where a shingle sets one of the bits of marks; no bands for a text without words."""
    given = texts_of(docs).select("doc_id", "text", F.md5("text").alias("digest"))
    return given.mapInArrow(
        lambda it: _signature_batches(it, shingle, bands, rows), "doc_id long, digest string, bands array<long>, n_shingles long, marks array<long>"
    )


def jaccard(a: np.ndarray, b: np.ndarray) -> float:
    """Exact likeness of two arrays of shingle hashes; 0 where neither has any."""
    a, b = np.unique(a), np.unique(b)
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / max(1, len(a) + len(b) - both)


def _verified(batches: Iterator[pa.RecordBatch], shingle: int):
    for batch in batches:
        row = 0
        sizes = [pc.binary_length(batch.column(c)).to_numpy(zero_copy_only=False) for c in ("text_a", "text_b")]
        total = np.cumsum(sizes[0] + sizes[1])
        out = []
        while row < len(batch):
            done = total[row - 1] if row else 0
            stop = max(row + 1, int(np.searchsorted(total, done + (4 << 20), side="right")))
            sides = []
            for c in ("text_a", "text_b"):
                (_, data, offsets), = text_chunks(batch.column(c).slice(row, stop - row), limit=1 << 62)
                hashes, per_row = _shingles(data, offsets, shingle)
                sides.append(np.split(hashes, np.cumsum(per_row)[:-1]))
            out += [jaccard(a, b) for a, b in zip(*sides, strict=True)]
            row = stop
        yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(out, pa.float64())], ["a", "b", "likeness"])


def verified_links(pairs: DataFrame, texts: DataFrame, shingle: int, similarity: float) -> DataFrame:
    """Pairs (a, b) whose whole texts are alike. Equi joins only, so that large parts
    can be split; a hot centre's text meets each partner in its own row."""
    left = texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b"))
    return (
        pairs.join(right, "b").join(left, "a").select("a", "b", "text_a", "text_b")
        .mapInArrow(lambda it: _verified(it, shingle), "a long, b long, likeness double")
        .where(F.col("likeness") >= similarity - 1e-9)
    )


def near_duplicates(
    docs: DataFrame, similarity: float = SIMILARITY, shingle: int = SHINGLE, bands: int = BANDS, rows: int = ROWS
) -> DataFrame:
    """(doc_id, class_id, kept): the class of every document, named by its smallest id.

    Equal texts meet by digest first; below, one document stands for its copies. In a
    bucket (documents that agree in a band) every member is verified against one centre:
    the member that shares most buckets with others, which in a family of edited copies
    is the text they were made from. Classes are the components of the verified links.
    Then every bucket that still holds more than one class verifies all members outside
    the class of a new centre against it (the best-connected member of the classes that
    had no centre there), until a round finds no link. Last, buckets of any size that still hold
    several classes verify every pair of two classes that was not yet and whose marks allow
    the likeness, so that nothing a bucket proposes is missed. Only there, in
    families of edited copies none of which is like the centres, pairs grow with the
    square of a bucket.

    NULL and empty texts and texts of white space alone are each a class of their own.
    Repeated rows of one id share a class. A NULL id gives one row with a NULL class.
    Other columns of ``docs`` are not looked at. An empty table gives no rows.
    """
    signed = settled(signatures(docs, shingle, bands, rows), "signatures")
    known = signed.where("doc_id IS NOT NULL AND size(bands) > 0")
    groups = settled(known.groupBy("digest").agg(F.min("doc_id").alias("rep")), "copies")
    reps = known.join(groups.select(F.col("rep").alias("doc_id")), "doc_id", "left_semi")
    member = reps.select(F.col("doc_id").alias("rep"), F.explode(F.array_distinct("bands")).alias("bucket"))
    shared = member.groupBy("bucket").agg(F.count_distinct("rep").alias("n")).where("n > 1")
    shared = member.distinct().join(shared, "bucket")
    shared = settled(shared, "buckets")
    standing = shared.groupBy("rep").agg(F.sum("n").alias("standing"))
    state = settled(
        shared.join(standing, "rep").select("bucket", "rep", "standing", F.col("rep").alias("class_id"), F.lit(False).alias("seen")),
        "state",
    )
    candidates = shared.select(F.col("rep").alias("doc_id")).distinct()
    texts = texts_of(docs).join(candidates, "doc_id", "left_semi")
    texts, links, tried_pairs = settled(texts, "texts"), None, None
    while True:
        centre = state.where("NOT seen").groupBy("bucket").agg(
            F.max(F.struct("standing", (-F.col("rep")).alias("order"), "class_id")).alias("c")
        )
        centre = centre.select("bucket", (-F.col("c.order")).alias("centre"), F.col("c.class_id").alias("centre_class"))
        met = state.join(centre, "bucket").where("class_id != centre_class")
        pairs = settled(met.select(F.least("centre", "rep").alias("a"), F.greatest("centre", "rep").alias("b")).distinct(), "pairs")
        tried_pairs = pairs if tried_pairs is None else tried_pairs.union(pairs)
        found = settled(verified_links(pairs, texts, shingle, similarity).select("a", "b"), "links")
        if found.isEmpty():
            break
        links = found if links is None else links.union(found)
        classes = settled(components(links), "classes")
        tried = centre.select("bucket", F.col("centre").alias("rep"))
        now = classes.select(F.col("node").alias("rep"), F.col("class_id").alias("now"))
        fresh = state.select("bucket", "rep", "standing", "class_id", "seen").join(now, "rep", "left")
        fresh = fresh.withColumn("class_id", F.coalesce("now", "class_id")).drop("now")
        done = fresh.join(tried, ["bucket", "rep"], "left_semi").select("bucket", "class_id").union(
            fresh.where("seen").select("bucket", "class_id")
        ).distinct()
        fresh = fresh.drop("seen").join(done.withColumn("seen", F.lit(True)), ["bucket", "class_id"], "left")
        mixed = fresh.groupBy("bucket").agg(F.min("class_id").alias("lo"), F.max("class_id").alias("hi")).where("lo != hi")
        fresh = fresh.join(mixed.select("bucket"), "bucket", "left_semi")
        state = settled(fresh.select("bucket", "rep", "standing", "class_id", F.coalesce("seen", F.lit(False)).alias("seen")), "state")
    several = state.groupBy("bucket").agg(F.min("class_id").alias("lo"), F.max("class_id").alias("hi")).where("lo != hi")
    # An id that repeats with other texts has no marks, and all its pairs are verified.
    marks = F.when(F.min("digest") == F.max("digest"), F.first("marks")).alias("marks")
    sizes = reps.groupBy(F.col("doc_id").alias("rep")).agg(F.max("n_shingles").alias("size"), marks)
    several = state.join(several.select("bucket"), "bucket", "left_semi").join(sizes, "rep")
    one, two = (
        several.select("bucket", F.col("rep").alias(x), *[F.col(c).alias(f"{c}_{x}") for c in ("class_id", "size", "marks")]) for x in "ab"
    )
    # Marks that differ are shingles that differ. Two alike texts differ in few of theirs; marks hold
    # shorter hashes than those that decide, hence the slack.
    differ = sum((F.bit_count(F.get("marks_a", F.lit(k)).bitwiseXOR(F.get("marks_b", F.lit(k)))) for k in range(MARKS)), F.lit(0))
    most = (1.01 - similarity) / (1 + similarity) * (F.col("size_a") + F.col("size_b"))
    fits = F.coalesce(differ <= most, F.lit(True))
    pairs = one.join(two, "bucket").where("a < b AND class_id_a != class_id_b").where(fits).select("a", "b").distinct()
    pairs = pairs.join(tried_pairs, ["a", "b"], "left_anti")
    found = settled(verified_links(settled(pairs, "pairs"), texts, shingle, similarity).select("a", "b"), "links")
    if not found.isEmpty():
        links = found if links is None else links.union(found)
        classes = settled(components(links), "classes")
    if links is not None:
        now = classes.select(F.col("node").alias("rep"), F.col("class_id").alias("now"))
        groups = groups.join(now, "rep", "left").select("digest", F.coalesce("now", "rep").alias("class_id"))
    else:
        groups = groups.select("digest", F.col("rep").alias("class_id"))
    worded = F.when(F.size("bands") > 0, F.col("digest"))
    named = signed.select("doc_id", worded.alias("digest")).distinct().join(groups, "digest", "left")
    named = named.select("doc_id", F.coalesce("class_id", "doc_id").alias("class_id"))
    named = named.groupBy("doc_id").agg(F.min("class_id").alias("class_id"))
    return named.select("doc_id", "class_id", F.coalesce(F.col("doc_id") == F.col("class_id"), F.lit(True)).alias("kept"))
