"""Homomorphic fingerprints of documents as multisets of paragraphs.

Every paragraph (a line, cut at the ends of its sentences) hashes to a vector of 256
lanes of +1 or -1; a fingerprint is the sum of its paragraphs' vectors, each lane modulo
2**32, which no number of paragraphs in a text reaches. Order does not matter, equal multisets have equal fingerprints, and a paragraph is
inserted or deleted by adding or subtracting its vector. The difference of two
fingerprints is the fingerprint of the paragraphs they do not share, and the square of
its length estimates how many those are.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chatsieve.llm.tables import texts_of

LANES, ACCURACY, AT_ONCE = 256, 10_000, 1 << 15
_CUT = re.compile(r"\n+|(?<=[.!?]) +")


def fingerprint(text: str) -> np.ndarray:
    """Sum of the paragraphs' vectors, as 32-bit lanes; zero for a text without any. Vectors of
    ``AT_ONCE`` paragraphs are held at a time."""
    total = np.zeros(LANES, np.int64)
    paragraphs = [p for p in _CUT.split(text) if p]
    for start in range(0, len(paragraphs), AT_ONCE):
        some = paragraphs[start : start + AT_ONCE]
        digests = b"".join(hashlib.blake2b(p.encode(), digest_size=LANES // 8).digest() for p in some)
        ones = np.unpackbits(np.frombuffer(digests, np.uint8).reshape(-1, LANES // 8), axis=1)
        total += 2 * ones.sum(axis=0, dtype=np.int64) - len(ones)
    return total.astype(np.int32)


def insert(whole: np.ndarray, text: str) -> np.ndarray:
    """Fingerprint after the paragraphs of ``text`` are added."""
    return whole + fingerprint(text)


def delete(whole: np.ndarray, text: str) -> np.ndarray:
    """Fingerprint after the paragraphs of ``text`` are taken away."""
    return whole - fingerprint(text)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """1 for equal multisets, about 0 for multisets that share no paragraph: one minus the
    estimated paragraphs not shared over those of both."""
    x, y = a.astype(float), b.astype(float)
    size = x @ x + y @ y
    gap = x - y
    return float(np.clip(1 - (gap @ gap) / size, 0, 1)) if size else 1.0


def encoded(lanes: np.ndarray) -> str:
    """Two bytes a lane where all fit, as nearly always, else four."""
    narrow = np.abs(lanes).max(initial=0) < 1 << 15
    return base64.b64encode(lanes.astype("<i2" if narrow else "<i4").tobytes()).decode()


def decoded(text: str) -> np.ndarray:
    data = base64.b64decode(text)
    return np.frombuffer(data, "<i2" if len(data) == 2 * LANES else "<i4").astype(np.int32)


def _fingerprint_batches(batches: Iterator[pa.RecordBatch]):
    for batch in batches:
        out = [encoded(fingerprint(t)) for t in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(out, pa.string())], ["doc_id", "fingerprint"])


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, fingerprint) per row, row by row; NULL and empty texts have the zero vector."""
    return texts_of(docs).mapInArrow(_fingerprint_batches, "doc_id long, fingerprint string")


def _stair(value: Column, bounds: list[int], lo: int, hi: int) -> Column:
    """Number of bounds above ``value``, by a balanced tree of comparisons."""
    if lo == hi:
        return F.lit(lo)
    mid = (lo + hi) // 2
    return F.when(value < bounds[mid], _stair(value, bounds, mid + 1, hi)).otherwise(_stair(value, bounds, lo, mid))


def _edit_batches(batches: Iterator[pa.RecordBatch]):
    """Rows come sorted by part and then by descending id; the row that opens the next part
    closes each part as its marked tail."""
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
    held = None
    for batch in batches:
        out = []
        columns = [batch.column(c).to_pylist() for c in ("part", "tail", "doc_id", "text")]
        for part, tail, doc_id, text in zip(*columns, strict=True):
            mine = fingerprint(text)
            if held is not None and held[0] == part and not held[4]:
                _, before, old, own, _ = held
                half = len(old) // 2
                changed = old[: len(old) - half] + text[:half]
                edited = fingerprint(changed)
                out.append(
                    (
                        before, len(old), hashlib.sha256(changed.encode()).hexdigest(), encoded(own), encoded(edited),
                        likeness(own, edited), likeness(own, mine),
                    )
                )
            held = (part, doc_id, text, mine, tail)
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(list(x), t) for x, t in zip(zip(*out, strict=True), types, strict=True)], names)


def edited_fingerprints(docs: DataFrame, parts: int | None = None) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next)
    per row: each text against itself with the second half taken from the next document by
    descending id (after the last, the first).

    Rows are dealt to ranges of ids and sorted there, so that all but one neighbour is in
    the same task; the first row of each range also goes to the range before it. The
    driver sees one id per range. Rows that share an id follow each other by text; a NULL
    id comes last. NULL and empty texts have no characters; one row alone is its own next.
    A text and the one before it are held whole. Other columns are not looked at, and an empty table gives no rows.
    """
    spark = docs.sparkSession
    given = texts_of(docs)
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    key = F.coalesce(F.col("doc_id"), F.lit(-(1 << 63)))
    shares = [k / parts for k in range(1, parts)] or [0.5]
    cuts = given.agg(F.percentile_approx("doc_id", shares, ACCURACY)).first()[0]
    bounds = sorted(set(cuts or []), reverse=True)
    part = _stair(key, bounds, 0, len(bounds))
    heads = given.select(part.alias("part"), key.alias("key")).groupBy("part").agg(F.max("key").alias("head")).collect()
    heads = sorted((r.part, r["head"]) for r in heads)
    before = {head: heads[k - 1][0] for k, (_, head) in enumerate(heads)}
    tails = F.coalesce(*[F.when(key == head, F.lit(p)) for head, p in before.items()]) if before else F.lit(None).cast("int")
    rows = given.select("doc_id", "text", F.explode(F.array(F.struct(part.alias("part"), F.lit(False).alias("tail")), F.struct(tails.alias("part"), F.lit(True).alias("tail")))).alias("d"))
    rows = rows.select("d.part", "d.tail", "doc_id", "text").where("part IS NOT NULL")
    rows = rows.repartition(parts, "part").sortWithinPartitions("part", "tail", F.desc_nulls_last("doc_id"), "text")
    return rows.mapInArrow(
        _edit_batches,
        "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string,"
        " near_edited double, near_next double",
    )
