"""Documents scored by cross-entropy difference of two matched bigram models.

The background model counts all documents, the target model those marked as wanted.
Both share all words and all pairs of the background, interpolate pairs with single
words, and smooth single words by one; a document's score is its mean loss per token
under the target model less that under the background model, so that lower is more
like the target.

A token's loss is that of a word never seen plus a term of its word and, after another
word, one of the pair. Terms are a Spark table of any size. Those of words and pairs
that hold a share of all tokens are sent to all tasks: a share of 1/k is held by k keys
at most. All others meet the distinct words and pairs of a document in an equi join,
where the share bounds the rows of a key.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chatsieve.llm.hashing import CHUNK_BYTES, mix, text_chunks, word_hashes, words_of
from chatsieve.llm.tables import settled

#: Shares of all tokens from which the term of a word or a pair is broadcast.
WORD_SHARE, PAIR_SHARE = 1e-6, 5e-7
WEIGHT, FLUSH, ROWS = 0.7, 2_000_000, 1 << 17
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
SIDES = ("target", "background")


def _tokens(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, word hashes, words per row) of the texts with A-Z in lower case."""
    for first, data, offsets in text_chunks(column, limit):
        data = _LOWER[data]
        starts, ends, counts = words_of(data, offsets)
        yield first, word_hashes(data, starts, ends), counts


def _pair(head: np.ndarray, tail: np.ndarray) -> np.ndarray:
    return mix(head * np.uint64(0xD6E8FEB86659FD93) + mix(tail))


def _pairs_of(words: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(pair key ending at each word but the first of a row, mask of those words)."""
    inner = np.ones(len(words), bool)
    inner[(np.cumsum(counts) - counts)[counts > 0]] = False
    at = np.flatnonzero(inner)
    return _pair(words[at - 1], words[at]), inner


def _combined(parts: list[list[np.ndarray]], names: list[str]) -> Iterator[pa.RecordBatch]:
    columns = [np.concatenate(c) for c in zip(*parts)]
    found, first, slot = np.unique(columns[0], return_index=True, return_inverse=True)
    out = [c[first].view(np.int64) for c in columns[1:-2]]
    out += [np.bincount(slot, c, len(found)).astype(np.int64) for c in columns[-2:]]
    batch = pa.RecordBatch.from_arrays([pa.array(c) for c in out], names)
    for k in range(0, len(found), ROWS):
        yield batch.slice(k, ROWS)


def _count_batches(batches: Iterator[pa.RecordBatch], paired: bool):
    """Counts of words or of pairs, combined in the task before they are shuffled and
    handed on once they fill ``FLUSH`` rows."""
    names = [*(("head", "tail") if paired else ("gram",)), *SIDES]
    parts, held = [], 0
    for batch in batches:
        wanted = batch.column("wanted").to_numpy(zero_copy_only=False)
        for first, words, counts in _tokens(batch.column("text")):
            target = np.repeat(wanted[first : first + len(counts)], counts).astype(float)
            keys, given = words, [words]
            if paired:
                keys, inner = _pairs_of(words, counts)
                at = np.flatnonzero(inner)
                given, target = [words[at - 1], words[at]], target[at]
            found, index, slot = np.unique(keys, return_index=True, return_inverse=True)
            sums = [np.bincount(slot, target, len(found)), np.bincount(slot, minlength=len(found)).astype(float)]
            parts.append([found, *[c[index] for c in given], *sums])
            held += len(found)
            if held > FLUSH:
                yield from _combined(parts, names)
                parts, held = [], 0
    if parts:
        yield from _combined(parts, names)


@dataclass
class Hot:
    """Rows of two numbers by sorted key, held by every task."""

    grams: np.ndarray
    values: np.ndarray

    @classmethod
    def of(cls, rows: DataFrame) -> Hot:
        table = rows.select("gram", *SIDES).toPandas()
        grams = table["gram"].to_numpy(np.int64).view(np.uint64)
        order = np.argsort(grams)
        return cls(grams[order], table[list(SIDES)].to_numpy(float)[order])

    def look(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(values of each key, zero where it is not held; whether it is held)."""
        if not len(self.grams):
            return np.zeros((len(keys), 2)), np.zeros(len(keys), bool)
        at = np.minimum(np.searchsorted(self.grams, keys), len(self.grams) - 1)
        held = self.grams[at] == keys
        return np.where(held[:, None], self.values[at], 0.0), held


def _mark_batches(batches: Iterator[pa.RecordBatch], sent):
    """Pairs with their key and the counts of those of their words that are held."""
    for batch in batches:
        words = [batch.column(c).to_numpy().view(np.uint64) for c in ("head", "tail")]
        columns = {c: batch.column(c) for c in ("head", "tail", *SIDES)}
        columns["gram"] = pa.array(_pair(*words).view(np.int64))
        for name, keys in zip(("head", "tail"), words):
            counts, held = sent.value.look(keys)
            for k, side in enumerate(SIDES):
                columns[f"{name}_{side}"] = pa.array(counts[:, k].astype(np.int64), mask=~held)
        yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))


def _with_counts(pairs: DataFrame, words: DataFrame, name: str) -> DataFrame:
    """The counts of all heads (or tails). Only words that no task holds are joined, so
    that none has many rows."""
    counts = words.select(F.col("gram").alias(name), *[F.col(s).alias(f"{name}_{s}") for s in SIDES])
    missing = F.col(f"{name}_background").isNull()
    rest = pairs.where(missing).drop(*[f"{name}_{s}" for s in SIDES]).join(counts, name)
    return pairs.where(~missing).unionByName(rest)


@dataclass
class MatchedModels:
    """The loss of a word never seen and of a step without a listed pair, under the target
    and the background model, and the terms that words and pairs add to it."""

    unseen: np.ndarray
    backoff: float
    hot_words: Hot
    hot_pairs: Hot
    terms: DataFrame  # (gram, target, background) of all others


def fit_matched_models(
    docs: DataFrame, wanted: DataFrame, word_share: float = WORD_SHARE, pair_share: float = PAIR_SHARE, weight: float = WEIGHT
) -> MatchedModels:
    """Models from all ``docs`` and those whose id is in ``wanted``. The shares say only
    which terms are broadcast, not which count: the driver gets at most 1 / word_share
    words and 1 / pair_share pairs."""
    spark = docs.sparkSession
    marks = wanted.select(F.col("doc_id").cast("long").alias("doc_id")).distinct()
    marked = marks.select("doc_id", F.lit(True).alias("wanted"))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    texts = texts.join(marked, "doc_id", "left").select("text", F.coalesce("wanted", F.lit(False)).alias("wanted"))
    sums = [F.sum(s).alias(s) for s in SIDES]
    words = texts.mapInArrow(lambda it: _count_batches(it, False), "gram long, target long, background long")
    words = settled(words.groupBy("gram").agg(*sums), "words")
    pairs = texts.mapInArrow(lambda it: _count_batches(it, True), "head long, tail long, target long, background long")
    pairs = settled(pairs.groupBy("head", "tail").agg(*sums), "pairs")
    row = words.agg(*sums, F.count("*").alias("n")).first()
    tokens = {s: row[s] or 0 for s in SIDES}
    size = row["n"] + 1
    often = lambda share: F.col("background") >= share * tokens["background"]

    sent = spark.sparkContext.broadcast(Hot.of(words.where(often(word_share))))

    def pair_terms(chosen: DataFrame) -> DataFrame:
        marks = ", ".join(f"{c} long" for c in ("head", "tail", *SIDES, "gram", *[f"{n}_{s}" for n in ("head", "tail") for s in SIDES]))
        rows = chosen.mapInArrow(lambda it: _mark_batches(it, sent), marks)
        rows = _with_counts(_with_counts(rows, words, "head"), words, "tail")

        def term(side: str) -> Column:
            share = F.col(side) / F.greatest(F.col(f"head_{side}"), F.lit(1))
            chance = (F.col(f"tail_{side}") + 1) / F.lit(float(tokens[side] + size))
            return -F.log1p(F.lit(weight / (1 - weight)) * share / chance)

        return rows.select("gram", *[term(s).alias(s) for s in SIDES])

    word_terms = lambda chosen: chosen.select("gram", *[(-F.log1p(s)).alias(s) for s in SIDES])
    return MatchedModels(
        np.log([float(tokens[s] + size) for s in SIDES]),
        -float(np.log(1 - weight)),
        Hot.of(word_terms(words.where(often(word_share)))),
        Hot.of(pair_terms(pairs.where(often(pair_share)))),
        word_terms(words.where(~often(word_share))).unionByName(pair_terms(pairs.where(~often(pair_share)))),
    )


def _held_batches(batches: Iterator[pa.RecordBatch], sent):
    """Tokens and losses of every row, as far as the broadcast terms go."""
    unseen, backoff, hot_words, hot_pairs = sent.value
    for batch in batches:
        sums, sizes = [np.zeros((0, 2))], [np.zeros(0, np.int64)]
        for _, words, counts in _tokens(batch.column("text")):
            loss = unseen + hot_words.look(words)[0]
            keys, inner = _pairs_of(words, counts)
            loss[inner] += backoff + hot_pairs.look(keys)[0]
            total = np.vstack([np.zeros(2), np.cumsum(loss, axis=0)])
            stops = np.cumsum(counts)
            sums.append(total[stops] - total[stops - counts])
            sizes.append(counts)
        both, size = np.vstack(sums), np.concatenate(sizes)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("key"), pa.array(size.astype(np.int64)), pa.array(both[:, 0]), pa.array(both[:, 1])],
            ["doc_id", "key", "n_tokens", "held_target", "held_background"],
        )


def _other_batches(batches: Iterator[pa.RecordBatch], sent):
    """(row key, word or pair, occurrences) of what is not among the broadcast terms."""
    _, _, hot_words, hot_pairs = sent.value
    for batch in batches:
        row_keys = batch.column("key").to_numpy()
        for first, words, counts in _tokens(batch.column("text")):
            row = np.repeat(np.arange(first, first + len(counts)), counts)
            pairs, inner = _pairs_of(words, counts)
            rare, rare_pair = ~hot_words.look(words)[1], ~hot_pairs.look(pairs)[1]
            grams = np.concatenate([words[rare], pairs[rare_pair]])
            rows = np.concatenate([row[rare], row[inner][rare_pair]])
            order = np.lexsort((grams, rows))
            grams, rows = grams[order], rows[order]
            new = np.ones(len(grams), bool)
            new[1:] = (grams[1:] != grams[:-1]) | (rows[1:] != rows[:-1])
            at = np.flatnonzero(new)
            n = np.diff(np.append(at, len(grams)))
            out = [row_keys[rows[at]], grams[at].view(np.int64), n.astype(np.int64)]
            out = pa.RecordBatch.from_arrays([pa.array(c) for c in out], ["key", "gram", "n"])
            for k in range(0, len(at), ROWS):
                yield out.slice(k, ROWS)


def score_documents(docs: DataFrame, models: MatchedModels) -> DataFrame:
    """(doc_id, n_tokens, target_loss, background_loss, score) per row, in nats per token.

    Words are runs of characters other than ASCII white space, A-Z in lower case. NULL and
    empty texts have no tokens and NULL losses. With no wanted document the target model
    is uniform. Other columns are not looked at; an empty table gives no rows.
    """
    sent = docs.sparkSession.sparkContext.broadcast((models.unseen, models.backoff, models.hot_words, models.hot_pairs))
    given = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    given = given.withColumn("key", F.xxhash64("doc_id", "text"))
    held = given.mapInArrow(
        lambda it: _held_batches(it, sent), "doc_id long, key long, n_tokens long, held_target double, held_background double"
    )
    others = given.mapInArrow(lambda it: _other_batches(it, sent), "key long, gram long, n long").join(models.terms, "gram")
    others = others.groupBy("key").agg(*[F.sum(F.col("n") * F.col(s)).alias(s) for s in SIDES])
    # Equal rows have one key: each gets its part of what all of them found.
    equal = held.withColumn("equal", F.count("*").over(Window.partitionBy("key"))).join(others, "key", "left")
    loss = {s: (F.col(f"held_{s}") + F.coalesce(F.col(s) / F.col("equal"), F.lit(0.0))) / F.col("n_tokens") for s in SIDES}
    loss = {s: F.when(F.col("n_tokens") > 0, x) for s, x in loss.items()}
    scored = equal.select("doc_id", "n_tokens", *[x.alias(f"{s}_loss") for s, x in loss.items()])
    return scored.withColumn("score", F.col("target_loss") - F.col("background_loss"))
