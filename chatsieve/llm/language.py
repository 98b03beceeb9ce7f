"""Language of whole texts by interpolated Kneser-Ney character models.

One model per language over runs of one to four characters. All languages share one
alphabet and one sorted array of n-gram hashes (packed symbols) per order, with a column of log
probabilities per language, so that one binary search scores an n-gram for all of
them. The language of lowest cross-entropy per character wins; a text whose best
cross-entropy is above what the training texts of that language show is rejected.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: What a letter that no training text has costs on top: it is one of a thousand.
FOREIGN = float(np.log(1000))
ORDER, DISCOUNT, ROWS_PER_LANGUAGE, SLACK, UNKNOWN = 4, 0.75, 1000, 1.5, "und"
_POINTS = 0x110000


def alphabet_of(letters: list[int]) -> np.ndarray:
    """Symbol of every code point: 0 for what is no letter, 1.. for the listed letters, the
    next number for any letter that is not listed."""
    symbols = np.zeros(_POINTS, dtype=np.uint16)
    symbols[[c for c in range(_POINTS) if chr(c).isalpha()]] = len(letters) + 1
    symbols[letters] = np.arange(1, len(letters) + 1)
    return symbols


def symbols_of(text: str, alphabet: np.ndarray) -> np.ndarray:
    """Symbols of the lower-case text with one 0 for each gap between words and at the ends."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    found = np.zeros(len(points) + 2, dtype=np.uint16)
    found[1:-1] = alphabet[points]
    keep = np.ones(len(found), dtype=bool)
    np.logical_or(found[1:], found[:-1], out=keep[1:])
    return found[keep]


def grams(symbols: np.ndarray, n: int, bits: int) -> np.ndarray:
    """Packed code of the n symbols from each position on."""
    size = max(0, len(symbols) - n + 1)
    wide = symbols.astype(np.uint32 if n * bits <= 32 else np.uint64)
    value = wide[:size].copy()
    for k in range(1, n):
        value <<= bits
        value |= wide[k : k + size]
    return value


def _letter_batches(batches: Iterator[pa.RecordBatch]):
    for batch in batches:
        found = sorted({c for t in batch.column("text").to_pylist() for c in set(t.lower()) if c.isalpha()})
        yield pa.RecordBatch.from_arrays([pa.array([ord(c) for c in found], pa.int32())], ["letter"])


def _count_batches(batches: Iterator[pa.RecordBatch], order: int, bits: int, sent):
    """Distinct n-grams of each batch: (lang, n, gram, times)."""
    alphabet = sent.value
    for batch in batches:
        texts: dict[str, list[np.ndarray]] = {}
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True):
            texts.setdefault(lang, []).append(symbols_of(text, alphabet))
        for lang, parts in texts.items():
            for n in range(1, order + 1):
                found, times = np.unique(np.concatenate([grams(p, n, bits) for p in parts]), return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(found), pa.string()), pa.array(np.full(len(found), n)), pa.array(found.astype(np.int64)), pa.array(times)],
                    ["lang", "n", "gram", "times"],
                )


@dataclass
class LanguageModel:
    """Per order: sorted gram codes with a log probability per language, and sorted context
    codes with a log back-off weight per language."""

    languages: list[str]
    alphabet: np.ndarray
    bits: int
    grams: list[np.ndarray]
    chances: list[np.ndarray]
    contexts: list[np.ndarray]
    backoff: list[np.ndarray]
    ceiling: np.ndarray  # nats per character above which a best language is rejected

    def entropy(self, symbols: np.ndarray) -> np.ndarray:
        """Nats per character under each language; the first characters, whose context is
        shorter, are scored by the lower orders."""
        order = len(self.grams)
        total = np.zeros(len(self.languages))
        for n in range(2, min(order, len(symbols) + 1)):
            total += self._look(n, grams(symbols[:n], n, self.bits))[0]
        if len(symbols) >= order:
            codes = np.sort(grams(symbols, order, self.bits))
            first = np.flatnonzero(np.append(True, codes[1:] != codes[:-1]))
            times = np.diff(np.append(first, len(codes)))
            total += times @ self._look(order, codes[first])
        foreign = np.count_nonzero(symbols > self.grams[0][-1])  # letters in no training text
        return (foreign * FOREIGN - total) / max(1, len(symbols) - 1)

    def _look(self, n: int, codes: np.ndarray) -> np.ndarray:
        """Log probability of n-grams in each language; unseen ones back off."""
        table = self.grams[n - 1]
        codes = codes.astype(table.dtype, copy=False)
        where = np.minimum(np.searchsorted(table, codes), len(table) - 1)
        known = table[where] == codes
        out = self.chances[n - 1][where]
        if n == 1:
            out[~known] = self.chances[0][-1]
        elif not known.all():
            lost = codes[~known]
            contexts = self.contexts[n - 2]
            head = lost >> self.bits
            there = np.minimum(np.searchsorted(contexts, head), len(contexts) - 1)
            weight = np.where((contexts[there] == head)[:, None], self.backoff[n - 2][there], 0.0)
            out[~known] = weight + self._look(n - 1, lost & lost.dtype.type((1 << ((n - 1) * self.bits)) - 1))
        return out


def _kneser_ney(counts: pd.DataFrame, languages: list[str], alphabet: np.ndarray, bits: int, order: int, discount: float) -> LanguageModel:
    """Interpolated Kneser-Ney tables of all languages from their n-gram counts."""
    tables, chances, contexts, backoff = [], [], [], []
    for n in range(1, order + 1):
        level = counts[counts.n == n]
        if n < order:  # below the top order a gram counts the characters that precede it
            above = counts[counts.n == n + 1]
            ways = above.assign(gram=above.gram & ((1 << (n * bits)) - 1)).groupby(["lang", "gram"]).size().rename("ways")
            level = level.join(ways, on=["lang", "gram"])
            level = level.assign(times=level.ways.fillna(1.0))  # the start of a text follows nothing
        kind = np.uint32 if n * bits <= 32 else np.uint64
        table = np.unique(level.gram.to_numpy()).astype(kind)
        context = np.unique(level.gram.to_numpy() >> bits).astype(kind)
        logs = np.zeros((len(table) + (n == 1), len(languages)))
        weights = np.zeros((len(context), len(languages)))
        for k, lang in enumerate(languages):
            own = level[level.lang == lang]
            gram, times = own.gram.to_numpy().astype(kind), own.times.to_numpy(float)
            at = np.searchsorted(context, gram >> bits) if n > 1 else np.zeros(len(gram), np.int64)
            mass = np.bincount(at, times, len(context))
            kinds = np.bincount(at, minlength=len(context))
            spare = np.where(mass > 0, discount * kinds / np.maximum(mass, 1e-9), 1.0)
            weights[:, k] = np.log(spare)
            base = np.zeros(len(table))
            base[np.searchsorted(table, gram)] = np.maximum(times - discount, 0) / mass[at]
            if n == 1:
                even = 1.0 / (len(table) + 1)
                logs[:-1, k] = np.log(base + spare[0] * even)
                logs[-1, k] = np.log(spare[0] * even)
            else:
                tail = table & table.dtype.type((1 << ((n - 1) * bits)) - 1)
                below = np.exp(chances[-1][np.searchsorted(tables[-1], tail), k])
                logs[:, k] = np.log(base + spare[np.searchsorted(context, table >> bits)] * below)
        tables.append(table)
        chances.append(logs)
        if n > 1:
            contexts.append(context)
            backoff.append(weights)
    return LanguageModel(languages, alphabet, bits, tables, chances, contexts, backoff, np.full(len(languages), np.inf))


def fit_language_model(
    labelled: DataFrame,
    rows_per_language: int = ROWS_PER_LANGUAGE,
    order: int = ORDER,
    discount: float = DISCOUNT,
    slack: float = SLACK,
) -> LanguageModel:
    """Model from (doc_id, text, lang) rows; NULL texts and languages are left out.

    The fit reads about ``rows_per_language`` whole texts of each language, drawn by a hash
    of the id: that bound is what makes the model small enough to send everywhere. The
    ceiling of a language is ``slack`` times the highest cross-entropy its own texts of
    twenty characters or more reach. Without any labelled row there is no language to find.
    """
    rows = labelled.select("doc_id", "text", "lang").where("text IS NOT NULL AND lang IS NOT NULL")
    sizes = {r.lang: r.n for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return LanguageModel([], alphabet_of([]), 6, [], [], [], [], np.zeros(0))
    languages = sorted(sizes)
    share = F.coalesce(*[F.when(F.col("lang") == x, min(1.0, rows_per_language / sizes[x])) for x in languages])
    draw = F.pmod(F.xxhash64("doc_id", F.lit("language")), F.lit(1 << 30)) / float(1 << 30)
    sample = rows.where(draw < share).select("text", "lang")
    spark = labelled.sparkSession
    found = sample.mapInArrow(_letter_batches, "letter int").distinct().orderBy("letter").collect()
    alphabet = alphabet_of([r.letter for r in found])
    bits = max(6, int(len(found) + 1).bit_length())
    coded = spark.sparkContext.broadcast(alphabet)
    counts = sample.mapInArrow(
        lambda it: _count_batches(it, order, bits, coded), "lang string, n long, gram long, times long"
    )
    counts = counts.groupBy("lang", "n", "gram").agg(F.sum("times").alias("times")).toPandas()
    model = _kneser_ney(counts, languages, alphabet, bits, order, discount)
    sent = spark.sparkContext.broadcast(model)
    checked = sample.mapInArrow(lambda it: _entropy_batches(it, sent), "lang string, entropy double, n long")
    worst = checked.where("n >= 20").groupBy("lang").agg(F.max("entropy").alias("m")).collect()
    top = {r.lang: r.m * slack for r in worst}
    model.ceiling = np.array([top.get(x, np.inf) for x in languages])
    return model


def _entropy_batches(batches: Iterator[pa.RecordBatch], sent):
    model = sent.value
    for batch in batches:
        out = []
        for text, lang in zip(batch.column("text").to_pylist(), batch.column("lang").to_pylist(), strict=True):
            points = symbols_of(text, model.alphabet)
            out.append((lang, float(model.entropy(points)[model.languages.index(lang)]), len(points)))
        langs, entropies, sizes = zip(*out, strict=True) if out else ([], [], [])
        yield pa.RecordBatch.from_arrays(
            [pa.array(langs, pa.string()), pa.array(entropies, pa.float64()), pa.array(sizes, pa.int64())], ["lang", "entropy", "n"]
        )


def _predict_batches(batches: Iterator[pa.RecordBatch], sent):
    model = sent.value
    names = ["doc_id", "lang_pred", "score", "entropy", "rejected"]
    types = [pa.int64(), pa.string(), pa.float64(), pa.float64(), pa.bool_()]
    for batch in batches:
        out = []
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
            points = symbols_of(text or "", model.alphabet)
            if not points.any() or not model.languages:
                out.append((doc_id, UNKNOWN, 0.0, None, not points.any()))
                continue
            entropy = model.entropy(points)
            best = int(entropy.argmin())
            odds = np.exp((entropy[best] - entropy) * min(len(points), 50))
            out.append((doc_id, model.languages[best], float(1 / odds.sum()), float(entropy[best]), bool(len(points) >= 20 and entropy[best] > model.ceiling[best])))
        columns = zip(*out, strict=True) if out else [[]] * 5
        yield pa.RecordBatch.from_arrays([pa.array(list(x), t) for x, t in zip(columns, types, strict=True)], names)


def identify(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """(doc_id, lang_pred, score, entropy, rejected) per row, from the text alone.

    ``score`` is the posterior of the language for up to 50 characters of evidence at the
    text's rate. NULL texts and texts without a letter are ``und`` with score 0, rejected,
    with no entropy. Texts of fewer than twenty characters are never rejected otherwise.
    Ties go to the language that sorts first. Other columns are not looked at.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)
    given = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return given.mapInArrow(
        lambda it: _predict_batches(it, sent), "doc_id long, lang_pred string, score double, entropy double, rejected boolean"
    )


def held_out(doc_id: Column | str = "doc_id") -> Column:
    """One third of the ids, by checksum."""
    return F.crc32(F.col(doc_id).cast("string")) % 3 == 1 if isinstance(doc_id, str) else F.crc32(doc_id.cast("string")) % 3 == 1
