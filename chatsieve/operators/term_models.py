"""Linear models whose weights are a table, for vocabularies of any size.

The counts of terms are dealt by term and packed: every block has the rows and counts of its
terms as arrays. The weights of a penalised model are a sum of its rows, one coefficient per
row, so the optimiser (limited-memory BFGS) works on numbers per row and never on numbers
per term. A step needs one product X (X' c) of the features with a coefficient per row: each
block sums its terms, gives them back to its rows, and the parts are added up by row. Models
that differ in penalty, rows or document counts share such a pass.

The driver holds a bounded set of numbers per row. Fits of more than ``PACKED_ROWS`` rows pass
over packed rows instead (``row_models``), where it holds numbers per term. If these are too many
as well, a two-class model is fitted by joins alone (``_Descent``): there terms, their weights and
gradients are rows of a table keyed by term, and the driver holds dot products.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from itertools import combinations_with_replacement

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructField, StructType
from pyspark.sql.window import Window

from chatsieve.operators import row_models
from chatsieve.operators.features import term_counts, terms_sql
from chatsieve.operators.hashed import hashed, hashed_terms, list_parts, pieces
from chatsieve.operators.skew import discard, join_lookup, settled

HISTORY = 5
STEPS = (8.0, 4.0, 2.0, 1.0, 0.5, 0.25, 0.1, 0.03, 0.01, 1e-3, 1e-4, 1e-6)
# Numbers (of 8 bytes) per row, class and model that the driver holds at once.
MAX_NUMBERS = 96_000_000
PAIRS_PER_BLOCK = 500_000
# Fits of more rows than these pass over packed rows (``row_models``): below, numbers per row are fewer
# than weights, and exact steps save passes.
PACKED_ROWS = 200_000
# Weights of up to so many numbers are sent to every task that scores texts.
LOOKED_UP = 8_000_000
NUMBERS_PER_CHUNK = 1 << 17


@dataclass
class TermModel:
    """``weights`` is (term, df, idf, weight); terms are found as ``analyzer`` and ``ngram`` say.
    Of a counts model idf is NULL. Of several classes ``weights`` is (term, df, idf, weights),
    and ``intercept`` has one number per class."""

    weights: DataFrame
    intercept: float | list[float]
    analyzer: str = "word"
    ngram: tuple[int, int] = (1, 1)


@dataclass(frozen=True)
class Terms:
    """The terms in at least ``min_df`` of the fitted rows and at most a share ``max_df``."""

    min_df: int = 1
    max_df: float = 1.0

    def kept(self, df: np.ndarray, n: int) -> np.ndarray:
        return (df >= max(1, self.min_df)) & (df <= (self.max_df * n if self.max_df < 1 else n))

    def idf(self, df: np.ndarray, n: int) -> np.ndarray:
        """idf + 1, and 0 for terms that are left out."""
        return np.where(self.kept(df, n), np.log((n + 1) / (df + 1)) + 1, 0.0)


def _packed(batches: Iterator[pa.RecordBatch], used: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Blocks of whole terms from rows (term, row, tf) in the order of terms."""
    kept = None

    def block(table: pa.Table) -> pa.RecordBatch:
        term = table.column("term").combine_chunks()
        first = _first_of_runs(term)
        size = np.diff(np.append(first, len(term))).astype(np.int32)
        row = table.column("row").to_numpy().astype(np.int32)
        tf = table.column("tf").to_numpy().astype(np.int32)
        df = np.add.reduceat(used[row].astype(np.int64), first)
        terms = pa.array([term.take(pa.array(first)).to_pylist()], pa.list_(pa.string()))
        numbers = [pa.array([x.tobytes()], pa.binary()) for x in (df, size, row, tf)]
        return pa.RecordBatch.from_arrays([terms, *numbers], ["terms", "df", "size", "rows", "tf"])

    for batch in batches:
        if not len(batch):
            continue
        table = pa.Table.from_batches([batch])
        kept = table if kept is None else pa.concat_tables([kept, table])
        if len(kept) >= PAIRS_PER_BLOCK:
            last = int(_first_of_runs(kept.column("term").combine_chunks())[-1])
            if last:
                yield block(kept.slice(0, last))
                kept = kept.slice(last)
    if kept is not None:
        yield block(kept)


def _first_of_runs(values: pa.Array) -> np.ndarray:
    if isinstance(values, pa.ChunkedArray):
        values = values.combine_chunks()
    new = pc.not_equal(values[1:], values[:-1]).to_numpy(zero_copy_only=False)
    return np.flatnonzero(np.concatenate(([True], new)))


class Packed:
    """Term counts of numbered rows; document counts are those of the rows that are ``used``.
    ``y``, ``fold`` and ``used`` hold a number per row."""

    def __init__(
        self, df: DataFrame, text: str, truth: str, ngram: tuple[int, int], analyzer: str, fitted: Column | None = None, fold: str | None = None
    ) -> None:
        self.spark, self.ngram, self.analyzer = df.sparkSession, ngram, analyzer
        used = F.lit(True) if fitted is None else fitted
        part = F.lit(0) if fold is None else F.col(fold).cast("int")
        given = df.select(
            F.col(text).alias("said"), F.col(truth).cast("double").alias("y"), used.alias("used"), part.alias("fold"),
            F.monotonically_increasing_id().alias("given"),
        )
        given = settled(given, "rows")
        # A place from 0 on: the rows of all parts before, and the place in the part.
        held = F.shiftright("given", 33)
        sizes = given.groupBy(held.alias("part")).agg(F.count("*").alias("n")).orderBy("part").collect()
        before = np.append(0, np.cumsum([r.n for r in sizes]))
        self.n = int(before[-1])
        ahead = self.spark.createDataFrame([(r.part, int(n)) for r, n in zip(sizes, before)], "part long, before long")
        place = F.col("before") + F.col("given").bitwiseAND((1 << 33) - 1)
        self.rows = given.withColumn("part", held).join(F.broadcast(ahead), "part").select(
            place.alias("row"), "said", "y", "used", "fold"
        )
        self.given = given
        self.y, self.fold, self.used = np.zeros(self.n), np.zeros(self.n, np.int32), np.zeros(self.n, bool)
        for batch in self.rows.select("row", "y", "fold", "used").toArrow().to_batches():
            at = batch.column("row").to_numpy()
            self.y[at] = batch.column("y").to_numpy(zero_copy_only=False)
            self.fold[at] = batch.column("fold").to_numpy()
            self.used[at] = batch.column("used").to_numpy(zero_copy_only=False)
        if np.isnan(self.y).any():
            raise ValueError("every row needs a class")
        self.n_fit = int(self.used.sum())
        counts = term_counts(self.rows, "row", "said", analyzer, ngram)
        parts = max(int(self.spark.conf.get("spark.sql.shuffle.partitions")), self.spark.sparkContext.defaultParallelism)
        dealt = counts.select("term", "row", "tf").repartition(parts, "term").sortWithinPartitions("term", "row")
        used = self.spark.sparkContext.broadcast(self.used)
        packed = dealt.mapInArrow(
            lambda it: _packed(it, used.value), "terms array<string>, df binary, size binary, rows binary, tf binary"
        )
        self.blocks = settled(packed, "blocks")
        used.destroy()

    def discard(self) -> None:
        discard(self.given, self.blocks)

    def summed(self, width: int, add: Callable) -> np.ndarray:
        """(width, n): what ``add(sums, df, size, first, rows, tf)`` adds up over all blocks."""
        n = self.n

        def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums = None
            for numbers in _blocks(batches):
                sums = np.zeros((width, n)) if sums is None else sums
                add(sums, *numbers)
            if sums is not None:
                flat = sums.ravel()
                for k, start in enumerate(range(0, len(flat), NUMBERS_PER_CHUNK)):
                    piece = flat[start : start + NUMBERS_PER_CHUNK].astype(np.float64).tobytes()
                    yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([piece], pa.binary())], ["chunk", "part"])

        chunks = max(1, math.ceil(width * n / NUMBERS_PER_CHUNK))
        partial = self.blocks.select("df", "size", "rows", "tf").mapInArrow(parts, "chunk int, part binary")
        whole = partial.repartition(min(chunks, self.spark.sparkContext.defaultParallelism), "chunk").mapInArrow(_added, "chunk int, part binary")
        out = np.zeros(width * n)
        for r in whole.toLocalIterator() if chunks > 64 else whole.collect():
            piece = np.frombuffer(r.part)
            out[r.chunk * NUMBERS_PER_CHUNK : r.chunk * NUMBERS_PER_CHUNK + len(piece)] = piece
        return out.reshape(width, n)

    def lengths(self, terms: Sequence[Terms]) -> np.ndarray:
        """(terms, n): one over the length of each row's tf * idf, 0 for a row without terms."""
        n_fit = self.n_fit

        def add(sums, df, size, first, rows, tf):
            for j, t in enumerate(terms):
                idf = np.repeat(t.idf(df, n_fit), size)
                sums[j] += np.bincount(rows, (tf * idf) ** 2, sums.shape[1])

        squares = self.summed(len(terms), add)
        with np.errstate(divide="ignore"):
            return np.where(squares > 0, 1 / np.sqrt(squares), 0.0)

    def products(self, terms: Sequence[Terms], scale: Sequence[np.ndarray], coefficients: Sequence[np.ndarray]) -> list[np.ndarray]:
        """X (X' c) for each vector c, with the features of unit length that its ``terms`` give."""
        n_fit = self.n_fit
        sent = self.spark.sparkContext.broadcast(np.array([c * s for c, s in zip(coefficients, scale, strict=True)]))

        def add(sums, df, size, first, rows, tf):
            squared = {t: t.idf(df, n_fit) ** 2 for t in set(terms)}
            for j, (t, c) in enumerate(zip(terms, sent.value, strict=True)):
                per_term = np.add.reduceat(c[rows] * tf, first) * squared[t]
                sums[j] += np.bincount(rows, np.repeat(per_term, size) * tf, sums.shape[1])

        found = self.summed(len(terms), add)
        sent.destroy()
        return [f * s for f, s in zip(found, scale, strict=True)]

    def class_sums(self, terms: Sequence[Terms]) -> dict[Terms, tuple[int, float, float]]:
        """(terms kept, their occurrences in used rows of the class, and of the other) of each."""
        n_fit, sent = self.n_fit, self.spark.sparkContext.broadcast((self.used, self.used & (self.y == 1.0)))

        def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums = np.zeros((len(terms), 3))
            for df, size, first, rows, tf in _blocks(batches):
                used, ones = (np.add.reduceat(u[rows] * tf, first) for u in sent.value)
                for j, t in enumerate(terms):
                    kept = t.kept(df, n_fit)
                    sums[j] += kept.sum(), ones[kept].sum(), (used - ones)[kept].sum()
            yield pa.RecordBatch.from_arrays([pa.array(range(len(terms)), pa.int32()), *map(pa.array, sums.T)], ["j", "n", "ones", "rest"])

        partial = self.blocks.select("df", "size", "rows", "tf").mapInArrow(parts, "j int, n double, ones double, rest double")
        found = {r.j: (int(r.n), r.ones, r.rest) for r in partial.groupBy("j").agg(*[F.sum(c).alias(c) for c in ("n", "ones", "rest")]).collect()}
        sent.destroy()
        return {t: found[j] for j, t in enumerate(terms)}

    def log_odds(self, settings: Sequence[tuple[Terms, float, tuple[int, float, float]]]) -> np.ndarray:
        """(settings, n): the log odds of every row in the counts model of (terms, alpha, class sums)."""
        n_fit, ones_n = self.n_fit, int(self.y[self.used].sum())
        sent = self.spark.sparkContext.broadcast((self.used, self.used & (self.y == 1.0)))

        def add(sums, df, size, first, rows, tf):
            used, ones = (np.add.reduceat(u[rows] * tf, first) for u in sent.value)
            for j, (t, a, (v, s1, s0)) in enumerate(settings):
                odds = np.log((ones + a) / (s1 + a * v)) - np.log((used - ones + a) / (s0 + a * v))
                sums[j] += np.bincount(rows, np.repeat(np.where(t.kept(df, n_fit), odds, 0.0), size) * tf, sums.shape[1])

        found = self.summed(len(settings), add)
        sent.destroy()
        for j, (_, a, _) in enumerate(settings):
            found[j] += math.log((ones_n + a) / (n_fit - ones_n + a))
        return found

    def weights(self, terms: Terms, scale: np.ndarray, coefficients: np.ndarray) -> DataFrame:
        """(term, df, idf, weights): X' c for the rows of ``coefficients``, one per class."""
        n_fit, sent = self.n_fit, self.spark.sparkContext.broadcast(coefficients * scale)

        def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for i in range(len(batch)):
                    one = batch.slice(i, 1)
                    df, size, first, rows, tf = next(_blocks([one]))
                    idf = terms.idf(df, n_fit)
                    w = np.array([np.add.reduceat(c[rows] * tf, first) * idf for c in sent.value])
                    keep = np.flatnonzero(terms.kept(df, n_fit))
                    lists = pa.FixedSizeListArray.from_arrays(pa.array(w[:, keep].T.ravel()), len(w)).cast(pa.list_(pa.float64()))
                    term = one.column("terms").flatten().take(pa.array(keep))
                    yield pa.RecordBatch.from_arrays(
                        [term, pa.array(df[keep]), pa.array(idf[keep]), lists], ["term", "df", "idf", "weights"]
                    )

        schema = "term string, df long, idf double, weights array<double>"
        table = settled(self.blocks.mapInArrow(found, schema), "weights")
        sent.destroy()
        return table


def _blocks(batches) -> Iterator[tuple[np.ndarray, ...]]:
    """(df, size, first, rows, tf) of every block: numbers per term, then per pair."""
    for batch in batches:
        for df, size, rows, tf in zip(*[batch.column(c) for c in ("df", "size", "rows", "tf")]):
            size = np.frombuffer(size.as_buffer(), np.int32)
            first = np.cumsum(size, dtype=np.int64) - size
            yield (
                np.frombuffer(df.as_buffer(), np.int64), size, first,
                np.frombuffer(rows.as_buffer(), np.int32), np.frombuffer(tf.as_buffer(), np.int32),
            )


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for k, part in zip(batch.column("chunk").to_pylist(), batch.column("part")):
            piece = np.frombuffer(part.as_buffer())
            if k in sums:
                sums[k] += piece
            else:
                sums[k] = piece.copy()
    for k, piece in sums.items():
        yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([piece.tobytes()], pa.binary())], ["chunk", "part"])


class _Vector:
    """A weight vector as coefficients per row, with its products with all rows and the intercepts."""

    def __init__(self, c: np.ndarray, margins: np.ndarray, b: np.ndarray) -> None:
        self.c, self.margins, self.b = c, margins, b

    def dot(self, other: _Vector) -> float:
        return float(np.vdot(self.c, other.margins) + self.b @ other.b)

    def plus(self, a: float, other: _Vector) -> _Vector:
        return _Vector(self.c + a * other.c, self.margins + a * other.margins, self.b + a * other.b)

    def times(self, a: float) -> _Vector:
        return _Vector(a * self.c, a * self.margins, a * self.b)


class Fit:
    """One model on its way to the optimum: mean loss of ``mask``ed rows plus |w|^2 / (2 C n), the
    intercept without penalty. ``classes`` of a multinomial model have a row of numbers each."""

    def __init__(self, y: np.ndarray, mask: np.ndarray, c: float, terms: Terms, scale: np.ndarray, tol: float, max_iter: int, classes: int = 0, history: int = HISTORY) -> None:
        self.mask, self.terms, self.scale, self.tol = mask, terms, scale, tol
        self.left, self.keep, self.classes = max_iter, history, classes
        self.n = int(mask.sum())
        self.penalty = 1.0 / (c * max(1, self.n))
        m = classes or 1
        shares = np.array([(y[mask] == k).mean() if self.n else 0.0 for k in range(classes or 2)])
        if not classes:
            if not 0 < shares[1] < 1:
                raise ValueError("both classes are needed")
            self.target = (y == 1.0)[None].astype(float)
            b = np.array([math.log(shares[1] / shares[0])])
        else:
            self.target = (y[None] == np.arange(classes)[:, None]).astype(float)
            b = np.log(np.maximum(shares, 0.01 / max(1, self.n)))
            b -= b.mean()
        self.w = _Vector(np.zeros((m, len(y))), np.zeros((m, len(y))), b)
        self.pairs: list[tuple[_Vector, _Vector]] = []
        self.g = None
        self.value, self.done = self._loss(self.w.margins + b[:, None]), max_iter <= 0
        self._slope()

    def _chances(self, margins: np.ndarray) -> np.ndarray:
        if not self.classes:
            return np.exp(-np.logaddexp(0.0, -margins))
        e = np.exp(margins - margins.max(axis=0))
        return e / e.sum(axis=0)

    def _loss(self, margins: np.ndarray) -> float:
        if not self.classes:
            each = np.logaddexp(0.0, np.where(self.target == 1.0, -margins, margins))[0]
        else:
            top = margins.max(axis=0)
            each = top + np.log(np.exp(margins - top).sum(axis=0)) - (margins * self.target).sum(axis=0)
        return float(each[self.mask].sum() / self.n)

    def _slope(self) -> None:
        """The coefficients of the gradient; its products are found by the next pass."""
        error = np.where(self.mask, self._chances(self.w.margins + self.w.b[:, None]) - self.target, 0.0) / self.n
        self.next_c, self.next_b = error + self.penalty * self.w.c, error.sum(axis=1)

    def step(self, margins: np.ndarray) -> None:
        """One step, given the products of the gradient with all rows."""
        g = _Vector(self.next_c, margins, self.next_b)
        if self.g is not None:
            change = g.plus(-1.0, self.g)
            if change.dot(self.moved) > 0:
                self.pairs = [*self.pairs, (self.moved, change)][-self.keep :]
        self.g = g
        d, alphas = g, []
        for s, v in reversed(self.pairs):
            alphas.append(s.dot(d) / s.dot(v))
            d = d.plus(-alphas[-1], v)
        if self.pairs:
            s, v = self.pairs[-1]
            d = d.times(s.dot(v) / v.dot(v))
        else:
            d = d.times(1.0 / max(1e-300, math.sqrt(max(0.0, g.dot(g)))))
        for (s, v), a in zip(self.pairs, reversed(alphas), strict=True):
            d = d.plus(a - v.dot(d) / s.dot(v), s)
        d = d.times(-1.0)
        a, value = self._search(d)
        self.left -= 1
        better = value < self.value
        self.done = self.left <= 0 or not better or self.value - value <= self.tol * abs(value)
        if better:
            self.moved = d.times(a)
            self.w, self.value = self.w.plus(1.0, self.moved), value
            self._slope()

    def _search(self, d: _Vector) -> tuple[float, float]:
        """(step, objective): Newton steps along a direction, kept between bounds; the objective is convex."""
        m, u = self.w.margins + self.w.b[:, None], d.margins + d.b[:, None]
        ww, wd, dd = (float(np.vdot(x.c, y.margins)) for x, y in ((self.w, self.w), (self.w, d), (d, d)))
        use = self.mask
        lo, hi, a = 0.0, math.inf, 1.0
        for _ in range(20):
            p = self._chances(m + a * u)
            slope = float(((p - self.target) * u)[:, use].sum() / self.n + self.penalty * (wd + a * dd))
            if not self.classes:
                bend = (p * (1 - p) * u * u)[:, use].sum()
            else:
                bend = ((p * u * u).sum(axis=0) - (p * u).sum(axis=0) ** 2)[use].sum()
            bend = float(bend / self.n + self.penalty * dd)
            lo, hi = (a, hi) if slope < 0 else (lo, a)
            new = a - slope / bend if bend > 0 else math.inf
            if not lo < new < hi:
                new = (lo + hi) / 2 if hi < math.inf else 2 * a
            if abs(new - a) <= 1e-3 * a or hi - lo <= 1e-12:
                a = new
                break
            a = new
        return a, self._loss(m + a * u) + self.penalty / 2 * (ww + 2 * a * wd + a * a * dd)

    def scores(self) -> np.ndarray:
        """(classes or 1, rows): margins with the intercept."""
        return self.w.margins + self.w.b[:, None]


def run(packed: Packed, fits: Sequence[Fit]) -> None:
    """All models to their optimum; those that are still on the way share each pass."""
    active = [f for f in fits if not f.done]
    while active:
        asked = [(f, k) for f in active for k in range(len(f.next_c))]
        found = iter(packed.products([f.terms for f, _ in asked], [f.scale for f, _ in asked], [f.next_c[k] for f, k in asked]))
        for f in active:
            f.step(np.array([next(found) for _ in f.next_c]))
        active = [f for f in active if not f.done]


def room(n: int, classes: int = 1, wanted: int = 1) -> tuple[int, int]:
    """(models that may run at once, step pairs that each keeps) for n rows; no models if the rows
    of one are too many for the driver."""
    each = max(1, n) * classes
    for history in (2 * HISTORY, 8, 6, 4, 3, 2, 1):
        models = MAX_NUMBERS // (each * (4 * history + 12))
        if models >= min(wanted, 4 if history > 4 else 1):
            return models, history
    return 0, 0


def _some_room(n: int, wanted: int, classes: int = 1) -> tuple[int, int]:
    models, history = room(n, classes, wanted)
    if not models:
        raise ValueError("too many rows for one model: raise MAX_NUMBERS on a larger driver")
    return models, history


def vocabulary(counts: DataFrame, n_docs: int, min_df: int, max_df: float) -> DataFrame:
    """(t, term, df, idf) of the terms in at least ``min_df`` texts and at most a share ``max_df``."""
    most = max_df * n_docs if max_df < 1 else n_docs
    held = counts.groupBy("term").agg(F.count("*").alias("df")).filter((F.col("df") >= min_df) & (F.col("df") <= most))
    idf = F.ln((n_docs + 1) / (F.col("df") + 1)) + 1
    return held.select(F.monotonically_increasing_id().alias("t"), "term", "df", idf.alias("idf"))


def unit_values(valued: DataFrame, id_col: str, *keep: str) -> DataFrame:
    """(id, *keep, x): tf * idf, brought to unit length per id."""
    raw = valued.withColumn("raw", F.col("tf") * F.col("idf"))
    lists = raw.groupBy(id_col).agg(
        F.collect_list(F.struct(*keep, "raw")).alias("found"), F.sqrt(F.sum(F.col("raw") * F.col("raw"))).alias("norm")
    )
    item = F.explode("found").alias("f")
    return lists.select(id_col, "norm", item).select(id_col, *[f"f.{k}" for k in keep], (F.col("f.raw") / F.col("norm")).alias("x"))


def fit_term_logistic(
    df: DataFrame,
    c: float = 1.0,
    min_df: int = 1,
    max_df: float = 1.0,
    ngram: tuple[int, int] = (1, 1),
    analyzer: str = "word",
    max_iter: int = 100,
    text: str = "message",
    truth: str = "toxic",
    tolerance: float = 1e-8,
) -> TermModel:
    """The same model as ``fit_logistic``, with no bound on the vocabulary: mean loss plus
    |w|^2 / (2 * C * n), the intercept without penalty. A step ends the fit when it lowers the
    objective by less than ``tolerance`` of it. A missing text has no terms."""
    n = df.count()
    if n > PACKED_ROWS:
        model = fit_on_rows(df, c, Terms(min_df, max_df), ngram, analyzer, max_iter, text, truth, tolerance)
        if model is not None:
            return model
    if room(n)[0]:
        return fit_packed_logistic(df, c, min_df, max_df, ngram, analyzer, max_iter, text, truth, tolerance)
    rows = settled(
        df.select(F.monotonically_increasing_id().alias("row"), F.col(text).alias("said"), F.col(truth).cast("double").alias("y")),
        "rows",
    )
    n, positive = rows.agg(F.count("*"), F.sum("y")).first()
    if not n or positive in (0, n):
        raise ValueError("both classes are needed")
    counts = settled(term_counts(rows, "row", "said", analyzer, ngram), "counts")
    words = settled(vocabulary(counts, n, min_df, max_df), "words")
    valued = join_lookup(counts, words, "term", "df", F.col("row"))
    x = settled(unit_values(valued, "row", "t"), "values")
    discard(counts)
    descent = _Descent(x, rows.select("row", "y"), words.select("t"), n, positive / n, 1.0 / (c * n))
    for _ in range(max_iter):
        before = descent.objective
        if not descent.step() or before - descent.objective <= tolerance * max(1.0, abs(before)):
            break
    weights = settled(words.join(descent.terms.select("t", "w"), "t").select("term", "df", "idf", F.col("w").alias("weight")), "weights")
    discard(x, rows, words, descent.terms, descent.margins)
    return TermModel(weights, descent.b, analyzer, ngram)


def fit_on_rows(
    df: DataFrame, c: float, terms: Terms, ngram: tuple[int, int], analyzer: str, max_iter: int, text: str, truth: str, tol: float, classes: int = 0
) -> TermModel | None:
    """The model by passes over packed rows, of which there may be any number; None if the weights
    are too many to be sent to every task."""
    rows = row_models.Rows(df, text, truth, [terms], ngram, analyzer, most=row_models.MOST_WEIGHTS // (classes or 1))
    try:
        if rows.blocks is None:
            return None
        fit = row_models.Fit(rows, c, 0, tol, max_iter, classes)
        row_models.run(rows, [fit])
        return row_model(rows, fit)
    finally:
        rows.discard()


def row_model(rows: row_models.Rows, fit: row_models.Fit) -> TermModel:
    weights, b = rows.weights(fit), [float(x) for x in fit.x[fit.m * fit.v :]]
    if fit.classes:
        return TermModel(weights, b, rows.analyzer, rows.ngram)
    return TermModel(weights.select("term", "df", "idf", F.get("weights", F.lit(0)).alias("weight")), b[0], rows.analyzer, rows.ngram)


def fit_packed_logistic(
    df: DataFrame, c: float, min_df: int, max_df: float, ngram: tuple[int, int], analyzer: str, max_iter: int, text: str, truth: str, tol: float
) -> TermModel:
    packed = Packed(df, text, truth, ngram, analyzer)
    terms = Terms(min_df, max_df)
    fit = Fit(packed.y, packed.used, c, terms, packed.lengths([terms])[0], tol, max_iter, history=room(packed.n)[1])
    run(packed, [fit])
    model = term_model(packed, fit)
    packed.discard()
    return model


def term_model(packed: Packed, fit: Fit) -> TermModel:
    weights = packed.weights(fit.terms, fit.scale, fit.w.c)
    if fit.classes:
        return TermModel(weights, [float(b) for b in fit.w.b], packed.analyzer, packed.ngram)
    one = weights.select("term", "df", "idf", F.get("weights", F.lit(0)).alias("weight"))
    return TermModel(one, float(fit.w.b[0]), packed.analyzer, packed.ngram)


def fit_term_classes(
    df: DataFrame, c: float, min_df: int, max_df: float, max_iter: int, text: str, label: str, tol: float
) -> TermModel:
    """Multinomial logistic regression over labels 0, 1, ..., with weights in a table."""
    classes = int(df.agg(F.max(F.col(label).cast("double"))).first()[0]) + 1
    n = df.count()
    if n > PACKED_ROWS:
        model = fit_on_rows(df, c, Terms(min_df, max_df), (1, 1), "word", max_iter, text, label, tol, classes)
        if model is not None:
            return model
    _, history = _some_room(n, 1, classes)
    packed = Packed(df, text, label, (1, 1), "word")
    terms = Terms(min_df, max_df)
    fit = Fit(packed.y, packed.used, c, terms, packed.lengths([terms])[0], tol, max_iter, classes, history)
    run(packed, [fit])
    model = term_model(packed, fit)
    packed.discard()
    return model


def cross_validate(
    packed: Packed, k: int, grid: Sequence[float], terms: Terms, scale: np.ndarray, tol: float, max_iter: int
) -> list[float]:
    """Mean accuracy over the folds for each C. Rows of all folds share the features, so the
    products with the rows that a fold leaves out are their margins."""
    jobs = [(i, f) for i in range(len(grid)) for f in range(k)]
    at_once, history = _some_room(packed.n, len(jobs))
    found = np.zeros((len(grid), k))
    for start in range(0, len(jobs), at_once):
        part = jobs[start : start + at_once]
        fits = [Fit(packed.y, packed.fold != f, grid[i], terms, scale, tol, max_iter, history=history) for i, f in part]
        run(packed, fits)
        for (i, f), fit in zip(part, fits, strict=True):
            out = packed.fold == f
            found[i, f] = ((fit.scores()[0] > 0) == (packed.y == 1.0))[out].mean()
    return [float(a) for a in found.mean(axis=1)]


def cross_validate_rows(rows: row_models.Rows, k: int, grid: Sequence[float], tol: float, max_iter: int) -> list[float]:
    """Mean accuracy over the folds, which are the parts of the rows, for each C."""
    fits = [row_models.Fit(rows, c, 0, tol, max_iter, out=f) for c in grid for f in range(k)]
    row_models.run(rows, fits)
    right = [(tp + tn) / max(1, tp + fp + fn + tn) for tp, fp, fn, tn in rows.judged(fits)]
    return [float(a) for a in np.array(right).reshape(len(grid), k).mean(axis=1)]


def judge_settings(
    packed: Packed, settings: Sequence[tuple[Terms, float]], family: str, tol: float, max_iter: int
) -> list[tuple[int, int, int, int]]:
    """(true positives, false positives, false negatives, true negatives) on the rows that are not
    ``used``, for the model of every (terms, strength)."""
    every = list(dict.fromkeys(t for t, _ in settings))
    out, truth = [], packed.y == 1.0

    def judged(scores: np.ndarray) -> tuple[int, int, int, int]:
        said, rest = scores > 0, ~packed.used
        return tuple(int((rest & a & b).sum()) for a, b in ((said, truth), (said, ~truth), (~said, truth), (~said, ~truth)))

    if family == "naive_bayes":
        sums = packed.class_sums(every)
        at_once = max(1, MAX_NUMBERS // (4 * max(1, packed.n)))
        for start in range(0, len(settings), at_once):
            part = settings[start : start + at_once]
            out += [judged(s) for s in packed.log_odds([(t, a, sums[t]) for t, a in part])]
        return out
    scale = dict(zip(every, packed.lengths(every), strict=True))
    at_once, history = _some_room(packed.n, len(settings))
    for start in range(0, len(settings), at_once):
        fits = [Fit(packed.y, packed.used, c, t, scale[t], tol, max_iter, history=history) for t, c in settings[start : start + at_once]]
        run(packed, fits)
        out += [judged(f.scores()[0]) for f in fits]
    return out


def fit_term_counts(df: DataFrame, alpha: float, min_df: int, max_df: float, text: str, truth: str) -> TermModel:
    """The multinomial counts model with its log odds in a table by term."""
    rows = df.select(F.col(text).alias("said"), F.col(truth).cast("double").alias("y"), F.monotonically_increasing_id().alias("row"))
    rows = settled(rows, "rows")
    n, ones = rows.agg(F.count("*"), F.sum("y")).first()
    if not n or ones in (0, n):
        raise ValueError("both classes are needed")
    counts = term_counts(rows, "row", "said", "word", (1, 1), "y")
    per_term = counts.groupBy("term").agg(
        F.count("*").alias("df"),
        F.sum(F.when(F.col("y") == 1.0, F.col("tf")).otherwise(0)).alias("toxic"),
        F.sum(F.when(F.col("y") == 1.0, 0).otherwise(F.col("tf"))).alias("clean"),
    )
    most = max_df * n if max_df < 1 else n
    per_term = settled(per_term.filter((F.col("df") >= min_df) & (F.col("df") <= most)), "class-counts")
    size, toxic, clean = per_term.agg(F.count("*"), F.coalesce(F.sum("toxic"), F.lit(0)), F.coalesce(F.sum("clean"), F.lit(0))).first()

    def share(found: str, total: int) -> Column:
        return F.ln((F.col(found) + float(alpha)) / float(total + alpha * size))

    odds = share("toxic", toxic) - share("clean", clean)
    weights = settled(per_term.select("term", "df", F.lit(None).cast("double").alias("idf"), odds.alias("weight")), "weights")
    discard(rows, per_term)
    return TermModel(weights, math.log((ones + alpha) / (n - ones + alpha)))


def _loss(margin: Column, y: Column) -> Column:
    """ln(1 + exp(-m)) for y = 1 and ln(1 + exp(m)) for y = 0, without overflow."""
    z = F.when(y == 1.0, -margin).otherwise(margin)
    return F.greatest(z, F.lit(0.0)) + F.log1p(F.exp(-F.abs(z)))


def _error(margin: Column, y: Column) -> Column:
    return 1.0 / (1.0 + F.exp(-margin)) - y


class _Descent:
    """Tables: ``terms`` (t, w, g, s, v) with the last steps s and gradient changes v as arrays,
    newest last; ``margins`` (row, y, m). Entries for the intercept are kept here."""

    def __init__(self, x: DataFrame, rows: DataFrame, terms: DataFrame, n: int, share: float, penalty: float) -> None:
        self.x, self.n, self.penalty = x, n, penalty
        self.b = math.log(share / (1 - share))
        self.margins = settled(rows.withColumn("m", F.lit(self.b)), "margins")
        self.held = 0
        self.s0, self.v0 = [], []
        zero, none = F.lit(0.0), F.array().cast("array<double>")
        start = terms.select("t", zero.alias("w"), none.alias("s"), none.alias("v"))
        self.terms = settled(start.join(self._slope(), "t", "left").select("t", "w", F.coalesce("d", zero).alias("g"), "s", "v"), "terms")
        self.g0 = self._slope_of_intercept()
        self.objective = self.margins.agg(F.sum(_loss(F.col("m"), F.col("y")))).first()[0] / n

    def _slope(self) -> DataFrame:
        """(t, d): the gradient of the mean loss."""
        errors = self.margins.select("row", (_error(F.col("m"), F.col("y")) / self.n).alias("e"))
        return self.x.join(errors, "row").groupBy("t").agg(F.sum(F.col("x") * F.col("e")).alias("d"))

    def _slope_of_intercept(self) -> float:
        return self.margins.agg(F.sum(_error(F.col("m"), F.col("y")))).first()[0] / self.n

    def _basis(self) -> list[Column]:
        """Steps, gradient changes, the gradient, the weights."""
        return [F.col(a)[k] for a in ("s", "v") for k in range(self.held)] + [F.col("g"), F.col("w")]

    def _direction(self) -> tuple[np.ndarray, np.ndarray]:
        """(coefficients of the direction in the basis, products of all pairs of the basis); the
        products with the weights leave the intercept out, which has no penalty."""
        basis, k = self._basis(), self.held
        pairs = list(combinations_with_replacement(range(len(basis)), 2))
        sums = self.terms.agg(*[F.coalesce(F.sum(basis[i] * basis[j]), F.lit(0.0)).alias(f"p{i}_{j}") for i, j in pairs]).first()
        dots = np.zeros((len(basis), len(basis)))
        for (i, j), value in zip(pairs, sums, strict=True):
            dots[i, j] = dots[j, i] = value
        own = np.array([*self.s0, *self.v0, self.g0, 0.0])
        full = dots + np.outer(own, own)
        coef = np.zeros(len(basis))
        coef[2 * k] = -1.0
        alpha = np.zeros(k)
        for i in reversed(range(k)):
            alpha[i] = full[i] @ coef / full[i, k + i]
            coef[k + i] -= alpha[i]
        if k:
            coef *= full[k - 1, 2 * k - 1] / full[2 * k - 1, 2 * k - 1]
        for i in range(k):
            coef[i] += alpha[i] - full[k + i] @ coef / full[i, k + i]
        return coef, dots

    def step(self) -> bool:
        """One step; False if none lowers the objective."""
        coef, dots = self._direction()
        own = float(coef[:-1] @ np.array([*self.s0, *self.v0, self.g0]))
        move = sum((float(a) * b for a, b in zip(coef, self._basis(), strict=True)), F.lit(0.0))
        moved = self.terms.select("t", "w", "g", "s", "v", move.alias("d"))
        along = self.x.join(moved.select("t", "d"), "t").groupBy("row").agg(F.sum(F.col("x") * F.col("d")).alias("u"))
        ahead = settled(
            self.margins.join(along, "row", "left").select("row", "y", "m", (F.coalesce("u", F.lit(0.0)) + own).alias("u")), "ahead"
        )
        tried = ahead.agg(*[F.sum(_loss(F.col("m") + a * F.col("u"), F.col("y"))) for a in STEPS]).first()
        ww, wd, dd = dots[-1, -1], float(coef @ dots[-1]), float(coef @ dots @ coef)
        values = [
            loss / self.n + self.penalty / 2 * (ww + 2 * a * wd + a * a * dd) for a, loss in zip(STEPS, tried, strict=True)
        ]
        best = int(np.argmin(values))
        if not values[best] < self.objective:
            discard(ahead)
            return False
        a, self.objective = STEPS[best], values[best]
        old = self.margins
        self.margins = settled(ahead.select("row", "y", (F.col("m") + a * F.col("u")).alias("m")), "margins")
        discard(ahead, old)
        self.b += a * own
        g0 = self._slope_of_intercept()
        self.s0, self.v0 = [*self.s0, a * own][-HISTORY:], [*self.v0, g0 - self.g0][-HISTORY:]
        self.g0 = g0
        w = F.col("w") + a * F.col("d")
        new = moved.join(self._slope().withColumnRenamed("d", "slope"), "t", "left").withColumn(
            "now", F.coalesce("slope", F.lit(0.0)) + self.penalty * w
        )

        def pushed(name: str, value: Column) -> Column:
            return F.slice(F.concat(F.col(name), F.array(value)), max(1, self.held - HISTORY + 2), HISTORY).alias(name)

        old = self.terms
        self.terms = settled(
            new.select("t", w.alias("w"), F.col("now").alias("g"), pushed("s", a * F.col("d")), pushed("v", F.col("now") - F.col("g"))),
            "terms",
        )
        discard(old)
        self.held = min(self.held + 1, HISTORY)
        return True


def looked_up_margins(df: DataFrame, model: TermModel, text: str) -> DataFrame:
    """``df`` and ``_margin``, row by row: every task has the weights by the hashes of the terms."""
    several = isinstance(model.intercept, list)
    weights = F.col("weights") if several else F.array("weight")
    known, salt, table = hashed(model.weights, "term", F.col("idf").cast("double"), weights.alias("w"))
    b = np.array(model.intercept if several else [model.intercept])
    idf = table.column("idf").to_numpy(zero_copy_only=False)[known.order]
    w = pc.list_flatten(table.column("w")).to_numpy(zero_copy_only=False).reshape(-1, len(b))[known.order].T.copy()
    # A counts model adds up occurrences; of all others the values have unit length.
    sent = model.weights.sparkSession.sparkContext.broadcast((known, np.where(np.isnan(idf), 1.0, idf), ~np.isnan(idf), w, b))

    def some(sizes: np.ndarray, h: np.ndarray, c: np.ndarray) -> np.ndarray:
        known, idf, scaled, w, b = sent.value
        n, place = len(sizes), known.places(h, c)
        row, local, tf, uniq = row_models.counted(np.repeat(np.arange(n), sizes)[place >= 0], place[place >= 0])
        raw = tf * idf[uniq][local]
        square = np.bincount(row, np.where(scaled[uniq][local], raw * raw, 0.0), n)
        norm = np.where(square > 0, np.sqrt(square), 1.0)
        return np.array([np.bincount(row, raw * one[uniq][local], n) / norm + x for one, x in zip(w, b)])

    def margin(found: pa.Array) -> pa.Array:
        sizes, h, c = list_parts(found)
        ends = np.append(0, np.cumsum(sizes))
        parts = [some(sizes[i:j], h[ends[i] : ends[j]], c[ends[i] : ends[j]]) for i, j in pieces(sizes, row_models.TOKENS_PER_BLOCK)]
        out = np.concatenate([np.zeros((len(b), 0)), *parts], axis=1)
        if not several:
            return pa.array(out[0], pa.float64())
        return pa.ListArray.from_arrays(pa.array(np.arange(len(sizes) + 1, dtype=np.int32) * len(b)), pa.array(out.T.ravel()))

    columns = df.columns

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*map(batch.column, columns), margin(batch.column("_found"))], [*columns, "_margin"])

    found = hashed_terms(F.expr(terms_sql(model.analyzer, model.ngram, f"`{text}`")), salt)
    kind = ArrayType(DoubleType()) if several else DoubleType()
    return df.select("*", found.alias("_found")).mapInArrow(each, StructType([*df.schema, StructField("_margin", kind)]))


def term_margins(df: DataFrame, model: TermModel, text: str) -> DataFrame:
    """``df`` and ``_margin``: a number, or one per class. Up to ``LOOKED_UP`` weights, and all of a
    stream's model, are looked up row by row. Of more, terms meet their weights in a join whose
    frequent terms are broadcast; texts themselves are not shuffled with them."""
    several = isinstance(model.intercept, list)
    if df.isStreaming or model.weights.count() * (len(model.intercept) if several else 1) <= LOOKED_UP:
        return looked_up_margins(df, model, text)
    keyed = settled(df.withColumn("_row", F.monotonically_increasing_id()), "scored")
    counts = term_counts(keyed.select("_row", F.col(text).alias("_said")), "_row", "_said", model.analyzer, model.ngram)
    valued = join_lookup(counts, model.weights, "term", "df", F.col("_row"))
    raw = F.col("tf") * F.coalesce("idf", F.lit(1.0))
    names = [f"_sum{k}" for k in range(len(model.intercept) if several else 1)]
    each = [F.get("weights", F.lit(k)) for k in range(len(names))] if several else [F.col("weight")]
    # A counts model adds up occurrences; of all others the values have unit length.
    norm = F.sqrt(F.sum(F.when(F.col("idf").isNotNull(), raw * raw)))
    per_row = valued.groupBy("_row").agg(*[F.sum(raw * w).alias(n) for w, n in zip(each, names)], F.coalesce(norm, F.lit(1.0)).alias("_norm"))
    intercepts = model.intercept if several else [model.intercept]
    margins = [F.coalesce(F.col(n) / F.col("_norm"), F.lit(0.0)) + float(b) for n, b in zip(names, intercepts)]
    return keyed.join(per_row, "_row", "left").select(*df.columns, (F.array(*margins) if several else margins[0]).alias("_margin"))


def score_terms(df: DataFrame, model: TermModel, threshold: float = 0.5, text: str = "message") -> DataFrame:
    """Add (probability, pred) to every row; a missing text has neither."""
    probability = F.when(F.col(text).isNotNull(), 1.0 / (1.0 + F.exp(-F.col("_margin"))))
    return term_margins(df, model, text).select(
        *df.columns, probability.alias("probability"), (probability > threshold).alias("pred")
    )


def class_chances(df: DataFrame, model: TermModel, text: str = "message") -> DataFrame:
    """Add the chance of every class as ``chances``."""
    top = F.array_max("_margin")
    powers = F.transform("_margin", lambda m: F.exp(m - top))
    return term_margins(df, model, text).withColumn("_powers", powers).withColumn("_total", F.aggregate("_powers", F.lit(0.0), lambda a, b: a + b)).select(
        *df.columns, F.transform("_powers", lambda p: p / F.col("_total")).alias("chances")
    )


META = "intercept array<double>, several boolean, analyzer string, lo int, hi int"


def save_terms(model: TermModel, path: str) -> None:
    model.weights.write.mode("overwrite").parquet(f"{path}/weights")
    several = isinstance(model.intercept, list)
    meta = [(model.intercept if several else [model.intercept], several, model.analyzer, *model.ngram)]
    frame = model.weights.sparkSession.createDataFrame(meta, META)
    frame.coalesce(1).write.mode("overwrite").json(f"{path}/meta")


def load_terms(spark: SparkSession, path: str) -> TermModel:
    meta = spark.read.schema(META).json(f"{path}/meta").first()
    weight = "weights array<double>" if meta.several else "weight double"
    weights = spark.read.schema(f"term string, df long, idf double, {weight}").parquet(f"{path}/weights")
    return TermModel(weights, list(meta.intercept) if meta.several else meta.intercept[0], meta.analyzer, (meta.lo, meta.hi))
