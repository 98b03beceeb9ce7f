"""Linear models of any number of rows, fitted on rows that are packed in blocks.

A block has some rows as numbers: the terms in use, and per row the place of each of its terms
and how often it occurs. A term is known by its place in the order of a hash. A pass over the blocks
finds loss and gradient of several models at once; each core adds up all of its blocks before
anything is shuffled. The driver holds the document counts and the weights of the models
under way (limited-memory BFGS, whose steps lie in a file), and nothing per row.
"""

from __future__ import annotations

import gc
import math
import tempfile
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chatsieve.operators.features import terms_sql
from chatsieve.operators.hashed import Hashed, hashed, hashed_terms, list_parts, pieces
from chatsieve.operators.skew import discard, settled

# Weights that are sent to every task in one pass, and the most of one model.
PASS_WEIGHTS = 12_000_000
MOST_WEIGHTS = 48_000_000
TOKENS_PER_BLOCK = 400_000
NUMBERS_PER_CHUNK = 1 << 17
HISTORY = 10
# Bytes of partial sums after which the shuffle files of past passes are let go.
SHUFFLED_AT_MOST = 1 << 30
NO_PART = -1


def counted(row: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row, index into the distinct places, occurrences, distinct places) of every row and place."""
    uniq, local = np.unique(place, return_inverse=True)
    key = np.sort(row.astype(np.int64) * max(1, len(uniq)) + local)
    first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))) if len(key) else np.zeros(0, np.int64)
    tf = np.diff(np.append(first, len(key)))
    return key[first] // max(1, len(uniq)), key[first] % max(1, len(uniq)), tf, uniq


def _small(x: np.ndarray) -> np.ndarray:
    top = int(x.max()) if len(x) else 0
    return x.astype(np.uint8 if top < 1 << 8 else np.uint16 if top < 1 << 16 else np.int32)


def _blocks_of(batches: Iterator[pa.RecordBatch], known: Hashed, idfs: np.ndarray) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lists = batch.column("found")
        sizes, h, c = list_parts(lists)
        ends = np.append(0, np.cumsum(sizes))
        y, part = batch.column("y").to_numpy(), batch.column("part").to_numpy()
        for start, stop in pieces(sizes, TOKENS_PER_BLOCK):
            some = slice(ends[start], ends[stop])
            place = known.places(h[some], c[some])
            row = np.repeat(np.arange(stop - start), sizes[start:stop])[place >= 0]
            row, local, tf, uniq = counted(row, place[place >= 0])
            scale = np.zeros((len(idfs), stop - start))
            for j, idf in enumerate(idfs):
                square = np.bincount(row, (tf * idf[uniq][local]) ** 2, stop - start)
                scale[j] = np.where(square > 0, 1 / np.sqrt(np.where(square > 0, square, 1.0)), 0.0)
            size = np.bincount(row, minlength=stop - start).astype(np.int32)
            local, tf = _small(local), _small(tf)
            numbers = [y[start:stop], part[start:stop].astype(np.int32), size, uniq.astype(np.int32), local, tf, scale]
            yield pa.RecordBatch.from_arrays(
                [pa.array([x.tobytes()], pa.binary()) for x in numbers]
                + [pa.array([local.itemsize], pa.int32()), pa.array([tf.itemsize], pa.int32())],
                [*BINARY, "local_size", "tf_size"],
            )


BINARY = ("y", "part", "size", "uniq", "local", "tf", "scale")
BLOCKS = ", ".join(f"{c} binary" for c in BINARY) + ", local_size int, tf_size int"
KINDS = {1: np.uint8, 2: np.uint16, 4: np.int32}


class _Block:
    def __init__(self, one: dict) -> None:
        raw = {c: one[c].as_buffer() for c in BINARY}
        self.y, self.part = np.frombuffer(raw["y"]), np.frombuffer(raw["part"], np.int32)
        self.size, self.uniq = np.frombuffer(raw["size"], np.int32), np.frombuffer(raw["uniq"], np.int32)
        self.local = np.frombuffer(raw["local"], KINDS[one["local_size"].as_py()]).astype(np.intp)
        self.tf = np.frombuffer(raw["tf"], KINDS[one["tf_size"].as_py()]).astype(float)
        self.scale = np.frombuffer(raw["scale"]).reshape(-1, len(self.y))
        self.held = np.flatnonzero(self.size)
        self.first = (np.cumsum(self.size) - self.size)[self.held]
        self.room = np.empty(len(self.local))  # new arrays of this length cost more than what is done with them

    def margins(self, idf: np.ndarray, w: np.ndarray, b: np.ndarray, t: int) -> np.ndarray:
        """(classes or 1, rows)"""
        out = np.zeros((len(w), len(self.y)))
        if len(self.held):
            for k, one in enumerate(w):
                each = np.take(one[self.uniq] * idf, self.local, out=self.room, mode="clip")
                each *= self.tf
                out[k, self.held] = np.add.reduceat(each, self.first)
        return out * self.scale[t] + b[:, None]

    def back(self, idf: np.ndarray, error: np.ndarray, t: int) -> np.ndarray:
        """The sum of the rows' features times their errors, for the terms in use."""
        each = np.repeat(error * self.scale[t], self.size)
        each *= self.tf
        return np.bincount(self.local, each, len(self.uniq)) * idf


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[_Block]:
    for batch in batches:
        for i in range(len(batch)):
            yield _Block({c: batch.column(c)[i] for c in (*BINARY, "local_size", "tf_size")})


def chances(margins: np.ndarray, classes: int) -> np.ndarray:
    if not classes:
        return np.exp(-np.logaddexp(0.0, -margins))
    e = np.exp(margins - margins.max(axis=0))
    return e / e.sum(axis=0)


def losses(margins: np.ndarray, target: np.ndarray, classes: int) -> np.ndarray:
    if not classes:
        return np.logaddexp(0.0, np.where(target == 1.0, -margins, margins))[0]
    top = margins.max(axis=0)
    return top + np.log(np.exp(margins - top).sum(axis=0)) - (margins * target).sum(axis=0)


def targets(y: np.ndarray, classes: int) -> np.ndarray:
    return (y[None] == np.arange(classes)[:, None]).astype(float) if classes else (y == 1.0)[None].astype(float)


class Rows:
    """Packed rows. ``part`` deals them out: a model may leave one part out. Document counts are
    those of the rows outside of part ``uncounted``. ``terms`` are rules that keep some terms; if they
    keep more than ``most`` there are no blocks."""

    def __init__(
        self, df: DataFrame, text: str, truth: str, terms: Sequence, ngram: tuple[int, int] = (1, 1), analyzer: str = "word",
        part: Column | None = None, uncounted: int = NO_PART, most: int = MOST_WEIGHTS,
    ) -> None:
        self.spark, self.ngram, self.analyzer = df.sparkSession, ngram, analyzer
        self.terms, self.blocks, self.shuffled = list(dict.fromkeys(terms)), None, 0
        dealt = (F.lit(0) if part is None else part).cast("int")
        given = df.select(F.col(text).alias("said"), F.col(truth).cast("double").alias("y"), dealt.alias("part"))
        self.given = given = settled(given, "rows")
        cores = self.spark.sparkContext.defaultParallelism
        if given.rdd.getNumPartitions() < cores:
            given = given.repartition(cores)
        sizes = self.given.groupBy("part", "y").count().collect()
        if any(r.y is None for r in sizes):
            raise ValueError("every row needs a class")
        self.sizes = {(r.part, r.y): r["count"] for r in sizes}
        self.n_fit = sum(n for (p, _), n in self.sizes.items() if p != uncounted)
        found = F.expr(terms_sql(analyzer, ngram, "`said`"))
        held = given.filter(F.col("part") != uncounted).select(F.explode(F.array_distinct(found)).alias("term"))
        kept = [(F.col("df") >= max(1, t.min_df)) & (F.col("df") <= (t.max_df * self.n_fit if t.max_df < 1 else self.n_fit)) for t in self.terms]
        some = kept[0]
        for one in kept[1:]:
            some = some | one
        self.words = settled(held.groupBy("term").agg(F.count("*").alias("df")).filter(some), "words")
        self.v = self.words.count()
        if self.v > most:
            return
        self.known, self.salt, table = hashed(self.words, "term", "df")
        self.df = table.column("df").to_numpy()[self.known.order]
        self.idf = np.array([t.idf(self.df, self.n_fit) for t in self.terms])
        sent = self.spark.sparkContext.broadcast((self.known, self.idf))
        self.sent = sent
        packed = given.select(hashed_terms(found, self.salt).alias("found"), "y", "part").mapInArrow(
            lambda it: _blocks_of(it, *sent.value), BLOCKS
        )
        self.blocks = settled(packed, "blocks")
        discard(self.given)

    def discard(self) -> None:
        discard(self.given, self.words, *([] if self.blocks is None else [self.blocks]))
        if self.blocks is not None:
            self.sent.destroy()

    def dealt(self) -> DataFrame:
        """The blocks in as many parts as there are cores: each sums all that it has."""
        return self.blocks.coalesce(max(1, self.spark.sparkContext.defaultParallelism))

    def slopes(self, asked: Sequence[tuple[Fit, np.ndarray]]) -> list[tuple[float, np.ndarray]]:
        """(sum of the losses, sum of their gradients) of every model at its weights, intercepts last."""
        known = self.sent
        v = self.v
        shapes = [(f.m, f.classes, f.t, f.out) for f, _ in asked]
        sent = self.spark.sparkContext.broadcast([x for _, x in asked])
        widths = np.cumsum([0] + [len(x) + 1 for _, x in asked])

        def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums, idfs = None, known.value[1]
            for block in _blocks(batches):
                sums = np.zeros(widths[-1]) if sums is None else sums
                for (m, classes, t, out), x, at in zip(shapes, sent.value, widths):
                    idf = idfs[t][block.uniq]
                    margins = block.margins(idf, x[: m * v].reshape(m, v), x[m * v :], t)
                    target, use = targets(block.y, classes), block.part != out
                    error = np.where(use, chances(margins, classes) - target, 0.0)
                    sums[at] += losses(margins, target, classes)[use].sum()
                    for k in range(m):
                        sums[at + 1 + k * v + block.uniq] += block.back(idf, error[k], t)
                    sums[at + 1 + m * v : at + 1 + m * v + m] += error.sum(axis=1)
            if sums is not None:
                for k, start in enumerate(range(0, len(sums), NUMBERS_PER_CHUNK)):
                    piece = sums[start : start + NUMBERS_PER_CHUNK]
                    if piece.any():
                        yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([piece.tobytes()], pa.binary())], ["chunk", "part"])

        total = int(widths[-1])
        chunks, cores = max(1, math.ceil(total / NUMBERS_PER_CHUNK)), self.spark.sparkContext.defaultParallelism
        partial = self.dealt().mapInArrow(parts, "chunk int, part binary")
        whole = partial.repartition(min(chunks, cores), "chunk").mapInArrow(_added, "chunk int, part binary")
        found = np.zeros(total)
        for r in whole.toLocalIterator() if chunks > 64 else whole.collect():
            piece = np.frombuffer(r.part)
            found[r.chunk * NUMBERS_PER_CHUNK : r.chunk * NUMBERS_PER_CHUNK + len(piece)] = piece
        sent.destroy()
        self.shuffled += 8 * total * cores
        if self.shuffled > SHUFFLED_AT_MOST:  # shuffle files go when the driver finds that nothing needs them
            del whole, partial
            gc.collect()
            self.spark.sparkContext._jvm.System.gc()
            self.shuffled = 0
        return [(found[a], found[a + 1 : b]) for a, b in zip(widths, widths[1:])]

    def judged(self, fits: Sequence[Fit]) -> list[tuple[int, int, int, int]]:
        """(true positives, false positives, false negatives, true negatives) of two-class models on the
        part that each leaves out."""
        done: list[tuple[int, int, int, int]] = []
        known, v = self.sent, self.v
        at_once = max(1, PASS_WEIGHTS // max(1, v))
        for start in range(0, len(fits), at_once):
            some = fits[start : start + at_once]
            shapes = [(f.t, f.out) for f in some]
            sent = self.spark.sparkContext.broadcast([np.array(f.x) for f in some])

            def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
                sums = np.zeros((len(shapes), 4), np.int64)
                for block in _blocks(batches):
                    truth = block.y == 1.0
                    for j, ((t, out), x) in enumerate(zip(shapes, sent.value)):
                        said = block.margins(known.value[1][t][block.uniq], x[None, :v], x[v:], t)[0] > 0
                        rest = block.part == out
                        sums[j] += [int((rest & a & b).sum()) for a, b in ((said, truth), (said, ~truth), (~said, truth), (~said, ~truth))]
                yield pa.RecordBatch.from_arrays([pa.array(range(len(shapes)), pa.int32()), *map(pa.array, sums.T)], ["j", "a", "b", "c", "d"])

            partial = self.dealt().mapInArrow(parts, "j int, a long, b long, c long, d long")
            rows = {r.j: r for r in partial.groupBy("j").agg(*[F.sum(x).alias(x) for x in "abcd"]).collect()}
            done += [(rows[j].a, rows[j].b, rows[j].c, rows[j].d) for j in range(len(some))]
            sent.destroy()
        return done

    def weights(self, fit: Fit) -> DataFrame:
        """(term, df, idf, weights): the weights of the terms that the model keeps, one per class."""
        known, salt, n_fit, terms = self.sent, self.salt, self.n_fit, self.terms[fit.t]
        sent = self.spark.sparkContext.broadcast(np.array(fit.x[: fit.m * self.v]).reshape(fit.m, self.v))

        def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                df = batch.column("df").to_numpy()
                at = known.value[0].places(batch.column("h").to_numpy(), batch.column("c").to_numpy())
                keep = np.flatnonzero(terms.kept(df, n_fit))
                w = sent.value[:, at[keep]]
                lists = pa.FixedSizeListArray.from_arrays(pa.array(w.T.ravel()), len(w)).cast(pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("term").take(pa.array(keep)), pa.array(df[keep]), pa.array(terms.idf(df[keep], n_fit)), lists],
                    ["term", "df", "idf", "weights"],
                )

        keyed = self.words.select("term", "df", F.xxhash64("term", F.lit(salt)).alias("h"), F.hash("term").alias("c"))
        table = settled(keyed.mapInArrow(found, "term string, df long, idf double, weights array<double>"), "weights")
        sent.destroy()
        return table


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


def vectors(n: int, size: int) -> np.ndarray:
    """Room for n vectors, in a file that has no name if they are long."""
    if n * size <= 1 << 20:
        return np.zeros((n, size))
    with tempfile.TemporaryFile() as f:
        return np.memmap(f, float, "w+", shape=(n, size))


class Fit:
    """One model on its way to the optimum: mean loss of the rows outside of part ``out`` plus
    |w|^2 / (2 C n), the intercept without penalty."""

    def __init__(self, rows: Rows, c: float, t: int, tol: float, max_iter: int, classes: int = 0, out: int = NO_PART) -> None:
        self.t, self.out, self.classes, self.m = t, out, classes, classes or 1
        self.tol, self.left, self.v = tol, max_iter, rows.v
        by_class: dict[float, int] = {}
        for (part, y), n in rows.sizes.items():
            if part != out:
                by_class[y] = by_class.get(y, 0) + n
        self.n = sum(by_class.values())
        self.penalty = 1.0 / (c * max(1, self.n))
        shares = np.array([by_class.get(float(k), 0) / max(1, self.n) for k in range(classes or 2)])
        if not classes:
            if not 0 < shares[1] < 1:
                raise ValueError("both classes are needed")
            self.b = np.array([math.log(shares[1] / shares[0])])
        else:
            self.b = np.log(np.maximum(shares, 0.01 / max(1, self.n)))
            self.b -= self.b.mean()
        self.size = self.m * self.v + self.m
        self.held = None

    def begin(self) -> None:
        """x: weights, then intercepts; g: gradient; d: direction; steps and changes of the gradient."""
        self.held = vectors(3 + 2 * HISTORY, self.size)
        self.x, self.g, self.d = self.held[0], self.held[1], self.held[2]
        self.x[self.m * self.v :] = self.b
        self.value, self.a, self.used, self.tries, self.small, self.done = None, 0.0, 0, 0, 0, self.left <= 0

    def end(self) -> None:
        x, self.held = np.array(self.x), None
        self.g = self.d = None
        self.x = vectors(1, self.size)[0]
        self.x[:] = x

    def asked(self) -> np.ndarray:
        return np.array(self.x) if self.value is None else self.x + self.a * self.d

    def told(self, loss: float, slope: np.ndarray) -> None:
        """Loss and gradient at the point that was asked for."""
        end = self.m * self.v
        at, g = self.asked(), slope / self.n
        g[:end] += self.penalty * at[:end]
        value = loss / self.n + self.penalty / 2 * float(at[:end] @ at[:end])
        if self.value is None:
            self.g[:], self.value = g, value
            self._turn()
            return
        along = float(g @ self.d)
        self.tries += 1
        if not value <= self.value + 1e-4 * self.a * self.along:
            # The step that a cubic through both points finds, or the end if rounding is all there is.
            if self.tries >= 20 or abs(self.a * self.along) <= 1e-14 * abs(self.value):
                self.done = True
                return
            z = 3 * (self.value - value) / self.a + self.along + along
            root = math.sqrt(max(0.0, z * z - self.along * along))
            new = self.a * (1 - (along + root - z) / (along - self.along + 2 * root)) if along - self.along + 2 * root else self.a / 2
            self.a = min(max(new, 0.1 * self.a), 0.9 * self.a) if math.isfinite(new) else self.a / 2
            return
        self.left -= 1
        s, change = at - self.x, g - self.g
        if float(s @ change) > 0:
            place = self.used % HISTORY
            self.held[3 + place], self.held[3 + HISTORY + place] = s, change
            self.used += 1
        gain = self.value - value
        self.small = self.small + 1 if gain <= self.tol * abs(value) else 0
        self.x[:], self.g[:], self.value = at, g, value
        # One small step may be a bad one; for a loose bound it is the end.
        self.done = self.left <= 0 or self.small >= (2 if self.tol < 1e-6 else 1)
        if not self.done:
            self._turn()

    def _turn(self) -> None:
        d, last = -np.array(self.g), range(max(0, self.used - HISTORY), self.used)
        alphas = {}
        for i in reversed(last):
            s, y = self.held[3 + i % HISTORY], self.held[3 + HISTORY + i % HISTORY]
            alphas[i] = float(s @ d) / float(s @ y)
            d -= alphas[i] * y
        if self.used:
            s, y = (self.held[at + (self.used - 1) % HISTORY] for at in (3, 3 + HISTORY))
            d *= float(s @ y) / float(y @ y)
        else:
            d /= max(1e-300, float(np.sqrt(d @ d)))
        for i in last:
            s, y = self.held[3 + i % HISTORY], self.held[3 + HISTORY + i % HISTORY]
            d += (alphas[i] - float(y @ d) / float(s @ y)) * s
        self.d[:], self.along = d, float(self.g @ d)
        self.a, self.tries = 1.0, 0
        if not self.along < 0:
            self.done = True


def run(rows: Rows, fits: Sequence[Fit]) -> None:
    """All models to their optimum; those that are on the way share each pass, and when one ends
    the next begins."""
    waiting, active = list(reversed(fits)), []
    while waiting or active:
        while waiting and (not active or sum(f.size for f in active) + waiting[-1].size <= PASS_WEIGHTS):
            active.append(waiting.pop())
            active[-1].begin()
        asked = [(f, f.asked()) for f in active if not f.done]
        if asked:
            for (f, _), (loss, slope) in zip(asked, rows.slopes(asked), strict=True):
                f.told(loss, slope)
        for f in active:
            if f.done:
                f.end()
        active = [f for f in active if not f.done]
