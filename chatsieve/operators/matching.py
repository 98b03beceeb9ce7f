"""Where the entries of a word list of any size stand in a text.

A text is a row of units: in ``boundary`` mode its words and what stands between them, in
``substring`` mode its characters. An entry is a row of units too, and it matches where the
text's units equal its own, so a match is a look-up of a window of units and needs no
pattern. Windows of several units are looked at only where the first unit (or the first
characters) begins an entry. A short list is written into the expression as hash sets; a
longer one is joined.

Of the matches that start at one place the longest counts, and matches are taken from
left to right without overlap, whatever the order of the list. Matching is on folded text;
units of the folded text and of the text itself correspond one to one.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from functools import reduce
from itertools import groupby
from weakref import WeakSet

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StructField, StructType
from pyspark.sql.window import Window

from chatsieve.functions.patterns import WORD_CHAR, clean_words, fold, folded, is_word_char
from chatsieve.functions.text import char_ngram_array
from chatsieve.operators.hashed import hashed, pieces
from chatsieve.operators.skew import join_lookup, settled, text_parts

# A list of up to this many entries is written into the expression: a look-up in a hash set
# per window, and no shuffle. A larger one is joined.
ROW_LOCAL_WORDS = 20_000

# Phrases of up to this many units are cut out of a text by a pattern.
SHORT_PHRASE = 5

HITS = "array<struct<at:int,k:int>>"
PLACED = ArrayType(StructType([StructField(x, IntegerType()) for x in ("at", "k", "start")]))
# Up to so many entries are sent to every task as hashes; longer lists are joined.
HASHED_ENTRIES = 1 << 24
WINDOWS_AT_ONCE = 1 << 20
# Groups of overlapping hits that are settled together.
RUNS_AT_ONCE = 32
_long: WeakSet[DataFrame] = WeakSet()


def unit_array(text: Column, mode: str) -> Column:
    """The units of a text; joined they are the text again."""
    if mode == "boundary":
        return F.regexp_extract_all(text, F.lit(f"(?s){WORD_CHAR}+|(?:(?!{WORD_CHAR}).)+"), F.lit(0))
    if mode == "substring":
        return F.split(text, "")
    raise ValueError(f"mode must be 'boundary' or 'substring', not {mode!r}")


def n_units(word: str, mode: str) -> int:
    return len(word) if mode == "substring" else len(list(groupby(word, is_word_char)))


def listed_words(words: DataFrame) -> DataFrame:
    """The distinct folded, trimmed and non-blank entries of a word table; one that ``as_list``
    has written holds nothing else."""
    if words in _long:
        return words
    word = folded(F.regexp_replace("word", r"^[\s\x{85}\x{a0}]+|[\s\x{85}\x{a0}]+$", "")).alias("word")
    return words.select(word).filter(F.col("word") != "").distinct()


def short_list(words: DataFrame, limit: int) -> list[str] | None:
    """The distinct folded words of a table, or None if there are more than limit."""
    rows = listed_words(words).take(limit + 1)
    return [r["word"] for r in rows] if len(rows) <= limit else None


def as_list(df: DataFrame, words: Iterable[str] | DataFrame) -> list[str] | DataFrame:
    """The folded words as a list if it is short, else as a table that is written once, so that
    no later pass makes the list again."""
    if isinstance(words, DataFrame):
        if words in _long:
            return words
        table = settled(listed_words(words), "listed")
        few = short_list(table, ROW_LOCAL_WORDS)
        if few is not None:
            return clean_words(few)
        _long.add(table)
        return table
    kept = list(dict.fromkeys(map(fold, clean_words(words))))
    if len(kept) <= ROW_LOCAL_WORDS:
        return kept
    return df.sparkSession.createDataFrame([(w,) for w in kept], "word string")


class Windows:
    """The windows of ``k`` units of a folded text that may be an entry."""

    def __init__(self, mode: str, edges: bool, probe: int) -> None:
        self.mode = mode
        self.edges = edges  # some entry begins or ends between words
        self.probe = probe  # characters that are looked at first

    def bound(self, text: Column, make: Callable[[Column], Column]) -> Column:
        """``make`` of the text's units, which are found once."""
        units = unit_array(text, self.mode)
        if self.mode == "boundary":
            parts = [units.alias("u"), text.rlike(f"^{WORD_CHAR}").alias("word_first")]
        else:
            parts = [units.alias("u"), char_ngram_array(text, self.probe).alias("g")]
        return F.transform(F.array(F.struct(*parts)), make)[0]

    def places(self, s: Column, k: int, holds: Callable[[Column], Column]) -> Column:
        """Where (from 0) a window of k units lies as an entry would and ``holds``."""
        n = F.size(s["u"])

        def fits(i: Column) -> Column:
            if self.mode == "substring":
                return holds(i)
            first, last = (((at % 2) == 0) == s["word_first"] for at in (i, i + (k - 1)))
            if self.edges:
                return holds(i) & (first | (i > 0)) & (last | (i + k < n))
            return first & last & holds(i)

        return F.when(n >= k, F.filter(F.sequence(F.lit(0), n - k), fits)).otherwise(F.array().cast("array<int>"))

    def key(self, s: Column, i: Column, k: int) -> Column:
        if self.mode == "substring" and k == self.probe:
            return F.get(s["g"], i)
        return F.get(s["u"], i) if k == 1 else F.array_join(F.slice(s["u"], i + 1, F.lit(k)), "")

    def start(self, s: Column, i: Column) -> Column:
        return F.get(s["g"] if self.mode == "substring" else s["u"], i)

    def start_of(self, word: str) -> str:
        """The part of an entry that ``start`` must equal."""
        return word[: self.probe] if self.mode == "substring" else "".join(next(groupby(word, is_word_char))[1])

    def start_column(self, word: Column) -> Column:
        return F.substring(word, 1, self.probe) if self.mode == "substring" else F.get(unit_array(word, self.mode), 0)

    def found(self, s: Column, k: int, listed: list[str]) -> Column:
        """Places of the listed entries of k units."""
        starts = list(dict.fromkeys(map(self.start_of, listed)))

        def holds(i: Column) -> Column:
            whole = self.key(s, i, k).isin(listed)
            return whole if starts == listed else self.start(s, i).isin(starts) & whole

        return self.places(s, k, holds)


def windows_of(words: Iterable[str], mode: str) -> tuple[Windows, dict[int, list[str]]]:
    """The window rule for a list of folded words, and its entries by number of units."""
    by_size: dict[int, list[str]] = {}
    for w in words:
        by_size.setdefault(n_units(w, mode), []).append(w)
    edges = not all(is_word_char(w[0]) and is_word_char(w[-1]) for ws in by_size.values() for w in ws)
    return Windows(mode, edges, min(by_size)), by_size


def taken(hits: Column, distinct_places: bool) -> Column:
    """Hits (at, -k) from left to right without overlap, the longest first of those at
    one place, as (at, k)."""
    if distinct_places:  # no two can overlap
        return F.transform(hits, lambda h: F.struct(h["at"].alias("at"), (-h["less"]).alias("k")))
    none = F.struct(F.lit(0).alias("free"), F.array().cast(HITS).alias("kept"))

    def step(state: Column, h: Column) -> Column:
        hit = F.struct(h["at"].alias("at"), (-h["less"]).alias("k"))
        more = F.struct((h["at"] - h["less"]).alias("free"), F.concat(state["kept"], F.array(hit)).alias("kept"))
        return F.when(h["at"] >= state["free"], more).otherwise(state)

    return F.aggregate(F.array_sort(hits), none, step, lambda state: state["kept"])


def local_hits(text: Column, words: list[str], mode: str) -> Column:
    """The matches (at, k) of a short list of folded words in a folded text."""
    windows, by_size = windows_of(words, mode)

    def of_units(s: Column) -> Column:
        parts = [
            F.transform(windows.found(s, k, listed), lambda i: F.struct(i.alias("at"), F.lit(-k).alias("less")))
            for k, listed in by_size.items()
        ]
        return taken(F.concat(*parts) if len(parts) > 1 else parts[0], mode == "boundary" and len(parts) == 1 and 1 in by_size)

    return windows.bound(text, of_units)


def local_words(text: Column, words: list[str], mode: str) -> Column:
    """The distinct words of a short list that a folded text holds, each looked for by itself."""
    windows, by_size = windows_of(words, mode)

    def of_units(s: Column) -> Column:
        parts = [F.transform(windows.found(s, k, listed), lambda i: windows.key(s, i, k)) for k, listed in by_size.items()]
        return F.array_distinct(F.concat(*parts) if len(parts) > 1 else parts[0])

    return windows.bound(text, of_units)


def holds_within(text: Column, words: list[str]) -> Column:
    """True where a folded text holds a word of a short list as a run of characters. The places
    where any word may start are found once, and lengths are tried only there, up to the first match."""
    windows, by_size = windows_of(words, "substring")
    starts = {k: list(dict.fromkeys(map(windows.start_of, listed))) for k, listed in sorted(by_size.items())}
    every = list(dict.fromkeys(s for some in starts.values() for s in some))

    def of_units(s: Column) -> Column:
        def begins(i: Column) -> Column:
            tries = [
                windows.start(s, i).isin(starts[k]) & windows.key(s, i, k).isin(by_size[k]) if k > windows.probe
                else windows.start(s, i).isin(by_size[k])
                for k in starts
            ]
            return windows.start(s, i).isin(every) & reduce(lambda a, b: a | b, tries)

        n = F.size(s["g"])
        return F.when(n > 0, F.exists(F.sequence(F.lit(0), n - 1), begins)).otherwise(F.lit(False))

    return windows.bound(text, of_units)


def all_windows(df: DataFrame, words: DataFrame, mode: str, text: str) -> tuple[DataFrame, Column]:
    """(the listed entries of a table, with k; all windows (at, k, word) of a text that may be one).

    Windows of several units begin with a start of the list, or, if there are more than
    ``ROW_LOCAL_WORDS`` of those, with one that the texts and the list have in common; if these
    are still more, all windows of that size are kept.
    """
    listed = listed_words(words).withColumn("k", F.size(unit_array(F.col("word"), mode)))
    ends = F.col("word").rlike(f"^{WORD_CHAR}") & F.col("word").rlike(f"{WORD_CHAR}$")
    sizes = listed.groupBy("k").agg(F.bool_and(ends).alias("inner")).orderBy("k").collect()
    if not sizes:
        raise ValueError("the word list is empty")
    windows = Windows(mode, not all(r.inner for r in sizes), sizes[0].k)
    short = windows.probe if mode == "substring" else 1
    starts = None
    if any(r.k > short for r in sizes):
        every = windows.bound(folded(F.col(text)), lambda s: F.array_distinct(s["g"] if mode == "substring" else s["u"]))
        begun = listed.filter(F.col("k") > short).select(windows.start_column(F.col("word")).alias("start")).distinct()
        rows = begun.take(ROW_LOCAL_WORDS + 1)
        if len(rows) > ROW_LOCAL_WORDS:
            held = df.select(F.explode(every).alias("start")).distinct()
            rows = held.join(begun, "start", "left_semi").take(ROW_LOCAL_WORDS + 1)
        starts = [r.start for r in rows] if len(rows) <= ROW_LOCAL_WORDS else None

    def of_units(s: Column) -> Column:
        parts = []
        for k in (r.k for r in sizes):
            if k == short or starts is None:
                holds = lambda i: F.lit(True)
            elif starts:
                holds = lambda i: windows.start(s, i).isin(starts)
            else:
                continue
            parts.append(
                F.transform(
                    windows.places(s, k, holds),
                    lambda i: F.struct(i.alias("at"), F.lit(k).alias("k"), windows.key(s, i, k).alias("word")),
                )
            )
        empty = F.array().cast("array<struct<at:int,k:int,word:string>>")
        return F.concat(empty, *parts)

    return listed, windows.bound(folded(F.col(text)), of_units)


def short_pieces(words: DataFrame, text: str) -> tuple[Column, DataFrame] | None:
    """(the distinct words of a text and its windows of the sizes of the phrases in a word table; those
    phrases). None if an entry begins or ends between words, or if phrases are long or many.

    A pattern cuts out the words, and for each size the windows that begin at a word; nothing is
    looked at unit by unit.
    """
    listed = listed_words(words).withColumn("k", F.size(unit_array(F.col("word"), "boundary")))
    outer = ~(F.col("word").rlike(f"^{WORD_CHAR}") & F.col("word").rlike(f"{WORD_CHAR}$"))
    sizes = listed.groupBy("k").agg(F.bool_or(outer).alias("outer"), F.count("*").alias("n")).orderBy("k").collect()
    many = sum(r.n for r in sizes if r.k > 1) > ROW_LOCAL_WORDS
    if not sizes or many or any(r.outer or r.k > SHORT_PHRASE for r in sizes):
        return None

    def cut_out(said: Column, k: int) -> Column:
        if k == 1:
            return F.regexp_extract_all(said, F.lit(WORD_CHAR + "+"), F.lit(0))
        window = rf"(?=({WORD_CHAR}++(?:[^\p{{L}}\p{{N}}_]++{WORD_CHAR}++){{{k // 2}}})){WORD_CHAR}++"
        return F.regexp_extract_all(said, F.lit(window), F.lit(1))

    def of_text(said: Column) -> Column:
        parts = [cut_out(said, r.k) for r in sizes]
        return F.array_distinct(F.concat(*parts) if len(parts) > 1 else parts[0])

    return F.transform(F.array(folded(F.col(text))), of_text)[0], listed.filter(F.col("k") > 1).select("word")


def joined_hits(df: DataFrame, words: DataFrame, mode: str, text: str, id_col: str) -> DataFrame:
    """(id, at, k, word): every place of every entry of a word table of any size.

    The windows in use, counted with map-side partial sums, meet the word table first;
    only those go on, with their counts, to the join with the texts.
    """
    listed, windows = all_windows(df, words, mode, text)
    rows = df.select(id_col, F.explode(windows).alias("w")).select(id_col, "w.at", "w.k", "w.word")
    in_use = rows.groupBy("word").count().join(listed, "word", "left_semi")
    parts = text_parts(df, text)
    return join_lookup(rows, in_use, "word", "count", F.struct(id_col, "at"), parts=parts).select(id_col, "at", "k", "word")


def words_within(df: DataFrame, words: DataFrame, text: str, id_col: str) -> DataFrame:
    """(id, word): the entries of a word table that a text holds as a run of characters.

    An entry of word characters alone lies within one word of a text, so it is looked for in
    the distinct words of all texts, and the texts meet their words by equality. Only
    entries with other characters are looked for in windows of the texts themselves.
    """
    listed = listed_words(words)
    inner = F.col("word").rlike(f"^{WORD_CHAR}+$")
    pieces = F.array_distinct(F.regexp_extract_all(folded(F.col(text)), F.lit(WORD_CHAR + "+"), F.lit(0)))
    held = settled(df.select(id_col, pieces.alias("pieces")), "pieces")
    pairs = held.select(id_col, F.explode("pieces").alias("piece"))
    out = []
    single = listed.filter(inner)
    if not single.isEmpty():
        pieces_in_use = settled(pairs.groupBy("piece").count(), "vocabulary")
        _, windows = all_windows(pieces_in_use, single, "substring", "piece")
        inside = pieces_in_use.select("piece", "count", F.explode(F.array_distinct(F.transform(windows, lambda w: w["word"]))).alias("word"))
        found = inside.join(single, "word").groupBy("piece", "count").agg(F.collect_list("word").alias("words"))
        met = join_lookup(pairs, found, "piece", "count", F.col(id_col), parts=text_parts(df, text))
        out.append(met.select(id_col, F.explode("words").alias("word")).distinct())
    other = listed.filter(~inner)
    if not other.isEmpty():
        _, windows = all_windows(df, other, "substring", text)
        rest = df.select(id_col, F.explode(F.array_distinct(F.transform(windows, lambda w: w["word"]))).alias("word"))
        in_use = rest.groupBy("word").count().join(other, "word", "left_semi")
        out.append(join_lookup(rest, in_use, "word", "count", F.col(id_col)).select(id_col, "word"))
    if not out:
        raise ValueError("the word list is empty")
    return out[0] if len(out) == 1 else out[0].union(out[1])


def with_hits(
    df: DataFrame, words: Iterable[str] | DataFrame, mode: str, text: str, id_col: str, out: str = "_hits"
) -> DataFrame:
    """Add the matches (at, k) of every text, NULL for a missing text. The entries of a list above
    ``ROW_LOCAL_WORDS`` are looked up in every task; for a list above ``HASHED_ENTRIES``, rows
    meet their matches by id, which must be unique."""
    listed = as_list(df, words)
    if not isinstance(listed, DataFrame):
        return df.withColumn(out, local_hits(folded(F.col(text)), listed, mode))
    if listed.count() <= HASHED_ENTRIES:
        return looked_up_hits(df, listed, mode, text, out)
    hits = taken_hits(joined_hits(df, listed, mode, text, id_col).repartition(text_parts(df, text), id_col), id_col)
    none = F.when(F.col(text).isNotNull(), F.array().cast(HITS))
    return df.join(hits, id_col, "left").withColumn(out, F.coalesce("_all", none)).drop("_all")


def looked_up_hits(df: DataFrame, words: DataFrame, mode: str, text: str, out: str) -> DataFrame:
    """Add the matches (at, k, start) of a long list in a text, ``start`` being the characters before it.
    Every task has the hashes of the entries, so neither texts nor windows are shuffled."""
    listed, windows = all_windows(df, words, mode, text)
    known, salt, _ = hashed(listed, "word")
    known.order = None
    sent, columns = df.sparkSession.sparkContext.broadcast(known), df.columns

    def found(held: pa.Array, lengths: pa.Array) -> pa.Array:
        sizes, n_units = (np.diff(x.offsets.to_numpy()) for x in (held, lengths))
        ends, unit_ends = (np.append(0, np.cumsum(x)) for x in (sizes, n_units))
        flat = held.flatten()
        at, k, h, c = (flat.field(x).to_numpy() for x in ("at", "k", "h", "c"))
        before = np.append(0, np.cumsum(lengths.flatten().to_numpy()))
        counts, parts = np.zeros(len(sizes), np.int64), []
        for i, j in pieces(sizes, WINDOWS_AT_ONCE):
            some = slice(ends[i], ends[j])
            hit = np.flatnonzero(sent.value.places(h[some], c[some]) >= 0)
            row = np.repeat(np.arange(i, j), sizes[i:j])[hit]
            first, size = at[some][hit], k[some][hit]
            keep = without_overlap(row, first, size)
            row, first, size = row[keep], first[keep], size[keep]
            counts[i:j] = np.bincount(row - i, minlength=j - i)
            parts.append((first, size, before[unit_ends[row] + first] - before[unit_ends[row]]))
        fields = [np.concatenate([np.zeros(0, np.int32), *x]) for x in zip(*parts)] if parts else [np.zeros(0, np.int32)] * 3
        values = pa.StructArray.from_arrays([pa.array(x.astype(np.int32)) for x in fields], ["at", "k", "start"])
        return pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(counts)).astype(np.int32)), values, mask=pc.is_null(lengths))

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hits = found(batch.column("_windows"), batch.column("_lengths"))
            yield pa.RecordBatch.from_arrays([*map(batch.column, columns), hits], [*columns, out])

    hashes = F.transform(
        windows,
        lambda w: F.struct(w["at"].alias("at"), w["k"].alias("k"), F.xxhash64(w["word"], F.lit(salt)).alias("h"), F.hash(w["word"]).alias("c")),
    )
    lengths = F.transform(unit_array(F.col(text), mode), lambda u: F.length(u))
    schema = StructType([*df.schema, StructField(out, PLACED)])
    return df.select("*", hashes.alias("_windows"), lengths.alias("_lengths")).mapInArrow(each, schema)


def without_overlap(row: np.ndarray, at: np.ndarray, k: np.ndarray) -> np.ndarray:
    """``taken`` of the hits of many rows: the indices of those that count, in order."""
    order = np.lexsort((-k, at, row))
    step = int((at + k).max(initial=0)) + 1
    start = (row[order].astype(np.int64) * step) + at[order]
    end = start + k[order]
    reach = np.maximum.accumulate(end)
    begins = np.append(True, start[1:] >= reach[:-1]) if len(start) else np.zeros(0, bool)
    # A hit that no other touches counts; only the others are gone through one by one.
    alone = begins & np.append(begins[1:], True) if len(start) else begins
    keep, free, rest = alone.copy(), -1, np.flatnonzero(~alone)
    for i, s, e in zip(rest.tolist(), start[rest].tolist(), end[rest].tolist()):
        if s >= free:
            keep[i], free = True, e
    return order[keep]


def taken_hits(hits: DataFrame, id_col: str) -> DataFrame:
    """(id, _all): ``taken`` of the hits (id, at, k) of each id, as an array.

    Where a hit begins after the end of all before it, a new run begins, and runs do not
    bear on each other. Some runs at a time are settled, so that the work grows with
    the number of hits and not with its square.
    """
    before = Window.partitionBy(id_col).orderBy("at", F.desc("k"))
    reach = F.max(F.col("at") + F.col("k")).over(before.rowsBetween(Window.unboundedPreceding, -1))
    begins = F.when(reach.isNull() | (F.col("at") >= reach), 1).otherwise(0)
    marked = hits.select(id_col, "at", "k", begins.alias("begins"))
    run = F.sum("begins").over(before.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    chunk = F.floor((run - 1) / RUNS_AT_ONCE).alias("chunk")
    hit = F.struct("at", (-F.col("k")).alias("less"))
    some = marked.select(id_col, "at", "k", chunk).groupBy(id_col, "chunk").agg(F.collect_list(hit).alias("some"))
    kept = some.select(id_col, F.struct("chunk", taken(F.col("some"), False).alias("kept")).alias("part"))
    parts = kept.groupBy(id_col).agg(F.array_sort(F.collect_list("part")).alias("parts"))
    return parts.select(id_col, F.flatten(F.col("parts.kept")).alias("_all"))


def _with_units(text: Column, hits: Column, mode: str, make: Callable[[Column, Column], Column]) -> Column:
    """``make(units, hits)``, both found once."""
    both = F.struct(unit_array(text, mode).alias("u"), hits.alias("h"))
    return F.transform(F.array(both), lambda s: make(s["u"], s["h"]))[0]


def _cut(u: Column, hits: Column, make: Callable[[Column, Column], Column]) -> Column:
    """An array with ``make(text before, matched text)`` for every match, in order; the text
    before a match goes back to the match before it."""

    def piece(h: Column, j: Column) -> Column:
        before = F.get(hits, j - 1)
        start = F.coalesce(before["at"] + before["k"], F.lit(0))
        gap = F.array_join(F.slice(u, start + 1, h["at"] - start), "")
        return make(gap, F.array_join(F.slice(u, h["at"] + 1, h["k"]), ""))

    return F.transform(hits, piece)


def cut(text: Column, hits: Column, mode: str, make: Callable[[Column, Column], Column]) -> Column:
    """``make(text before, matched text)`` of every match as an array."""
    return _with_units(text, hits, mode, lambda u, h: _cut(u, h, make))


def replaced(text: Column, hits: Column, mode: str, make: Callable[[Column], Column]) -> Column:
    """The text with ``make(matched text)`` in place of every match."""

    def whole(u: Column, h: Column) -> Column:
        last = F.get(h, F.size(h) - 1)
        rest = F.array_join(F.slice(u, last["at"] + last["k"] + 1, F.size(u)), "")
        front = F.array_join(_cut(u, h, lambda gap, matched: F.concat(gap, make(matched))), "")
        return F.when(F.size(h) > 0, F.concat(front, rest)).otherwise(F.array_join(u, ""))

    return _with_units(text, hits, mode, whole)
