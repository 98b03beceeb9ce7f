"""Exact removal of passages that an earlier document already has.

A window is 50 consecutive words of one document; every word of a window whose words
also start somewhere in a document with a smaller id is removed.

1. Each window is named by an anchor, the smallest hash among its 16-word runs. Equal
   windows have equal anchors, and neighbours mostly share one, so a document has about
   one anchor per 18 words. Anchors that only one distinct text has are dropped.
2. Documents with a shared anchor give, for each, the fragment of text its windows cover.
   Equal fragments are collapsed first: all but the one of the smallest id go as a whole.
3. A reference shard is the distinct fragments of one anchor. Its suffix automaton grows
   in the order of ids: each fragment is first streamed through the automaton of all
   smaller ids for its matching statistics, and spans of 50 words or more are removed;
   then it is added. Automata meet their fragments by partition rather than by
   broadcast, since the repeated text of a corpus has no size bound.
4. An anchor with very many distinct fragments (the edge of a passage that stands in
   countless contexts) is dealt by window instead: its shards are single windows, all
   members of which are equal, and are combined before the shuffle.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatsieve.llm.hashing import ngram_hashes, text_chunks, word_hashes, words_of
from chatsieve.llm.tables import settled, texts_of

WINDOW, ANCHOR, SHARD_FRAGMENTS = 50, 16, 2000


def _window_anchors(data: np.ndarray, offsets: np.ndarray, window: int, anchor: int):
    """(start byte and end byte of words, words per row, anchor per window, windows per row)."""
    starts, ends, counts = words_of(data, offsets)
    grams, per_row = ngram_hashes(word_hashes(data, starts, ends), counts, anchor, whole=False)
    low, reach, wide = grams, 1, window - anchor + 1
    while reach < wide:  # smallest of the next ``reach`` runs; doubled up to the window
        step = min(reach, wide - reach)
        low = np.minimum(low, np.append(low[step:], np.full(min(step, len(low)), ~np.uint64(0)))[: len(low)])
        reach += step
    windows = np.maximum(counts - window + 1, 0)
    left = np.repeat(np.cumsum(per_row), per_row) - np.arange(len(grams))
    return starts, ends, counts, low[left >= wide].view(np.int64), windows


def _anchor_batches(batches: Iterator[pa.RecordBatch], window: int, anchor: int):
    for batch in batches:
        for start, data, offsets in text_chunks(batch.column("text")):
            n = len(offsets) - 1
            _, _, _, names, windows = _window_anchors(data, offsets, window, anchor)
            row = np.repeat(np.arange(n), windows)
            order = np.lexsort((names, row))
            names, row = names[order], row[order]
            new = np.ones(len(names), bool)
            new[1:] = (names[1:] != names[:-1]) | (row[1:] != row[:-1])
            lists = pa.ListArray.from_arrays(
                pa.array(np.append(0, np.cumsum(np.bincount(row[new], minlength=n))), pa.int32()), pa.array(names[new])
            )
            part = batch.slice(start, n)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("text_key"), part.column("digest"), lists], ["doc_id", "text_key", "digest", "anchors"]
            )


def _fragment_batches(batches: Iterator[pa.RecordBatch], window: int, anchor: int):
    for batch in batches:
        ids, keys = batch.column("doc_id").to_numpy(), batch.column("text_key").to_numpy()
        wanted = batch.column("anchors")
        for first, data, offsets in text_chunks(batch.column("text")):
            starts, ends, counts, names, windows = _window_anchors(data, offsets, window, anchor)
            raw = data.tobytes()
            word_at = np.append(0, np.cumsum(counts))
            window_at = np.append(0, np.cumsum(windows))
            out: list[tuple] = []
            for row in range(len(counts)):
                mine = names[window_at[row] : window_at[row + 1]]
                shared = np.isin(mine, wanted[first + row].values.to_numpy())
                edge = np.flatnonzero(np.append(True, mine[1:] != mine[:-1])) if len(mine) else []
                for a, b in zip(edge, [*edge[1:], len(mine)], strict=True):
                    if shared[a]:
                        lo, hi = word_at[row] + a, word_at[row] + b - 1 + window - 1
                        words = b" ".join(raw[starts[lo] : ends[hi]].split())
                        out.append((int(mine[a]), int(ids[first + row]), int(keys[first + row]), int(a), int(b - a), hashlib.md5(words).hexdigest(), words.decode()))
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x, t) for x, t in zip(zip(*out, strict=True), _FRAGMENT_TYPES, strict=True)], _FRAGMENT_NAMES
                )


_FRAGMENT = "anchor long, doc_id long, text_key long, start long, windows long, digest string, words string"
_FRAGMENT_NAMES = ["anchor", "doc_id", "text_key", "start", "windows", "digest", "words"]
_FRAGMENT_TYPES = [*[pa.int64()] * 5, pa.string(), pa.string()]


class SuffixAutomaton:
    """Suffix automaton of several word sequences."""

    def __init__(self) -> None:
        self.next: list[dict] = [{}]
        self.link = [-1]
        self.length = [0]

    def add(self, words: list[str]) -> None:
        following, link, length = self.next, self.link, self.length
        last = 0
        for word in words:
            if word in following[last]:
                to = following[last][word]
                last = to if length[to] == length[last] + 1 else self._split(last, word, to)
                continue
            new = len(following)
            following.append({})
            length.append(length[last] + 1)
            at = last
            while at >= 0 and word not in following[at]:
                following[at][word] = new
                at = link[at]
            if at < 0:
                link.append(0)
            else:
                to = following[at][word]
                link.append(0)
                link[new] = to if length[to] == length[at] + 1 else self._split(at, word, to)
            last = new

    def _split(self, at: int, word: str, to: int) -> int:
        copy = len(self.next)
        self.next.append(self.next[to].copy())
        self.length.append(self.length[at] + 1)
        self.link.append(self.link[to])
        self.link[to] = copy
        while at >= 0 and self.next[at].get(word) == to:
            self.next[at][word] = copy
            at = self.link[at]
        return copy

    def statistics(self, words: list[str]) -> Iterator[int]:
        """For each word, the length of the longest match that ends with it."""
        at = matched = 0
        for word in words:
            while at and word not in self.next[at]:
                at = self.link[at]
                matched = self.length[at]
            to = self.next[at].get(word)
            if to is None:
                matched = 0
            else:
                at, matched = to, matched + 1
            yield matched


def _span_batches(batches: Iterator[pa.RecordBatch], window: int):
    """Rows come sorted by anchor and id; one anchor's automaton is held at a time."""
    anchor, doc, automaton, waiting = None, None, None, []
    for batch in batches:
        out: list[tuple[int, int, int, int]] = []
        columns = [batch.column(c).to_pylist() for c in ("anchor", "doc_id", "text_key", "start", "words")]
        for name, doc_id, key, start, text in zip(*columns, strict=True):
            words = text.split(" ")
            if name != anchor:
                anchor, doc, automaton, waiting = name, doc_id, None, []
            elif doc_id != doc:
                automaton = automaton or SuffixAutomaton()
                for held in waiting:
                    automaton.add(held)
                doc, waiting = doc_id, []
            if automaton:
                open_at = None
                for k, matched in enumerate([*automaton.statistics(words), 0]):
                    if matched >= window and open_at is None:
                        open_at = k - window + 1
                    elif matched < window and open_at is not None:
                        out.append((doc_id, key, start + open_at, start + k))
                        open_at = None
            waiting.append(words)
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*out, strict=True)], ["doc_id", "text_key", "lo", "hi"])


def _window_batches(batches: Iterator[pa.RecordBatch], window: int):
    for batch in batches:
        out = []
        for doc_id, text_key, start, text in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text_key", "start", "words")), strict=True):
            words = text.split(" ")
            for k in range(len(words) - window + 1):
                key = hashlib.md5(" ".join(words[k : k + window]).encode()).digest()
                out.append((int.from_bytes(key[:8], "little", signed=True), int.from_bytes(key[8:], "little", signed=True), doc_id, text_key, start + k))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*out, strict=True)], ["h1", "h2", "doc_id", "text_key", "lo"])


def repeated_spans(
    docs: DataFrame, window: int = WINDOW, anchor: int = ANCHOR, shard_fragments: int = SHARD_FRAGMENTS
) -> DataFrame:
    """(doc_id, text_key, lo, hi, copy): word spans [lo, hi) to remove; text_key is the xxhash64 of the
    text, which tells apart rows that repeat an id. ``copy`` marks a row whose whole text an
    earlier document has (no span is listed for it)."""
    given = texts_of(docs).where("doc_id IS NOT NULL").withColumn("text_key", F.xxhash64("text"))
    named = given.select("doc_id", "text", "text_key", F.md5("text").alias("digest")).mapInArrow(
        lambda it: _anchor_batches(it, window, anchor), "doc_id long, text_key long, digest string, anchors array<long>"
    )
    named = settled(named.where(F.size("anchors") > 0), "anchors")
    first = named.groupBy("digest").agg(F.min("doc_id").alias("first_id"))
    leads = named.join(first, "digest")
    copies = leads.where("doc_id > first_id").select("doc_id", "text_key").distinct()
    each = leads.where("doc_id = first_id").select("doc_id", "text_key", F.explode("anchors").alias("anchor"))
    shared = each.groupBy("anchor").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")).where("lo < hi")
    lists = each.join(shared.select("anchor"), "anchor", "left_semi").groupBy("doc_id", "text_key")
    lists = lists.agg(F.collect_set("anchor").alias("anchors"))
    fragments = given.join(lists, ["doc_id", "text_key"]).mapInArrow(
        lambda it: _fragment_batches(it, window, anchor), _FRAGMENT
    )
    fragments = settled(fragments, "fragments")
    lead = fragments.groupBy("anchor", "digest").agg(F.min("doc_id").alias("lead"))
    led = fragments.join(lead, ["anchor", "digest"])
    end = F.col("start") + F.col("windows") + window - 1
    spans = led.where("doc_id > lead").select("doc_id", "text_key", F.col("start").alias("lo"), end.alias("hi"))
    crowd = lead.groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1")
    led = led.where("doc_id = lead").select("anchor", "doc_id", "text_key", "start", "words")
    usual = led.join(crowd.where(F.col("n") <= shard_fragments), "anchor", "left_semi")
    usual = usual.repartition("anchor").sortWithinPartitions("anchor", "doc_id", "start")
    spans = spans.union(usual.mapInArrow(lambda it: _span_batches(it, window), "doc_id long, text_key long, lo long, hi long"))
    crowded = led.join(crowd.where(F.col("n") > shard_fragments), "anchor", "left_semi").mapInArrow(
        lambda it: _window_batches(it, window), "h1 long, h2 long, doc_id long, text_key long, lo long"
    )
    crowded = settled(crowded, "windows")
    lead = crowded.groupBy("h1", "h2").agg(F.min("doc_id").alias("lead"), F.max("doc_id").alias("last")).where("lead < last")
    again = crowded.join(lead, ["h1", "h2"]).where("doc_id > lead")
    spans = spans.union(again.select("doc_id", "text_key", "lo", F.col("lo") + window))
    return spans.select("doc_id", "text_key", "lo", "hi", F.lit(False).alias("copy")).union(
        copies.select("doc_id", "text_key", F.lit(0).cast("long"), F.lit(0).cast("long"), F.lit(True))
    )


def _kept_batches(batches: Iterator[pa.RecordBatch], with_text: bool, with_key: bool):
    for batch in batches:
        out = []
        for doc_id, text, spans, copy in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "spans", "copy")), strict=True):
            words = text.encode().split()
            kept = words
            if copy:
                kept = []
            elif spans:
                keep, stop = [], 0
                for span in sorted((s["lo"], s["hi"]) for s in spans):
                    if span[0] > stop:
                        keep += words[stop : span[0]]
                    stop = max(stop, span[1])
                kept = keep + words[stop:]
            joined = b" ".join(kept)
            shown = (text if len(kept) == len(words) else joined.decode()) if with_text else None
            out.append((doc_id, len(words), len(words) - len(kept), hashlib.sha256(joined).hexdigest(), shown))
        types = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string()]
        columns = zip(*out, strict=True) if out else [[]] * 5
        arrays, names = [pa.array(list(x), t) for x, t in zip(columns, types, strict=True)], ["doc_id", "n_words", "n_removed", "kept_sha256", "kept"]
        if with_key:
            arrays, names = [*arrays, batch.column("text_key")], [*names, "text_key"]
        yield pa.RecordBatch.from_arrays(arrays, names)


def dedup_substrings(
    docs: DataFrame, window: int = WINDOW, anchor: int = ANCHOR, shard_fragments: int = SHARD_FRAGMENTS, with_text: bool = True,
    with_key: bool = False,
) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256, kept) per row of ``docs``; ``with_key``
    adds text_key, the xxhash64 of the text as it was.

    ``kept`` is the text as it was where nothing went, else the kept words joined by one
    space (NULL without ``with_text``). NULL and empty texts have no words. Rows that
    repeat an id take nothing from each other and lose each its own words; a row with a
    NULL id keeps all its words and takes none from others. Other columns are not looked
    at; an empty table gives no rows. A long text is taken whole, in one piece.
    """
    spans = repeated_spans(docs, window, anchor, shard_fragments)
    per_doc = spans.groupBy("doc_id", "text_key").agg(
        F.collect_set(F.when(~F.col("copy"), F.struct("lo", "hi"))).alias("spans"), F.max("copy").alias("copy")
    )
    rows, schema = texts_of(docs), "doc_id long, n_words long, n_removed long, kept_sha256 string, kept string"
    if with_key:
        schema += ", text_key long"
    return rows.withColumn("text_key", F.xxhash64("text")).join(per_doc, ["doc_id", "text_key"], "left").mapInArrow(lambda it: _kept_batches(it, with_text, with_key), schema)
