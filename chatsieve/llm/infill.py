"""Fill-in-the-middle texts by repeated-capture matching.

One full match of ``(unit)*`` keeps every repetition of its group. The list of their ends
is the number of units and both cut offsets at once; no loop walks over the text. Which
form a text takes and where it is cut follows from a hash of its id alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chatsieve.llm.tables import texts_of

PREFIX, SUFFIX, MIDDLE = SENTINELS = ("<P>", "<S>", "<M>")
CODE_POINT = r"(?s:.)"
FLUSH_CHARS = 4 << 20
_NAMES = ["doc_id", "n", "form", "prefix_units", "middle_units", "prefix_chars", "middle_chars", "output"]
_TYPES = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string()]
_SCHEMA = (
    "doc_id long, n long, form string, prefix_units long, middle_units long, prefix_chars long, middle_chars long, output string"
)


def checked_sentinels(sentinels: tuple[str, str, str]) -> tuple[str, str, str]:
    """Three control strings that can be found again between texts that hold none of them:
    no end of one begins another."""
    if len(set(sentinels)) != 3 or not all(sentinels):
        raise ValueError("three different control strings are needed")
    for a in sentinels:
        for b in sentinels:
            if (a != b and a in b) or any(b.startswith(a[-k:]) for k in range(1, min(len(a), len(b)))):
                raise ValueError(f"control strings {a!r} and {b!r} overlap")
    return sentinels


def draws(doc_id: Column, seed: int) -> Column:
    """Four unsigned 32-bit numbers from the hash of ``seed:doc_id``; a NULL id reads as empty."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    return F.array(*[F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long") for k in range(4)])


def _cut(text: str, h: list[int], unit: regex.Pattern, sentinels: tuple, cut_percent: int, suffix_first_percent: int):
    match = unit.fullmatch(text)
    if match is None:
        return None, "plain", None, None, None, None, text
    ends = match.ends(1)
    n = len(ends)
    if not text or h[2] % 100 >= cut_percent or any(s in text for s in sentinels):
        return n, "plain", None, None, None, None, text
    low, high = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    a, b = (ends[k - 1] if k else 0 for k in (low, high))
    prefix, suffix, middle = sentinels
    if h[3] % 100 < suffix_first_percent:
        form, output = "spm", f"{suffix}{text[b:]}{prefix}{text[:a]}{middle}{text[a:b]}"
    else:
        form, output = "psm", f"{prefix}{text[:a]}{suffix}{text[b:]}{middle}{text[a:b]}"
    return n, form, low, high - low, a, b - a, output


def _infill_batches(batches: Iterator[pa.RecordBatch], unit: str, *options) -> Iterator[pa.RecordBatch]:
    compiled = regex.compile(f"({unit})*")
    out: list[tuple] = []
    size = 0

    def flushed() -> pa.RecordBatch:
        columns = zip(*out, strict=True)
        return pa.RecordBatch.from_arrays([pa.array(list(x), t) for x, t in zip(columns, _TYPES, strict=True)], _NAMES)

    for batch in batches:
        for doc_id, text, h in zip(*(batch.column(c) for c in ("doc_id", "text", "h")), strict=True):
            text = text.as_py()
            out.append((doc_id.as_py(), *_cut(text, h.as_py(), compiled, *options)))
            size += len(text)
            if size >= FLUSH_CHARS:
                yield flushed()
                out, size = [], 0
    if out:
        yield flushed()


def fill_in_middle(
    docs: DataFrame,
    unit: str = CODE_POINT,
    seed: int = 1,
    cut_percent: int = 90,
    suffix_first_percent: int = 20,
    sentinels: tuple[str, str, str] = SENTINELS,
) -> DataFrame:
    """(doc_id, n, form, prefix_units, middle_units, prefix_chars, middle_chars, output), one row
    per document, each text by itself and with no shuffle.

    ``unit`` is a pattern (of the ``regex`` library, without groups); texts are cut between
    its repetitions only. ``psm`` is prefix, suffix, middle, ``spm`` has the suffix first,
    ``plain`` is the text itself, with NULL counts: an empty text, one that holds a control
    string (so that ``restored`` is exact), one outside ``cut_percent``, and one that is not
    made of units (whose ``n`` is NULL). NULL text reads as empty, a NULL id hashes as an
    empty one, rows that repeat give a row each, and rows of one id are cut by the same
    draws. Other columns are not looked at; an empty table gives no rows. The match holds
    about 100 bytes per unit of the one text at hand.
    """
    options = (unit, checked_sentinels(tuple(sentinels)), cut_percent, suffix_first_percent)
    given = texts_of(docs).withColumn("h", draws(F.col("doc_id"), seed))
    return given.mapInArrow(lambda it: _infill_batches(it, *options), _SCHEMA)


def restored(output: Column, form: Column, sentinels: tuple[str, str, str] = SENTINELS) -> Column:
    """The text that a form was made of, as a native expression on the output alone."""
    prefix, suffix, middle = checked_sentinels(tuple(sentinels))

    def after(mark: str) -> Column:
        return F.substring(output, F.locate(mark, output) + len(mark), F.char_length(output))

    def until(rest: Column, mark: str) -> Column:
        return F.left(rest, F.locate(mark, rest) - 1)

    psm = F.concat(until(after(prefix), suffix), after(middle), until(after(suffix), middle))
    spm = F.concat(until(after(prefix), middle), after(middle), until(after(suffix), prefix))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)
