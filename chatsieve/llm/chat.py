"""Conversations as training text with loss flags.

A declarative template names the control strings that open and close the turns of each
role. A finite-state machine over roles validates the order of turns while rows stream
by, one turn at a time; it emits text segments, of which those of the trained roles
carry the loss flag. Control strings inside texts are escaped reversibly.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Template:
    """``marks``: role -> (open, close). Any other role is written between ``named`` strings,
    followed by its text and ``closing``. ``follows``: the roles that may come after a
    role ("" is the start); ``trained``: the roles whose texts are learnt."""

    marks: dict[str, tuple[str, str]]
    named: tuple[str, str]
    closing: str
    follows: dict[str, tuple[str, ...]]
    trained: tuple[str, ...] = ("assistant",)
    controls: tuple[str, ...] = field(init=False)

    def __post_init__(self) -> None:
        found = {c for pair in self.marks.values() for c in pair} | {*self.named, self.closing}
        for a in found:
            if len(a) < 2 or "\\" in a:
                raise ValueError(f"control string {a!r} is too short or holds a backslash")
            for b in found:
                if a != b and a in b or any(b.startswith(a[-k:]) for k in range(1, min(len(a), len(b)))):
                    raise ValueError(f"control strings {a!r} and {b!r} overlap")
        object.__setattr__(self, "controls", tuple(sorted(found)))

    def escape(self, text: str) -> str:
        """A backslash goes after the first character of every control string, also of one
        that has backslashes there already, so that it can be taken back."""
        return self._pattern(r"\\*").sub(lambda m: m[0][0] + "\\" + m[0][1:], text)

    def unescape(self, text: str) -> str:
        return self._pattern(r"\\+").sub(lambda m: m[0][0] + m[0][2:], text)

    def _pattern(self, slashes: str) -> re.Pattern:
        return re.compile("|".join(re.escape(c[0]) + slashes + re.escape(c[1:]) for c in self.controls))


INSTRUCT = Template(
    marks={"user": ("[INST]", "[/INST]"), "assistant": ("<s>", "</s>"), "system": ("<<SYS>>", "<</SYS>>")},
    named=("{{ROLE}}", "{{/ROLE}}"),
    closing="{{END}}",
    follows={"": ("system", "user"), "system": ("user",), "user": ("assistant",), "assistant": ("user",)},
)
_TURNS = "conv_id long, turn long, role string, text string"
_SEGMENTS = "conv_id long, segment long, text string, loss boolean, valid boolean"
_SEGMENT_TYPES = [pa.int64(), pa.int64(), pa.string(), pa.bool_(), pa.bool_()]


def _segment_batches(batches: Iterator[pa.RecordBatch], template: Template):
    conv, state, at, valid = object(), "", 0, True
    for batch in batches:
        out = []
        for conv_id, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "role", "text")), strict=True):
            if conv_id != conv:
                conv, state, at, valid = conv_id, "", 0, True
            valid = valid and role in template.follows.get(state, ())
            state = role
            if role in template.marks:
                opening, closing = template.marks[role]
                parts = [opening]
            else:
                closing = template.closing
                parts = [template.named[0], template.escape(role), template.named[1]]
            for k, part in enumerate([*parts, template.escape(text), closing]):
                out.append((conv_id, at, part, k == len(parts) and role in template.trained, valid))
                at += 1
        if out:
            columns = zip(*out, strict=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(x), t) for x, t in zip(columns, _SEGMENT_TYPES, strict=True)],
                ["conv_id", "segment", "text", "loss", "valid"],
            )


def format_conversations(turns: DataFrame, template: Template = INSTRUCT) -> DataFrame:
    """(conv_id, segment, text, loss, valid): the segments of every conversation in order.

    ``valid`` stays true up to the first turn that the machine does not allow; later turns
    are formatted all the same. Rows go in the order of turn, then role and text (which
    settles ties and repeated rows). A NULL role or text reads as empty, a NULL turn comes
    first, and rows with a NULL id form one conversation. An empty text is an empty
    segment. Other columns are not looked at. A conversation is streamed, never held.
    """
    given = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    ordered = given.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return ordered.mapInArrow(lambda it: _segment_batches(it, template), _SEGMENTS)


class _Digest:
    def __init__(self, conv_id) -> None:
        self.conv_id, self.turns, self.loss_chars, self.chars, self.valid = conv_id, 0, 0, 0, True
        self.turn_hash, self.loss_hash = hashlib.sha256(), hashlib.sha256()

    def row(self):
        return (
            self.conv_id, self.turns, self.turn_hash.hexdigest(), self.loss_chars, self.loss_hash.hexdigest(), self.chars, self.valid,
        )


def _digest_batches(batches: Iterator[pa.RecordBatch], template: Template):
    """Reads the formatted text back: roles from the control strings, texts unescaped."""
    opens = {pair[0]: role for role, pair in template.marks.items()}
    closes = {pair[1] for pair in template.marks.values()} | {template.closing}
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "valid"]
    types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.bool_()]
    here, inside = None, False
    for batch in batches:
        out = []
        for conv_id, text, loss, valid in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "text", "loss", "valid")), strict=True):
            if here is None or conv_id != here.conv_id:
                if here:
                    out.append(here.row())
                here, inside = _Digest(conv_id), False
            here.chars += len(text)
            here.valid = here.valid and valid
            if not inside and text in opens:
                here.turn_hash.update(f"{opens[text]}\n".encode())
                inside = True
            elif not inside and text == template.named[0]:
                pass
            elif not inside and text == template.named[1]:
                here.turn_hash.update(b"\n")
                inside = True
            elif inside and text in closes:
                here.turn_hash.update(b"\n")
                here.turns += 1
                inside = False
            else:
                plain = template.unescape(text)
                here.turn_hash.update(plain.encode())
                if loss:
                    here.loss_chars += len(plain)
                    here.loss_hash.update(plain.encode())
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(list(x), t) for x, t in zip(zip(*out, strict=True), types, strict=True)], names)
    if here:
        yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(here.row(), types, strict=True)], names)


def read_back(segments: DataFrame, template: Template = INSTRUCT) -> DataFrame:
    """(conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, valid) from the
    segments alone, streamed in order."""
    ordered = segments.repartition("conv_id").sortWithinPartitions("conv_id", "segment")
    return ordered.mapInArrow(
        lambda it: _digest_batches(it, template),
        "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, valid boolean",
    )
