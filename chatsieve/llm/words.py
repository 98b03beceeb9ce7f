"""Lower-case words as a native array column."""

from __future__ import annotations

import string

from pyspark.sql import Column
from pyspark.sql import functions as F

GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def ascii_words(text: str) -> Column:
    """Runs of letters, digits and characters beyond ASCII, with A-Z in lower case, in one split.
    A text that begins or ends with a gap (and an empty or NULL one) has an empty piece
    at that end, which callers leave out of account."""
    plain = F.coalesce(F.col(text), F.lit(""))
    low = F.translate(plain, string.ascii_uppercase, string.ascii_lowercase)
    # The quicker function does the same where all characters are ASCII.
    return F.split(F.when(F.char_length(plain) == F.octet_length(plain), F.lower(plain)).otherwise(low), GAP)
