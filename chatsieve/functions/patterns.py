"""Word lists and the regular expressions made from them.

Word characters are letters, numbers and underscore in any script. The class is
spelled out because the shorthand classes differ between Java versions.
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# The built-in word list.
BASIC_WORDS = ("damn", "hell", "crap", "shit", "fuck", "ass", "bastard", "bitch", "dick")

WORD_CHAR = r"[\p{L}\p{N}_]"
NOT_AFTER_WORD = r"(?<![\p{L}\p{N}_])"
AFTER_WORD = r"(?<=[\p{L}\p{N}_])"
NOT_BEFORE_WORD = r"(?![\p{L}\p{N}_])"
BEFORE_WORD = r"(?=[\p{L}\p{N}_])"

# One alternation is tried word by word at every position, so long lists are cut
# into several patterns that are or-ed together.
WORDS_PER_PATTERN = 500


def clean_words(words: Iterable[str]) -> list[str]:
    """Trimmed, non-blank words in their given order; an empty list is an error."""
    kept = list(dict.fromkeys(w.strip() for w in words if w and w.strip()))
    if not kept:
        raise ValueError("the word list is empty")
    return kept


def is_word_char(ch: str) -> bool:
    return ch == "_" or ch.isalnum()


def fold_table() -> dict[str, str]:
    """Letters whose one-character case fold (upper case, then lower case) is not their
    lower case, like the long s and the final sigma; from the rule, over all letters."""
    out = {}
    for c in map(chr, range(0x80, 0x10000)):
        up = c.upper()
        if len(up) == 1 and c.isalnum() and len(up.lower()) == 1 and up.lower() != c.lower():
            out[c] = up.lower()
    return out | {"\u0130": "i"}


FOLDS = fold_table()
# A character outside of the Latin letters and punctuation whose fold is their lower case.
NOT_PLAIN = r"[^\x{0}-\x{b4}\x{b6}-\x{12f}\x{2000}-\x{206f}]"


def fold(word: str) -> str:
    """The case fold that decides whether two words are the same, whatever the rule mode
    and the length of the list."""
    return "".join(FOLDS.get(c, c.lower() if len(c.lower()) == 1 else c) for c in word)


def folded(text: Column) -> Column:
    """``fold`` of a column; it keeps the number of characters. Of texts of ASCII, or of Latin letters
    and punctuation alone, it is the lower case, which takes a fraction of the time."""
    once = F.lower(F.translate(text, "\u0130", "i"))
    every = F.translate(once, "".join(FOLDS), "".join(FOLDS.values()))
    plain = (F.octet_length(text) == F.char_length(text)) | ~text.rlike(NOT_PLAIN)
    return F.when(plain, F.lower(text)).otherwise(every)


def is_single_token(word: str) -> bool:
    return all(is_word_char(c) for c in word)


def quote(word: str) -> str:
    """The word as a literal inside a Java regular expression."""
    return re.sub(r"([^\w\s])", r"\\\1", word)


def bounded(words: Iterable[str]) -> str:
    """Alternation of whole words.

    A word boundary is a change between word and non-word characters, so a word
    that begins or ends in a symbol needs a word character next to that symbol.
    """
    words = clean_words(words)
    if all(is_word_char(w[0]) and is_word_char(w[-1]) for w in words):
        return NOT_AFTER_WORD + "(?:" + "|".join(map(quote, words)) + ")" + NOT_BEFORE_WORD
    return "|".join(
        (NOT_AFTER_WORD if is_word_char(w[0]) else AFTER_WORD)
        + quote(w)
        + (NOT_BEFORE_WORD if is_word_char(w[-1]) else BEFORE_WORD)
        for w in words
    )


def boundary_pattern(words: Iterable[str]) -> str:
    return f"(?iu)(?:{bounded(words)})"


def substring_pattern(words: Iterable[str]) -> str:
    return "(?iu)(?:" + "|".join(map(quote, clean_words(words))) + ")"


def matches_any(text: Column, words: Iterable[str], make_pattern=boundary_pattern) -> Column:
    """True where the text matches at least one word."""
    words = clean_words(words)
    text = folded(text)
    words = list(dict.fromkeys(map(fold, words)))
    chunks = [words[i : i + WORDS_PER_PATTERN] for i in range(0, len(words), WORDS_PER_PATTERN)]
    return reduce(lambda a, b: a | b, [text.rlike(make_pattern(c)) for c in chunks])
