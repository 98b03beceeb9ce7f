"""Row-local column expressions over text. None of them needs a shuffle."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from chatsieve.functions.patterns import WORD_CHAR, clean_words, is_single_token

# How a name falls into segments. An upper-case run belongs to the
# lower-case run after it; an upper-case run before a digit is in no segment.
SEGMENT_PATTERN = r"[A-Z]*[a-z]+|[A-Z]+(?![A-Za-z0-9])|[0-9]+"

# A token is two or more word characters.
TOKEN_PATTERN = r"[\p{L}\p{N}_]{2,}"

# Runs of white space that character n-grams see as one space.
SPACE_RUN_PATTERN = r"[\t-\r\x1c-\x1f \x{85}\p{Z}]{2,}"

# Accents and letters of other scripts that look like Latin ones.
LOOK_ALIKES = {
    "àáâãäåāăą": "a", "çćč": "c", "ďđ": "d", "èéêëēėęě": "e", "ìíîïīį": "i", "łľ": "l",
    "ñńň": "n", "òóôõöøōő": "o", "řŕ": "r", "śšş": "s", "ťţ": "t", "ùúûüūůűų": "u",
    "ýÿ": "y", "źżž": "z", "аα": "a", "е": "e", "оο": "o", "рρ": "p", "с": "c", "у": "y",
    "х": "x", "і": "i", "ѕ": "s", "к": "k", "м": "m", "т": "t", "ν": "v",
}
LEET = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s"}
SPACED_LETTER_GAP = r"[ .*-]"

# Common function words per language, for language votes.
FUNCTION_WORDS = {
    "de": ("der", "die", "das", "und", "ist", "nicht", "ein", "eine", "von", "zu", "mit", "auf"),
    "en": ("the", "of", "and", "to", "is", "that", "it", "was", "for", "with", "this", "by"),
    "es": ("el", "los", "las", "del", "y", "es", "por", "para", "con", "una", "no", "como"),
    "fr": ("le", "les", "des", "et", "est", "une", "dans", "pour", "qui", "que", "pas", "sur"),
}


def text_key(text: Column) -> Column:
    """Identity of a text, the same for every exact copy."""
    return F.sha2(text, 256)


def seeded_order(seed: int, row_id: Column) -> Column:
    """A repeatable pseudo-random order key."""
    return F.md5(F.concat(F.lit(f"{seed}:"), row_id.cast("string")))


def token_array(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(TOKEN_PATTERN), F.lit(0))


def segment_array(name: Column) -> Column:
    return F.regexp_extract_all(name, F.lit(SEGMENT_PATTERN), F.lit(0))


def lower_all(strings: Column) -> Column:
    """Lower-case an array whose items hold no spaces, inside generated code."""
    return F.split(F.lower(F.array_join(strings, " ")), " ")


def word_ngram_array(tokens: Column, n: int) -> Column:
    if n == 1:
        return tokens
    return F.when(
        F.size(tokens) >= n,
        F.transform(
            F.sequence(F.lit(1), F.size(tokens) - (n - 1)),
            lambda i: F.array_join(F.slice(tokens, i, F.lit(n)), " "),
        ),
    ).otherwise(F.array().cast("array<string>"))


def char_ngram_array(text: Column, n: int) -> Column:
    """Every run of ``n`` characters: each match looks ahead n and moves on by one,
    which is linear in the length of the text."""
    return F.regexp_extract_all(text, F.lit(f"(?s)(?=(.{{{n}}}))."), F.lit(1))


def char_text(text: Column) -> Column:
    return F.regexp_replace(F.lower(text), SPACE_RUN_PATTERN, " ")


def char_windows(text: Column, n: int) -> Column:
    """At every character the run of ``n`` characters from there, or what is left of the text."""
    return F.regexp_extract_all(char_text(text), F.lit(f"(?s)(?=(.{{1,{n}}}))."), F.lit(1))


def normalised(text: Column) -> Column:
    """Undo common disguises: look-alike letters, digits for letters, letters spaced
    out and letters drawn out. Meant for matching, not for display."""
    source = "".join(LOOK_ALIKES) + "".join(LEET)
    target = "".join(v * len(k) for k, v in LOOK_ALIKES.items()) + "".join(LEET.values())
    out = F.translate(F.lower(text), source, target)
    out = F.regexp_replace(out, r"!([a-z])", "i$1")
    before, after, gap = r"(?<![A-Za-z0-9_])", r"(?![A-Za-z0-9_])", SPACED_LETTER_GAP
    lone = (
        rf"(?<={before}[a-z]){gap}(?=[a-z]{gap}[a-z]{after})"
        rf"|(?<={before}[a-z]{gap}[a-z]){gap}(?=[a-z]{after})"
    )
    out = F.regexp_replace(out, lone, "")
    return F.regexp_replace(out, r"([a-z])\1{2,}", "$1")


def language_of(text: Column, words_by_language: Mapping[str, Iterable[str]]) -> Column:
    """Language whose function words occur most often; a tie goes to the first by
    name, and a text with no such word has none (``und``)."""
    listed = {lang: clean_words(words) for lang, words in words_by_language.items()}
    if not all(is_single_token(w) for words in listed.values() for w in words):
        raise ValueError("function words are single words")
    every = sorted({w for words in listed.values() for w in words})
    all_words = F.regexp_extract_all(F.lower(text), F.lit(WORD_CHAR + "+"), F.lit(0))
    found = F.filter(all_words, lambda w: w.isin(every))

    def best_of(words_found: Column) -> Column:
        votes = [
            F.struct(
                F.size(F.filter(words_found, lambda w: w.isin(listed[lang]))).alias("votes"),
                F.lit(-rank).alias("rank"),
                F.lit(lang).alias("lang"),
            )
            for rank, lang in enumerate(sorted(listed))
        ]
        return F.array_max(F.array(*votes))

    # The words found are bound to a name once, not looked for again for each language.
    best = F.transform(F.array(found), best_of)[0]
    return F.when(best["votes"] > 0, best["lang"]).otherwise(F.lit("und"))
