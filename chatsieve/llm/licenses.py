"""Licence notices in whole files, by a positional index of a word they cannot lack.

Every template word has its positions (postings). A template's mandatory phrases must
stand word for word, so the rarest word in them, by document frequency over the whole
corpus, is its key: an occurrence of the key in a file proposes the template at the
file position that would put the key in its place, and no place that passes goes
without a proposal. At each proposed place the mandatory phrases are verified and the
other words are intersected by relative position.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chatsieve.llm.words import ascii_words

# Phrases and labels every file is searched for.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
# Notices, with the phrases that must stand in each.
NOTICES = (
    ("apache-2.0", "licensed under the apache license version 2 0", ("apache license version 2 0",)),
    (
        "gpl-3.0",
        "this work is licensed under the gnu general public license version 3",
        ("gnu general public license version 3",),
    ),
    (
        "gpl-2.0",
        "this work is licensed under the gnu general public license version 2",
        ("gnu general public license version 2",),
    ),
    (
        "gpl-or-later",
        "under the terms of the gnu general public license as published by the free software foundation"
        " either version 2 of the license or at your option any later version",
        ("gnu general public license", "any later version"),
    ),
    ("mit", "released under the mit license", ("the mit license",)),
    (
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and"
        " associated documentation files the software to deal in the software without restriction",
        ("permission is hereby granted free of charge", "without restriction"),
    ),
    ("cc-by-nc-4.0", "licensed under cc by nc 4 0", ("cc by nc 4 0",)),
    ("cc-by-4.0", "licensed under cc by 4 0", ("cc by 4 0",)),
    ("cc-by-sa-4.0", "licensed under cc by sa 4 0", ("cc by sa 4 0",)),
    (
        "bsd",
        "redistribution and use in source and binary forms with or without modification are permitted"
        " provided that the following conditions are met",
        ("redistribution and use in source and binary forms",),
    ),
    (
        "mpl-2.0",
        "this source code form is subject to the terms of the mozilla public license v 2 0",
        ("mozilla public license v 2 0",),
    ),
)
MIN_COVER = 0.7
#: Words by which the SQL looks up a notice; the operator loses no place and needs one.
KEYS = 3


def document_frequency(words: DataFrame, vocabulary: list[str]) -> dict[str, int]:
    """Documents that hold each word of a (small, fixed) vocabulary, over all rows."""
    listed = F.array(*[F.lit(w) for w in vocabulary])
    found = words.select(F.explode_outer(F.array_intersect("words", listed)).alias("word"))
    return {r.word: r.n for r in found.groupBy("word").agg(F.count("*").alias("n")).collect() if r.word}


def _at(words: str, phrase: str, start: Column) -> Column:
    """Whether the phrase stands at ``start`` word for word."""
    wanted = F.split(F.lit(phrase), " ")
    return F.when(start >= 0, F.slice(words, start + 1, F.size(wanted)) == wanted).otherwise(False)


def _offset(text: list[str], phrase: str) -> int:
    """Word of the template at which its phrase begins."""
    at = f" {' '.join(text)} ".index(f" {phrase} ")
    return len(" ".join(text)[:at].split())


def _key(text: list[str], must: tuple[str, ...], seen: dict[str, int]) -> int:
    """Place in the template of the rarest word that must stand there; with no mandatory
    phrase there would be none, which is an error."""
    places = [_offset(text, p) + k for p in must for k in range(len(p.split(" ")))]
    if not places:
        raise ValueError(f"a notice without a mandatory phrase: {' '.join(text)}")
    return min(places, key=lambda at: (seen.get(text[at], 0), at))


def _covered(words: str, template: str, start: Column) -> Column:
    """Words of the template that stand in their places when it begins at ``start``."""
    wanted = F.split(F.lit(template), " ")
    same = lambda k: F.coalesce(F.get(words, start + k) == F.get(wanted, k), F.lit(False))
    return F.size(F.filter(F.sequence(F.lit(0), F.size(wanted) - 1), same))


def scan_licenses(
    docs: DataFrame, phrases: dict[str, str] = PHRASES, notices=NOTICES, min_cover: float = MIN_COVER
) -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score) per row.

    Base labels come from phrases standing word for word anywhere in the file; labels add
    those of the notices, each looked for at every place of the file. ``score`` is the largest share of a notice's words found in
    place (1 where a base phrase stands and no notice covers more, as the phrase itself
    is whole, halved because it is no full notice). NULL and empty texts have no words
    and no labels ('' and score 0). Repeated rows give a row each; other columns are not
    looked at. Nothing is shuffled but the word frequencies of the notices.
    """
    split = docs.select(F.col("doc_id").cast("long").alias("doc_id"), ascii_words("text").alias("words"))
    templates = [(label, text.split(" "), must) for label, text, must in notices]
    vocabulary = sorted({w for _, text, _ in templates for w in text})
    seen = document_frequency(split, vocabulary)
    keyed = [_key(text, must, seen) for _, text, must in templates]
    heads = sorted({p.split(" ")[0] for p in phrases} | {text[at] for (_, text, _), at in zip(templates, keyed)})
    place = F.array_compact(F.transform("words", lambda w, i: F.when(w.isin(heads), i)))
    rows = split.select("doc_id", "words", place.alias("place"))

    def starts(of: str) -> Column:
        return F.filter("place", lambda i: _at("words", of, i))

    def holding(proposed: Column, phrase: str, offset: int) -> Column:
        return F.filter(proposed, lambda s: _at("words", phrase, s + offset))

    def shifted(word: str, by: int) -> Column:
        return F.transform(F.filter("place", lambda i: F.get("words", i) == word), lambda i: i - by)

    def cover(text: list[str], must: tuple[str, ...], key: int) -> Column:
        sound = shifted(text[key], key)
        for phrase in must:
            sound = holding(sound, phrase, _offset(text, phrase))
        best = F.array_max(F.transform(sound, lambda s: _covered("words", " ".join(text), s)))
        share = F.coalesce(best, F.lit(0)) / F.lit(float(len(text)))
        return F.when(F.size("place") > 0, F.when(share >= min_cover, share).otherwise(0.0)).otherwise(0.0)

    rows = rows.select(
        "doc_id",
        (F.size("words") - F.size(F.filter(F.array(F.get("words", F.lit(0)), F.get("words", F.size("words") - 1)), lambda w: w == ""))).alias("n"),
        (F.get("words", F.lit(0)) == "").cast("int").alias("gap"),
        *[starts(p).alias(f"p{k}") for k, p in enumerate(phrases)],
        *[cover(text, must, keyed[k]).alias(f"t{k}") for k, (_, text, must) in enumerate(templates)],
    )
    every = F.flatten(F.array(*[f"p{k}" for k in range(len(phrases))]))
    base = [F.when(F.size(f"p{k}") > 0, label) for k, label in enumerate(phrases.values())]
    more = [F.when(F.col(f"t{k}") > 0, label) for k, (label, _, _) in enumerate(templates)]
    joined = lambda parts: F.array_join(F.array_sort(F.array_distinct(F.array_compact(F.array(*parts)))), ",")
    best = F.greatest(*[F.col(f"t{k}") for k in range(len(templates))], F.when(F.size(every) > 0, 0.5).otherwise(0.0))
    return rows.select(
        "doc_id",
        F.greatest(F.col("n"), F.lit(0)).cast("long").alias("n_words"),
        F.size(every).cast("long").alias("n_base"),
        (F.array_min(every) - F.col("gap")).cast("long").alias("first_word"),
        (F.array_max(every) - F.col("gap")).cast("long").alias("last_word"),
        joined(base).alias("base_labels"),
        joined(base + more).alias("labels"),
        best.alias("score"),
    )
