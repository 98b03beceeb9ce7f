"""Words that are nearly listed words."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chatsieve.functions.patterns import clean_words
from chatsieve.functions.text import token_array
from chatsieve.operators.matching import listed_words
from chatsieve.operators.rules import with_flag
from chatsieve.operators.skew import join_lookup


def deletions(word: Column, rounds: int) -> Column:
    """The word and all forms with up to ``rounds`` characters left out.

    Two words within that edit distance always share one of these forms, so an equi
    join on the forms finds every candidate.
    """
    forms = F.array(word)
    for _ in range(rounds):
        shorter = F.transform(
            forms,
            lambda w: F.transform(
                F.sequence(F.lit(1), F.greatest(F.length(w), F.lit(1))),
                lambda i: F.concat(F.substring(w, 1, i - 1), F.substring(w, i + 1, F.length(w))),
            ),
        )
        forms = F.array_distinct(F.concat(forms, F.flatten(shorter)))
    return forms


def fuzzy_hits(
    df: DataFrame,
    words: Iterable[str] | DataFrame,
    max_dist: int = 1,
    min_len: int = 4,
    text: str = "message",
    id_col: str = "id",
) -> DataFrame:
    """(id, term, word, distance): tokens of at least ``min_len`` characters within the
    edit distance of a listed word. Of several words the nearest counts, then the
    first by name.

    Only the distinct tokens are compared; the few that match go back to the texts.
    Tokens longer or shorter than any listed word by more than the distance are left
    out at once.
    """
    if not isinstance(words, DataFrame):
        words = df.sparkSession.createDataFrame([(w,) for w in clean_words(words)], "word string")
    listed = listed_words(words).filter(F.length("word") >= min_len)
    bounds = listed.agg(F.min(F.length("word")).alias("lo"), F.max(F.length("word")).alias("hi")).first()
    lo, hi = max(min_len, (bounds["lo"] or 0) - max_dist), (bounds["hi"] or 0) + max_dist
    fitting = F.filter(F.array_distinct(token_array(F.col(text))), lambda t: F.length(t).between(lo, hi))
    pairs = df.select(id_col, F.explode(fitting).alias("term"))
    vocabulary = pairs.groupBy("term").agg(F.count("*").alias("texts"))
    near = (
        vocabulary.select("term", "texts", F.explode(deletions(F.col("term"), max_dist)).alias("form"))
        .join(listed.select("word", F.explode(deletions(F.col("word"), max_dist)).alias("form")), "form")
        .withColumn("distance", F.levenshtein("term", "word"))
        .filter(F.col("distance") <= max_dist)
        .groupBy("term")
        .agg(F.any_value("texts").alias("texts"), F.min(F.struct("distance", "word")).alias("best"))
        .select("term", "texts", F.col("best.word").alias("word"), F.col("best.distance").alias("distance"))
    )
    return join_lookup(pairs, near, "term", "texts", F.col(id_col)).select(
        id_col, "term", "word", "distance"
    )


def fuzzy_flag(
    df: DataFrame,
    words: Iterable[str] | DataFrame,
    max_dist: int = 1,
    min_len: int = 4,
    text: str = "message",
    id_col: str = "id",
    out: str = "flagged",
) -> DataFrame:
    hits = fuzzy_hits(df, words, max_dist, min_len, text, id_col)
    return with_flag(df, hits, text, id_col, out)
