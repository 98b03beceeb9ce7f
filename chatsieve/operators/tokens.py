"""Tokens, n-grams, stop words and language votes."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatsieve.functions.patterns import clean_words
from chatsieve.functions.text import (
    FUNCTION_WORDS,
    char_windows,
    language_of,
    normalised,
    token_array,
    word_ngram_array,
)
from chatsieve.operators.matching import ROW_LOCAL_WORDS, listed_words, short_list
from chatsieve.operators.skew import join_lookup


def normalise_text(df: DataFrame, text: str = "message", out: str = "normalised") -> DataFrame:
    return df.withColumn(out, normalised(F.col(text)))


def tokens(df: DataFrame, text: str = "message", id_col: str = "id") -> DataFrame:
    """(id, term) for every token occurrence."""
    return df.select(id_col, F.explode(token_array(F.col(text))).alias("term"))


def word_ngrams(
    df: DataFrame, lo: int = 1, hi: int = 2, text: str = "message", id_col: str = "id"
) -> DataFrame:
    """(id, n, term) for every run of lo to hi adjacent tokens."""
    split_up = df.select(id_col, token_array(F.col(text)).alias("_tokens"))
    runs = F.array(
        *[
            F.struct(F.lit(n).alias("n"), word_ngram_array(F.col("_tokens"), n).alias("terms"))
            for n in range(lo, hi + 1)
        ]
    )
    return split_up.select(id_col, F.inline(runs)).select(id_col, "n", F.explode("terms").alias("term"))


def shorter_runs(windows: DataFrame, lo: int, hi: int) -> DataFrame:
    """The first lo to hi characters of every window, as (n, term) in place of ``window``."""
    size = F.explode(F.sequence(F.lit(lo), F.least(F.lit(hi), F.length("window")))).alias("n")
    rest = [c for c in windows.columns if c != "window"]
    return windows.filter(F.length("window") >= lo).select(*rest, "window", size).select(
        *rest, "n", F.substring("window", F.lit(1), F.col("n")).alias("term")
    )


def char_ngrams(
    df: DataFrame, lo: int = 1, hi: int = 4, text: str = "message", id_col: str = "id"
) -> DataFrame:
    """(id, n, term) for every run of lo to hi characters of the lower-cased text,
    white-space runs counting as one space. One pattern pass: shorter runs are the heads
    of the windows of hi characters."""
    return shorter_runs(df.select(id_col, F.explode(char_windows(F.col(text), hi)).alias("window")), lo, hi)


def char_ngram_counts(df: DataFrame, lo: int = 1, hi: int = 4, text: str = "message") -> DataFrame:
    """(n, term, total): how often every run of ``char_ngrams`` occurs. Windows of hi characters are
    counted first, and only the distinct ones are rolled up to shorter runs."""
    windows = df.select(F.explode(char_windows(F.col(text), hi)).alias("window")).groupBy("window").agg(F.count("*").alias("times"))
    return shorter_runs(windows, lo, hi).groupBy("n", "term").agg(F.sum("times").alias("total"))


def remove_stop_words(
    token_df: DataFrame, stop_words: Iterable[str] | DataFrame, term: str = "term", id_col: str = "id"
) -> DataFrame:
    """Drop listed words from a token table. A list or short table becomes a hash-set
    filter; a long table is met by the vocabulary first, then by the tokens."""
    few = short_list(stop_words, ROW_LOCAL_WORDS) if isinstance(stop_words, DataFrame) else clean_words(stop_words)
    if few is not None:
        return token_df.filter(~F.col(term).isin([w.lower() for w in few]))
    listed = listed_words(stop_words).withColumnRenamed("word", term)
    kept = token_df.groupBy(term).count().join(listed, term, "left_anti")
    return join_lookup(token_df, kept, term, "count", F.col(id_col)).select(*token_df.columns)


def document_frequency(
    df: DataFrame,
    min_df: int = 3,
    max_df: float = 0.2,
    text: str = "message",
) -> DataFrame:
    """Terms found in at least min_df texts and at most the share max_df of them."""
    n_docs = df.agg(F.count("*").alias("n")).scalar()
    per_text = df.select(F.explode(F.array_distinct(token_array(F.col(text)))).alias("term"))
    counted = per_text.groupBy("term").agg(F.count("*").alias("df"))
    return counted.filter((F.col("df") >= min_df) & (F.col("df") <= n_docs * F.lit(float(max_df))))


def identify_language(
    df: DataFrame,
    words_by_language: Mapping[str, Iterable[str]] = FUNCTION_WORDS,
    text: str = "message",
    out: str = "language",
) -> DataFrame:
    return df.withColumn(out, language_of(F.col(text), words_by_language))
