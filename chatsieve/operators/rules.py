"""Word-list rules: flag, count, censor, explain and make exceptions.

Word lists are Python iterables or DataFrames with a ``word`` column.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from chatsieve.functions.patterns import (
    WORD_CHAR,
    boundary_pattern,
    clean_words,
    fold,
    folded,
    is_single_token,
    matches_any,
    substring_pattern,
)
from chatsieve.functions.text import lower_all, segment_array, token_array
from chatsieve.operators import matching
from chatsieve.operators.matching import as_list, listed_words, local_hits, local_words, replaced, with_hits
from chatsieve.operators.skew import join_lookup

MODES = ("boundary", "substring", "caps", "token")

# From this many words on, hash look-ups beat trying every word at every position.
HASHED_WORDS = 100


def literal_words(words: Iterable[str]) -> Column:
    return F.array(*[F.lit(w) for w in words])


def holds_any(pieces: Column, words: Iterable[str]) -> Column:
    """True where an array holds one of the (lower-case) words."""
    words = list(dict.fromkeys(words))
    if len(words) <= 50:
        return F.arrays_overlap(pieces, literal_words(words))
    return F.exists(pieces, lambda piece: piece.isin(words))


def rule_expr(text: Column, words: Iterable[str], mode: str = "boundary") -> Column:
    """Boolean rule over one text column; row-local in every mode.

    Short lists are patterns on the folded text. Of long ones the folded pieces of a text
    are looked up: its words, its segments, or its windows of words or characters.
    Both find the same, since both compare folded characters.
    """
    words = clean_words(words)
    lowered = list(dict.fromkeys(map(fold, words)))
    if mode in ("caps", "token"):
        return holds_any(pieces_of(text, mode), lowered)
    if len(lowered) <= HASHED_WORDS:
        return matches_any(text, words, pattern_of(mode))
    if mode == "boundary" and all(map(is_single_token, lowered)):
        return holds_any(pieces_of(text, mode), lowered)
    if mode == "substring":
        return F.when(text.isNotNull(), matching.holds_within(folded(text), lowered))
    return F.when(text.isNotNull(), F.size(local_words(folded(text), lowered, mode)) > 0)


def pattern_of(mode: str):
    return {"boundary": boundary_pattern, "substring": substring_pattern}[mode]


def pieces_of(text: Column, mode: str) -> Column:
    """The folded parts of a text that must equal a listed word."""
    if mode == "token":
        return token_array(folded(text))
    if mode == "boundary":
        return F.regexp_extract_all(folded(text), F.lit(WORD_CHAR + "+"), F.lit(0))
    if mode == "caps":
        return lower_all(segment_array(text))  # segments are ASCII, whose fold is the lower case
    raise ValueError(f"mode must be one of {MODES}, not {mode!r}")


def rule_flag(
    df: DataFrame,
    words: Iterable[str] | DataFrame,
    mode: str = "boundary",
    text: str = "message",
    id_col: str = "id",
    out: str = "flagged",
) -> DataFrame:
    """Add a boolean column: does the text break the word-list rule?

    A word list or table may have any size; one that is too large for an expression is
    joined. Then pass only the columns that are needed, since rows meet by id.
    """
    listed = as_list(df, words)
    if not isinstance(listed, DataFrame):
        return df.withColumn(out, rule_expr(F.col(text), listed, mode))
    return with_flag(df, token_hits(df, listed, mode, text, id_col).select(id_col), text, id_col, out)


def held_pieces(df: DataFrame, words: DataFrame, mode: str, text: str, *keep: str) -> DataFrame:
    """(*keep, word): the distinct parts of each text that may be an entry of a word table: its words
    and, where the table has phrases, windows of words; segments; or runs of characters."""
    short = matching.short_pieces(words, text) if mode == "boundary" else None
    if mode in ("caps", "token"):
        pieces = F.array_distinct(pieces_of(F.col(text), mode))
    elif short is not None:
        pieces, phrases = short
    else:
        _, windows = matching.all_windows(df, words, mode, text)
        pieces = F.array_distinct(F.transform(windows, lambda w: w["word"]))
    # An outer explode: of an inner one the optimiser finds the parts again in a filter.
    held = df.select(*keep, F.explode_outer(pieces).alias("word")).filter(F.col("word").isNotNull())
    if short is None:
        return held
    marked = held.join(F.broadcast(phrases.withColumn("_phrase", F.lit(True))), "word", "left")
    single = ~F.col("word").rlike(r"[^\p{L}\p{N}_]")
    return marked.filter(F.col("_phrase").isNotNull() | single).select(*keep, "word")


def token_hits(
    df: DataFrame, words: DataFrame, mode: str = "token", text: str = "message", id_col: str = "id"
) -> DataFrame:
    """(id, word) for every entry of a table of any size that a text holds.

    The vocabulary, counted with map-side partial sums, meets the word table first.
    Only the words in use go on, with their counts, to the join with the texts. Runs of
    characters are looked for in the distinct words of the texts (``words_within``).
    """
    if mode == "substring":
        return matching.words_within(df, words, text, id_col)
    pairs = held_pieces(df, words, mode, text, id_col)
    in_use = pairs.groupBy("word").count().join(listed_words(words), "word", "left_semi")
    return join_lookup(pairs, in_use, "word", "count", F.col(id_col)).select(id_col, "word")


def with_flag(df: DataFrame, hits: DataFrame, text: str, id_col: str, out: str) -> DataFrame:
    """Mark the rows whose id is among the hits; a missing text has no flag, as in the
    row-local rules."""
    marked = hits.select(F.col(id_col), F.lit(True).alias("_hit")).distinct()
    flag = F.when(F.col(text).isNotNull(), F.coalesce("_hit", F.lit(False)))
    return df.join(marked, id_col, "left").withColumn(out, flag).drop("_hit")


def contains_word(
    df: DataFrame, word: str, text: str = "message", truth: str = "toxic"
) -> DataFrame:
    """Counts for a one-word rule: flagged, correct, incorrect and share flagged."""
    hit = matches_any(F.col(text), [word])
    return df.agg(
        F.count("*").alias("total"),
        F.count_if(hit).alias("flagged"),
        F.count_if(hit & F.col(truth)).alias("correct"),
        F.count_if(hit & ~F.col(truth)).alias("incorrect"),
    ).select(
        F.lit(word).alias("word"),
        "*",
        F.expr("try_divide(100.0D * flagged, total)").alias("flagged_pct"),
    )


def censor(
    df: DataFrame,
    words: Iterable[str] | DataFrame,
    mode: str = "boundary",
    per_char: bool = False,
    text: str = "message",
    out: str = "censored",
    id_col: str = "id",
) -> DataFrame:
    """Star out matched words: ``***`` for each match, or one star per character.

    Words match as in ``rule_flag``, on folded text; the longest entry at a place counts. A
    list above ``ROW_LOCAL_WORDS`` entries is joined, and rows meet their matches by id.
    """
    stars = (lambda m: F.repeat(F.lit("*"), F.length(m))) if per_char else (lambda m: F.lit("***"))
    listed = as_list(df, words)
    column = F.col(text)
    if isinstance(listed, DataFrame):
        marked = with_hits(df, listed, mode, text, id_col)
        done = F.when(F.size("_hits") > 0, replaced(column, F.col("_hits"), mode, stars)).otherwise(column)
        return marked.withColumn(out, done).drop("_hits")
    done = replaced(column, local_hits(folded(column), listed, mode), mode, stars)
    if len(listed) <= HASHED_WORDS:  # most texts have no match, which a pattern tells at once
        done = F.when(matches_any(column, listed, pattern_of(mode)), done).otherwise(column)
    return df.withColumn(out, done)


def explain_match(
    df: DataFrame,
    words: Iterable[str] | DataFrame,
    mode: str = "boundary",
    text: str = "message",
    id_col: str = "id",
) -> DataFrame:
    """One row per hit: the rule (folded), the matched text and its 1-based first and last position.

    A text is cut at its matches; a running sum of the lengths gives the positions, unless the
    entries of a long list were looked up. Only hits are shuffled, without the texts. The longest entry at a place counts, and a
    list may have any size, as in ``censor``.
    """
    listed = as_list(df, words)
    if not isinstance(listed, DataFrame) and len(listed) <= HASHED_WORDS:
        df = df.filter(matches_any(F.col(text), listed, pattern_of(mode)))
    marked = with_hits(df.select(id_col, text), listed, mode, text, id_col)
    parts = matching.cut(
        F.col(text), F.col("_hits"), mode, lambda gap, m: F.struct(F.length(gap).alias("gap"), m.alias("matched"))
    )
    if "start" not in marked.schema["_hits"].dataType.elementType.names:
        return _summed_positions(marked, parts, id_col)
    # Looked-up hits know their places: nothing is shuffled but rows of an id that repeats.
    again = df.groupBy(id_col).agg(F.count("*").alias("_n")).filter("_n > 1").select(F.col(id_col).alias("_again"))
    if again.isEmpty():
        return _known_positions(marked, parts, id_col)
    repeats = F.col(id_col).eqNullSafe(F.col("_again"))
    once, several = (marked.join(again, repeats, how) for how in ("left_anti", "left_semi"))
    return _known_positions(once, parts, id_col).unionByName(_summed_positions(several, parts, id_col))


def _known_positions(marked: DataFrame, parts: Column, id_col: str) -> DataFrame:
    both = F.arrays_zip(parts["matched"].alias("matched"), F.col("_hits")["start"].alias("start"))
    hits = marked.select(id_col, F.posexplode(both).alias("hit_no", "hit"))
    start, width = F.col("hit.start").cast("long"), F.length("hit.matched")
    return hits.select(
        id_col,
        (F.col("hit_no") + 1).alias("hit_no"),
        folded(F.col("hit.matched")).alias("rule"),
        F.col("hit.matched").alias("matched"),
        (start + 1).alias("start_pos"),
        (start + width).alias("end_pos"),
    )


def _summed_positions(marked: DataFrame, parts: Column, id_col: str) -> DataFrame:
    """Positions by a running sum over the hits of an id; rows that share one are summed together."""
    hits = marked.select(id_col, F.posexplode(parts).alias("hit_no", "hit")).select(
        id_col,
        (F.col("hit_no") + 1).alias("hit_no"),
        "hit.matched",
        "hit.gap",
        F.length("hit.matched").alias("width"),
    )
    so_far = Window.partitionBy(id_col).orderBy("hit_no")
    ends = F.sum(F.col("gap") + F.col("width")).over(so_far)
    return hits.withColumn("end_pos", ends).select(
        id_col,
        "hit_no",
        folded(F.col("matched")).alias("rule"),
        "matched",
        (F.col("end_pos") - F.col("width") + 1).alias("start_pos"),
        "end_pos",
    )


def apply_exceptions(
    df: DataFrame,
    words: Iterable[str] | DataFrame,
    allow: Iterable[str] | DataFrame,
    text: str = "message",
    id_col: str = "id",
    out: str = "flagged",
) -> DataFrame:
    """Substring rule in which a hit inside an allow-listed word or phrase does not count.

    Allowed entries are blanked out, the longest at a place first, and the rule is matched on
    what is left. Both lists may have any size. Allow lists above ``ROW_LOCAL_WORDS`` entries
    are joined, with only the texts that the rule hits at all, which are few.
    """
    rule, allowed = as_list(df, words), as_list(df, allow)
    column = F.col(text)
    blank = lambda m: F.lit("\x01")
    if isinstance(allowed, DataFrame):
        suspects = rule_flag(df.select(id_col, text), rule, "substring", text, id_col, "_suspect").filter("_suspect")
        marked = with_hits(suspects.drop("_suspect"), allowed, "boundary", text, id_col)
        left = marked.select(id_col, replaced(column, F.col("_hits"), "boundary", blank).alias("_left"))
        hits = rule_flag(left, rule, "substring", "_left", id_col, "_hit").filter("_hit").select(id_col)
        return with_flag(df, hits, text, id_col, out)
    if len(allowed) <= HASHED_WORDS:
        longest_first = sorted(allowed, key=len, reverse=True)
        left = F.regexp_replace(folded(column), boundary_pattern(longest_first), "\x01")
    else:
        left = replaced(folded(column), local_hits(folded(column), allowed, "boundary"), "boundary", blank)
    if isinstance(rule, DataFrame):
        return rule_flag(df.withColumn("_left", left), rule, "substring", "_left", id_col, out).drop("_left")
    hit = rule_expr(column, rule, "substring")
    return df.withColumn(out, F.when(hit, rule_expr(left, rule, "substring")).otherwise(hit))


def rule_scorecard(
    df: DataFrame,
    words: Iterable[str] | DataFrame,
    text: str = "message",
    truth: str = "toxic",
) -> DataFrame:
    """Per word: flagged, correct, incorrect and precision. Each entry is looked for by
    itself, also inside longer ones. Counts are summed before they meet the list, so it may
    have any size."""
    listed = as_list(df, words)
    if isinstance(listed, DataFrame):
        held, table = held_pieces(df, listed, "boundary", text, truth), listed_words(listed)
    else:
        table = df.sparkSession.createDataFrame([(w,) for w in dict.fromkeys(map(fold, listed))], "word string")
        if all(map(is_single_token, listed)):
            found = F.array_intersect(pieces_of(F.col(text), "boundary"), literal_words(dict.fromkeys(map(fold, listed))))
        else:
            found = local_words(folded(F.col(text)), list(dict.fromkeys(map(fold, listed))), "boundary")
        held = df.select(F.explode(found).alias("word"), truth)
    counted = held.groupBy("word").agg(F.count("*").alias("flagged"), F.count_if(F.col(truth)).alias("correct"))
    return table.join(counted, "word", "left").select(
        "word",
        F.coalesce("flagged", F.lit(0)).alias("flagged"),
        F.coalesce("correct", F.lit(0)).alias("correct"),
        F.coalesce(F.col("flagged") - F.col("correct"), F.lit(0)).alias("incorrect"),
        F.expr("try_divide(correct, flagged)").alias("precision"),
    )


def name_segments(df: DataFrame, name: str = "author", out: str = "segments") -> DataFrame:
    """Parts of a name, split at other characters and at case changes."""
    return df.withColumn(out, segment_array(F.col(name)))
