"""TF-IDF, as a long table and as an ML pipeline.

Weights follow the smoothed form: tf * (ln((1 + n) / (1 + df)) + 1), then unit length
per text.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.feature import IDF, CountVectorizer, ElementwiseProduct, Normalizer, SQLTransformer
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from chatsieve.functions.text import SPACE_RUN_PATTERN, TOKEN_PATTERN, token_array
from chatsieve.operators.skew import join_lookup, text_parts
from chatsieve.operators.tokens import document_frequency

MAX_VOCABULARY = 1 << 20
# From here on a vector per task and step costs a fit more than weights in a table.
TABLE_ABOVE = 1 << 16


class VocabularyTooLarge(ValueError):
    """The terms do not fit one vector."""


def term_counts(
    df: DataFrame, id_col: str, text: str, analyzer: str = "word", ngram: tuple[int, int] = (1, 1), *keep: str,
    parts: int | None = None,
) -> DataFrame:
    """(id, *keep, term, tf). The texts are shuffled once, by id."""
    terms = F.explode(F.expr(terms_sql(analyzer, ngram, f"`{text}`"))).alias("term")
    by_id = df.select(id_col, text, *keep).repartition(parts or text_parts(df, text), id_col)
    return by_id.select(id_col, *keep, terms).groupBy(id_col, *keep, "term").agg(F.count("*").alias("tf"))


def tfidf(
    df: DataFrame, min_df: int = 3, max_df: float = 0.2, text: str = "message", id_col: str = "id"
) -> DataFrame:
    """Long table (id, term, tf, idf, weight).

    The texts are shuffled once, by id; counting and scaling to unit length then need
    no shuffle of the longer token table. The inverse document frequencies join as a
    lookup whose most frequent terms are broadcast. Tasks grow in number with the texts.
    """
    n_docs = df.agg(F.count("*").alias("n")).scalar()
    weights = document_frequency(df, min_df, max_df, text).select(
        "term", "df", (F.ln((n_docs + 1) / (F.col("df") + 1)) + 1).alias("idf")
    )
    parts = text_parts(df, text)
    counts = term_counts(df, id_col, text, parts=parts)
    scored = join_lookup(counts, weights, "term", "df", F.col(id_col), parts=parts).withColumn(
        "_raw", F.col("tf") * F.col("idf")
    ).repartition(parts, id_col)
    norm = F.sqrt(F.sum(F.col("_raw") * F.col("_raw")).over(Window.partitionBy(id_col)))
    return scored.select(id_col, "term", "tf", "idf", (F.col("_raw") / norm).alias("weight"))


def terms_sql(analyzer: str, ngram: tuple[int, int], text: str) -> str:
    """SQL for the array of terms of a text, so that the step can be saved with the
    pipeline and runs as native expressions."""
    lo, hi = ngram
    text = f"coalesce({text}, '')"
    if analyzer == "word":
        base = f"regexp_extract_all(lower({text}), r'{TOKEN_PATTERN}', 0)"
        if (lo, hi) == (1, 1):
            return base
        runs = [
            "b"
            if n == 1
            else f"if(size(b) < {n}, array(), transform(sequence(1, greatest(size(b) - {n - 1}, 1)),"
            f" i -> array_join(slice(b, i, {n}), ' ')))"
            for n in range(lo, hi + 1)
        ]
        # The tokens are bound to b once, not found again for every position.
        return f"transform(array({base}), b -> concat({', '.join(runs)}))[0]"
    elif analyzer == "char":
        base = f"regexp_replace(lower({text}), r'{SPACE_RUN_PATTERN}', ' ')"
        parts = [f"regexp_extract_all({base}, r'(?s)(?=(.{{{n}}})).', 1)" for n in range(lo, hi + 1)]
    else:
        raise ValueError("analyzer must be 'word' or 'char'")
    return parts[0] if len(parts) == 1 else f"concat({', '.join(parts)})"


def fit_features(
    df: DataFrame,
    min_df: int = 1,
    max_df: float = 1.0,
    ngram: tuple[int, int] = (1, 1),
    analyzer: str = "word",
    weighted: bool = True,
    text: str = "message",
    out: str = "features",
    limit: int | None = None,
) -> PipelineModel:
    """Fit the vectoriser: terms, counts, idf + 1 and unit length as one pipeline.

    With ``weighted=False`` the features are plain counts. The vocabulary is the only
    thing that reaches the driver; min_df and max_df keep it small, and a vocabulary
    over ``limit`` (``MAX_VOCABULARY`` at most) is an error, never cut off. The terms of a text
    are found again in each pass: kept, they would be many times the text.
    """
    most = min(limit or MAX_VOCABULARY, MAX_VOCABULARY)
    if vocabulary_size(df, min_df, max_df, ngram, analyzer, text, most + 1) > most:
        raise VocabularyTooLarge("the vocabulary is too large for one model: raise min_df or lower max_df")
    terms = SQLTransformer(statement=f"SELECT *, {terms_sql(analyzer, ngram, text)} AS _terms FROM __THIS__")
    counted_col = "_counts" if weighted else out
    vectoriser = CountVectorizer(
        inputCol="_terms",
        outputCol=counted_col,
        minDF=float(min_df),
        maxDF=float(max_df) if max_df < 1 else float(2**53),
        vocabSize=MAX_VOCABULARY + 1,
    )
    split_up = terms.transform(df.select(text)).select("_terms")
    counter = vectoriser.fit(split_up)
    stages = [terms, counter]
    if weighted:
        idf = IDF(inputCol=counted_col, outputCol="_idf").fit(counter.transform(split_up)).idf
        stages += [
            ElementwiseProduct(
                scalingVec=Vectors.dense(idf.toArray() + 1.0), inputCol=counted_col, outputCol="_scaled"
            ),
            Normalizer(p=2.0, inputCol="_scaled", outputCol=out),
        ]
    return PipelineModel(stages=stages)


def vocabulary_size(
    df: DataFrame, min_df: int, max_df: float, ngram: tuple[int, int], analyzer: str, text: str, enough: int
) -> int:
    """The number of terms that ``min_df`` and ``max_df`` keep, counted up to ``enough``."""
    terms = F.array_distinct(F.expr(terms_sql(analyzer, ngram, f"`{text}`")))
    counted = df.select(F.explode(terms).alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    most = max_df * df.count() if max_df < 1 else float(2**53)
    return counted.filter((F.col("df") >= min_df) & (F.col("df") <= most)).select("df").limit(enough).count()


def vocabulary_of(model: PipelineModel) -> list[str]:
    return next(s.vocabulary for s in model.stages if hasattr(s, "vocabulary"))


def idf_of(model: PipelineModel):
    """idf + 1 per vocabulary term, or None for plain counts."""
    for stage in model.stages:
        if isinstance(stage, ElementwiseProduct):
            return stage.getScalingVec().toArray()
    return None

