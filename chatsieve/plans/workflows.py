"""Whole jobs: evaluate a rule filter, train and evaluate a model, review names."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatsieve.functions.patterns import BASIC_WORDS
from chatsieve.operators.evaluate import classification_report, error_rows, flag_summary
from chatsieve.operators.models import fit_logistic_cv, score
from chatsieve.operators.rules import rule_flag
from chatsieve.operators.sampling import head_rows, seeded_sample, stratified_split
from chatsieve.sources.model_store import load_model, save_model


def report_and_errors(
    df: DataFrame, samples: int = 10, pred: str = "flagged", truth: str = "toxic"
) -> dict[str, DataFrame]:
    """Report, and samples of the false positives and false negatives."""
    return {
        "report": classification_report(df, truth, pred),
        "false_positives": seeded_sample(error_rows(df, "fp", truth, pred), samples),
        "false_negatives": seeded_sample(error_rows(df, "fn", truth, pred), samples),
    }


def evaluate_rules(
    df: DataFrame, words: Iterable[str] = BASIC_WORDS, mode: str = "boundary", samples: int = 10
) -> dict[str, DataFrame]:
    return report_and_errors(rule_flag(df, words, mode), samples)


def train_model(
    df: DataFrame, path: str, frac: float = 0.2, seed: int = 42, samples: int = 10, **fit_options
) -> dict[str, DataFrame]:
    """Split, fit with cross-validation, report on the test rows, save model and split."""
    split = stratified_split(df, frac, seed)
    model, search = fit_logistic_cv(split.filter(F.col("split") == "train"), seed=seed, **fit_options)
    save_model(df.sparkSession, model, path, frac=frac, seed=seed)
    scored = score(split.filter(F.col("split") == "test"), model)
    return {"search": search, **report_and_errors(scored, samples, pred="pred")}


def evaluate_model(df: DataFrame, path: str, samples: int = 10) -> dict[str, DataFrame]:
    """Report of a saved model on the rows it was not trained on: the split is the one
    stored with the model."""
    model, kept = load_model(df.sparkSession, path)
    split = stratified_split(df, kept["frac"], kept["seed"])
    return report_and_errors(score(split.filter(F.col("split") == "test"), model), samples, pred="pred")


def review_names(
    names: DataFrame,
    words: Iterable[str] = BASIC_WORDS,
    mode: str = "caps",
    model: PipelineModel | None = None,
    review: int = 50,
    order: str = "hash",
    name: str = "author",
) -> dict[str, DataFrame]:
    """Totals and a list of flagged names to check by hand, by rule or by model.
    ``order`` is ``hash`` for a seeded sample or ``id`` for the first ones."""
    if model is None:
        flagged = rule_flag(names, words, mode, text=name)
    else:
        scored = score(names.withColumnRenamed(name, "message"), model)
        flagged = scored.withColumnRenamed("message", name).withColumnRenamed("pred", "flagged")
    hits = flagged.filter("flagged")
    listed = seeded_sample(hits, review) if order == "hash" else head_rows(hits, review)
    return {"summary": flag_summary(flagged), "review": listed}

