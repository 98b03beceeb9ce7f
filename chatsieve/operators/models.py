"""Classifiers on text features: fit, choose, score, explain."""

from __future__ import annotations

import itertools
import random
from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager
from multiprocessing.pool import ThreadPool

import numpy as np
from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression, NaiveBayes, NaiveBayesModel, RandomForestClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from chatsieve.operators import forest, row_models, term_models
from chatsieve.operators.evaluate import confusion_columns, score_columns
from chatsieve.operators.features import (
    TABLE_ABOVE,
    VocabularyTooLarge,
    fit_features,
    idf_of,
    term_counts,
    vocabulary_of,
)
from chatsieve.operators.forest import ForestModel
from chatsieve.operators.sampling import stratified_folds
from chatsieve.operators.skew import discard, join_lookup, settled, text_parts
from chatsieve.operators.term_models import TermModel, Terms, fit_term_logistic, score_terms

# When the optimiser stops, and how many rows make a partition worth a task.
TOLERANCE = 1e-4
ROWS_PER_PARTITION = 20_000
# From this many rows times terms on, a forest keeps only the terms that a text holds.
FOREST_CELLS = 1 << 27
# Ten values of C spaced evenly in the logarithm between 1e-4 and 1e4.
C_GRID = tuple(float(c) for c in np.logspace(-4, 4, 10))


def logistic(
    c: float, n_rows: int, max_iter: int = 100, family: str = "auto", label: str = "y", tol: float = TOLERANCE
) -> LogisticRegression:
    """Logistic regression with penalty strength C on n rows: Spark divides the loss
    by the number of rows, so its parameter is 1 / (C * n)."""
    return LogisticRegression(
        featuresCol="features",
        labelCol=label,
        regParam=1.0 / (c * n_rows),
        elasticNetParam=0.0,
        standardization=False,
        maxIter=max_iter,
        tol=tol,
        family=family,
    )


def labelled(df: DataFrame, truth: str = "toxic") -> DataFrame:
    return df.withColumn("y", F.col(truth).cast("double"))


@contextmanager
def prepared(df: DataFrame, features: PipelineModel, truth: str, *keep: str) -> Iterator[tuple[DataFrame, int]]:
    """Label and features only, kept for the passes of a fit, and their number.

    An optimiser runs one job per step, so a small training set is drawn together
    into few partitions; a large one stays as it is.
    """
    wide = settled(labelled(features.transform(df), truth).select("y", "features", *keep), "features")
    try:
        n = wide.count()
        yield wide.coalesce(max(1, n // ROWS_PER_PARTITION)), n
    finally:
        discard(wide)


def table_above(analyzer: str = "word") -> int | None:
    """The vocabulary from which a model's weights are a table. The runs of characters stay few,
    however many texts there are."""
    return TABLE_ABOVE if analyzer == "word" else None


def step_tolerance(tol: float) -> float:
    """``tol`` is the gain over twenty steps at which the optimiser of a pipeline stops."""
    return max(tol / 20, 1e-12)


def fit_logistic(
    df: DataFrame,
    c: float = 1.0,
    min_df: int = 1,
    max_df: float = 1.0,
    ngram: tuple[int, int] = (1, 1),
    analyzer: str = "word",
    max_iter: int = 100,
    text: str = "message",
    truth: str = "toxic",
    tol: float = TOLERANCE,
) -> PipelineModel | TermModel:
    """TF-IDF and logistic regression as one pipeline. A vocabulary that outgrows one vector
    gives the same model with its weights as a table (``TermModel``)."""
    try:
        features = fit_features(df, min_df, max_df, ngram, analyzer, text=text, limit=table_above(analyzer))
    except VocabularyTooLarge:
        return fit_term_logistic(
            df, c, min_df, max_df, ngram, analyzer, max_iter, text, truth, min(step_tolerance(tol), 1e-8)
        )
    with prepared(df, features, truth) as (train, n):
        model = logistic(c, n, max_iter, tol=tol).fit(train)
    return PipelineModel(stages=[*features.stages, model])


def fit_logistic_cv(
    df: DataFrame,
    k: int = 5,
    grid: Sequence[float] = C_GRID,
    min_df: int = 3,
    max_df: float = 0.2,
    ngram: tuple[int, int] = (1, 1),
    max_iter: int = 1000,
    seed: int = 42,
    parallelism: int = 4,
    text: str = "message",
    truth: str = "toxic",
    id_col: str = "id",
    tol: float = TOLERANCE,
) -> tuple[PipelineModel | TermModel, DataFrame]:
    """Choose C by accuracy in stratified k-fold cross-validation, then fit on all rows.

    Returns the model and a table (c, accuracy, chosen, on_edge). The fits of a vocabulary that
    outgrows one vector share their passes over the data.
    """
    folded = stratified_folds(df.select(id_col, text, truth), k, seed, truth, id_col)
    try:
        features = fit_features(df, min_df, max_df, ngram, text=text, limit=table_above())
    except VocabularyTooLarge:
        model, accuracy = _cross_validate_terms(folded, k, grid, Terms(min_df, max_df), ngram, max_iter, text, truth, tol)
        return model, _search_table(df, grid, accuracy)
    with prepared(folded, features, truth, "fold") as (train, n):
        base = logistic(1.0, n, max_iter)
        in_fold = n * (k - 1) / k
        params = ParamGridBuilder().addGrid(base.regParam, [1.0 / (c * in_fold) for c in grid]).build()
        search = CrossValidator(
            estimator=base,
            estimatorParamMaps=params,
            evaluator=MulticlassClassificationEvaluator(labelCol="y", metricName="accuracy"),
            numFolds=k,
            foldCol="fold",
            parallelism=parallelism,
        ).fit(train)
        accuracy = list(search.avgMetrics)
        best = int(np.argmax(accuracy))
        model = logistic(grid[best], n, max_iter, tol=tol).fit(train)
    return PipelineModel(stages=[*features.stages, model]), _search_table(df, grid, accuracy)


def _search_table(df: DataFrame, grid: Sequence[float], accuracy: Sequence[float]) -> DataFrame:
    best = int(np.argmax(accuracy))
    rows = [
        (float(c), float(a), i == best, i == best and i in (0, len(grid) - 1))
        for i, (c, a) in enumerate(zip(grid, accuracy))
    ]
    return df.sparkSession.createDataFrame(rows, "c double, accuracy double, chosen boolean, on_edge boolean")


def _cross_validate_terms(
    folded: DataFrame, k: int, grid: Sequence[float], terms: Terms, ngram: tuple[int, int], max_iter: int, text: str, truth: str, tol: float
) -> tuple[TermModel, list[float]]:
    if folded.count() > term_models.PACKED_ROWS:
        rows = row_models.Rows(folded, text, truth, [terms], ngram, part=F.col("fold"))
        try:
            if rows.blocks is not None:
                accuracy = term_models.cross_validate_rows(rows, k, grid, step_tolerance(TOLERANCE), max_iter)
                fit = row_models.Fit(rows, grid[int(np.argmax(accuracy))], 0, min(step_tolerance(tol), 1e-8), max_iter)
                row_models.run(rows, [fit])
                return term_models.row_model(rows, fit), accuracy
        finally:
            rows.discard()
    packed = term_models.Packed(folded, text, truth, ngram, "word", fold="fold")
    scale = packed.lengths([terms])[0]
    accuracy = term_models.cross_validate(packed, k, grid, terms, scale, step_tolerance(TOLERANCE), max_iter)
    best = grid[int(np.argmax(accuracy))]
    history = term_models.room(packed.n)[1]
    fit = term_models.Fit(packed.y, packed.used, best, terms, scale, min(step_tolerance(tol), 1e-8), max_iter, history=history)
    term_models.run(packed, [fit])
    model = term_models.term_model(packed, fit)
    packed.discard()
    return model, accuracy


def counts_model(alpha: float) -> NaiveBayes:
    return NaiveBayes(modelType="multinomial", smoothing=alpha, labelCol="y")


def fit_naive_bayes(
    df: DataFrame,
    alpha: float = 1.0,
    min_df: int = 1,
    max_df: float = 1.0,
    text: str = "message",
    truth: str = "toxic",
) -> PipelineModel | TermModel:
    try:
        features = fit_features(df, min_df, max_df, weighted=False, text=text)
    except VocabularyTooLarge:
        return term_models.fit_term_counts(df, alpha, min_df, max_df, text, truth)
    with prepared(df, features, truth) as (train, _):
        model = counts_model(alpha).fit(train)
    return PipelineModel(stages=[*features.stages, model])


def fit_random_forest(
    df: DataFrame,
    trees: int = 20,
    depth: int = 5,
    min_df: int = 5,
    max_df: float = 0.2,
    seed: int = 42,
    text: str = "message",
    truth: str = "toxic",
) -> PipelineModel | ForestModel:
    """Spark's forest keeps a number per row and term. Rows and terms of which there are too many
    for that give a forest by the same rules on the terms that each text holds."""
    try:
        features = fit_features(df, min_df, max_df, text=text, limit=max(1, FOREST_CELLS // max(1, df.count())))
    except VocabularyTooLarge:
        return forest.fit_forest(df, trees, depth, min_df, max_df, seed, text, truth)
    with prepared(df, features, truth) as (train, _):
        model = RandomForestClassifier(
            numTrees=trees, maxDepth=depth, seed=seed, labelCol="y", featuresCol="features"
        ).fit(train)
    return PipelineModel(stages=[*features.stages, model])


def fit_multiclass(
    df: DataFrame,
    c: float = 1.0,
    min_df: int = 3,
    max_df: float = 0.2,
    max_iter: int = 100,
    text: str = "message",
    label: str = "label",
    tol: float = TOLERANCE,
) -> PipelineModel | TermModel:
    """Multinomial logistic regression over the label enum."""
    try:
        features = fit_features(df, min_df, max_df, text=text, limit=table_above())
    except VocabularyTooLarge:
        return term_models.fit_term_classes(df, c, min_df, max_df, max_iter, text, label, min(step_tolerance(tol), 1e-8))
    with prepared(df, features, label) as (train, n):
        model = logistic(c, n, max_iter, family="multinomial", tol=tol).fit(train)
    return PipelineModel(stages=[*features.stages, model])


def score(
    df: DataFrame, model: PipelineModel | TermModel | ForestModel, threshold: float = 0.5, text: str = "message"
) -> DataFrame:
    """Add (probability, pred) to every row; a map-only pass for a pipeline, a join for weights
    in a table. A missing text has neither."""
    if isinstance(model, TermModel):
        return score_terms(df, model, threshold, text)
    if isinstance(model, ForestModel):
        chance = F.when(F.col(text).isNotNull(), F.get("_chances", F.lit(1)))
        return forest.forest_chances(df, model, text).select(
            *df.columns, chance.alias("probability"), (chance > threshold).alias("pred")
        )
    probability = F.when(F.col(text).isNotNull(), vector_to_array("probability")[1])
    return model.transform(df).select(
        *df.columns, probability.alias("probability"), (probability > threshold).alias("pred")
    )


def class_chances(df: DataFrame, model: PipelineModel | TermModel | ForestModel, text: str = "message") -> DataFrame:
    """Add the chance of every class of a multi-class model as ``chances``."""
    if isinstance(model, TermModel):
        return term_models.class_chances(df, model, text)
    if isinstance(model, ForestModel):
        return forest.forest_chances(df, model, text).withColumnRenamed("_chances", "chances")
    return model.transform(df).select(*df.columns, vector_to_array("probability").alias("chances"))


def score_classes(df: DataFrame, model: PipelineModel | TermModel | ForestModel, text: str = "message") -> DataFrame:
    """Add the most likely label of a multi-class model."""
    if isinstance(model, TermModel):
        margins = term_models.term_margins(df, model, text)
        best = F.array_position("_margin", F.array_max("_margin")) - 1
        return margins.select(*df.columns, best.cast("int").alias("pred_label"))
    if isinstance(model, ForestModel):
        best = F.array_position("_chances", F.array_max("_chances")) - 1
        return forest.forest_chances(df, model, text).select(*df.columns, best.cast("int").alias("pred_label"))
    return model.transform(df).select(*df.columns, F.col("prediction").cast("int").alias("pred_label"))


def class_weights_table(spark, model: PipelineModel | TermModel) -> DataFrame:
    """(term, weights) of a multi-class model, one weight per class."""
    if isinstance(model, TermModel):
        return model.weights.select("term", "weights")
    w = model.stages[-1].coefficientMatrix.toArray()
    rows = [(term, [float(x) for x in w[:, j]]) for j, term in enumerate(vocabulary_of(model))]
    return spark.createDataFrame(rows, "term string, weights array<double>")


def weights_table(spark, model: PipelineModel | TermModel) -> DataFrame:
    """(term, idf, weight) per vocabulary term of a two-class linear model. Of a counts model
    the weight is the log odds of a term, and idf is NULL: it adds the weight for every
    occurrence."""
    if isinstance(model, TermModel):
        return model.weights.select("term", "idf", "weight")
    last, idf = model.stages[-1], idf_of(model)
    if isinstance(last, NaiveBayesModel):
        theta = last.theta.toArray()
        weights = theta[1] - theta[0]
    else:
        weights = last.coefficients.toArray()
    rows = [
        (term, None if i is None else float(i), float(w))
        for term, i, w in zip(vocabulary_of(model), idf if idf is not None else itertools.repeat(None), weights)
    ]
    return spark.createDataFrame(rows, "term string, idf double, weight double")


def top_terms(spark, model: PipelineModel, k: int = 20) -> DataFrame:
    """The k most toxic and the k most clean terms by weight. Weights that differ by rounding
    errors alone are ties, which go by term."""
    weights = weights_table(spark, model)
    even = F.round("weight", 9)
    toxic = weights.orderBy(F.desc(even), "term").limit(k).withColumn("side", F.lit("toxic"))
    clean = weights.orderBy(F.asc(even), "term").limit(k).withColumn("side", F.lit("clean"))
    return toxic.unionByName(clean).select("side", "term", "weight")


def explain_score(
    df: DataFrame, model: PipelineModel | TermModel, k: int = 5, text: str = "message", id_col: str = "id"
) -> DataFrame:
    """Per row the k terms that add most to the score, by size of weight times value (of a
    counts model: weight times occurrences).

    The weights of a pipeline are one row per vocabulary term, bounded by the model, and are
    broadcast; weights in a table are joined. The terms of a text stay together in one
    shuffle by id.
    """
    if isinstance(model, TermModel):
        parts = text_parts(df, text)
        counts = term_counts(df, id_col, text, model.analyzer, model.ngram, parts=parts)
        valued = join_lookup(counts, model.weights, "term", "df", F.col(id_col), parts=parts).repartition(parts, id_col)
    else:
        by_id = df.select(id_col, text).repartition(text_parts(df, text), id_col)
        terms = model.stages[0].transform(by_id).select(id_col, F.explode("_terms").alias("term"))
        counts = terms.groupBy(id_col, "term").agg(F.count("*").alias("tf"))
        valued = counts.join(F.broadcast(weights_table(df.sparkSession, model)), "term")
    valued = valued.withColumn("_raw", F.col("tf") * F.col("idf"))
    per_text = Window.partitionBy(id_col)
    norm = F.sqrt(F.sum(F.col("_raw") * F.col("_raw")).over(per_text))
    value = F.when(F.col("idf").isNull(), F.col("tf")).otherwise(F.col("_raw") / norm)
    share = valued.withColumn("contribution", F.col("weight") * value)
    place = F.row_number().over(per_text.orderBy(F.desc(F.round(F.abs("contribution"), 9)), "term"))
    return (
        share.withColumn("place", place)
        .filter(F.col("place") <= k)
        .select(id_col, "place", "term", "tf", "weight", "contribution")
    )


def toxic_scores(scored: DataFrame, truth: str = "toxic", pred: str = "pred") -> dict:
    """Accuracy, precision, recall and F1 of a scored table; one row to the driver."""
    row = scored.agg(*confusion_columns(F.col(truth), F.col(pred))).select(
        *[v.alias(k) for k, v in score_columns().items()]
    )
    return row.first().asDict()


def grid_search(
    df: DataFrame,
    grid: Mapping[str, Sequence],
    split: str = "split",
    sample: int | None = None,
    seed: int = 42,
    parallelism: int = 4,
    text: str = "message",
    truth: str = "toxic",
    family: str = "logistic",
) -> DataFrame:
    """Every combination of settings (or a random ``sample`` of them) with its measures
    on the held-out rows.

    Settings: c (or alpha for the ``naive_bayes`` family, a counts model), min_df, max_df,
    ngram, analyzer. ``best`` marks the highest F1 on the
    toxic class, ``on_edge`` a best value at the end of a range, a hint to look further.
    Combinations that share a vectoriser share its fitted features and are fitted
    ``parallelism`` at a time.
    """
    strength = {"logistic": "c", "naive_bayes": "alpha"}[family]
    names = list(grid)
    combos = [dict(zip(names, values)) for values in itertools.product(*grid.values())]
    if sample is not None and sample < len(combos):
        combos = random.Random(seed).sample(combos, sample)
    by_features: dict[tuple, list[dict]] = {}
    for combo in combos:
        settings = {k: v for k, v in combo.items() if k != strength}
        by_features.setdefault(tuple(sorted(settings.items())), []).append(combo)
    train, test = df.filter(F.col(split) == "train"), df.filter(F.col(split) == "test")
    results, in_tables = [], {}
    for settings, members in by_features.items():
        options = dict(settings)
        kind = options.get("ngram", (1, 1)), options.get("analyzer", "word")
        if kind not in in_tables:
            limit = table_above(kind[1]) if family == "logistic" else None
            try:
                features = fit_features(train, **options, text=text, weighted=family == "logistic", limit=limit)
            except VocabularyTooLarge:
                # All settings of this kind share one table of counts.
                alike = [
                    c for c in combos if (c.get("ngram", (1, 1)), c.get("analyzer", "word")) == kind
                ]
                in_tables[kind] = _grid_in_tables(df, alike, strength, kind, split, text, truth, family)
        if kind in in_tables:
            results += [(combo, in_tables[kind][tuple(sorted(combo.items()))]) for combo in members]
            continue
        with prepared(train, features, truth) as (fitted, n), prepared(test, features, truth, truth) as (held_out, _):

            def judge(combo: dict) -> tuple[dict, dict]:
                power = combo.get(strength, 1.0)
                kind = logistic(power, n) if family == "logistic" else counts_model(power)
                model = kind.fit(fitted)
                scored = model.transform(held_out).withColumn("pred", F.col("prediction") == 1.0)
                return combo, toxic_scores(scored, truth)

            with ThreadPool(min(parallelism, len(members))) as pool:
                results += pool.map(judge, members)
    best = max(range(len(results)), key=lambda i: (results[i][1]["f1"], -i))
    rows = []
    for i, (combo, measures) in enumerate(results):
        edges = [
            name
            for name in names
            if i == best
            and len(grid[name]) > 1
            and not isinstance(grid[name][0], (str, tuple))
            and combo[name] in (min(grid[name]), max(grid[name]))
        ]
        rows.append(
            (
                float(combo.get(strength, 1.0)),
                int(combo.get("min_df", 1)),
                float(combo.get("max_df", 1.0)),
                "-".join(map(str, combo.get("ngram", (1, 1)))),
                combo.get("analyzer", "word"),
                *(float(measures[m]) for m in ("accuracy", "precision", "recall", "f1")),
                i == best,
                ",".join(edges),
            )
        )
    return df.sparkSession.createDataFrame(
        rows,
        f"{strength} double, min_df int, max_df double, ngram string, analyzer string, accuracy double,"
        " precision double, recall double, f1 double, best boolean, on_edge string",
    )


def _grid_in_tables(
    df: DataFrame, combos: Sequence[dict], strength: str, kind: tuple, split: str, text: str, truth: str, family: str
) -> dict[tuple, dict]:
    """The measures of settings that share ngram and analyzer, from one packed table of counts."""
    rows = df.filter(F.col(split).isin("train", "test"))
    settings = [(Terms(c.get("min_df", 1), c.get("max_df", 1.0)), c.get(strength, 1.0)) for c in combos]
    found = None
    if family == "logistic" and rows.count() > term_models.PACKED_ROWS:
        found = _grid_on_rows(rows, settings, kind, split, text, truth)
    if found is None:
        packed = term_models.Packed(rows, text, truth, *kind, fitted=F.col(split) == "train")
        found = term_models.judge_settings(packed, settings, family, step_tolerance(TOLERANCE), 100)
        packed.discard()
    share = lambda a, b: a / b if b else 0.0
    return {
        tuple(sorted(c.items())): {
            "accuracy": share(tp + tn, tp + fp + fn + tn),
            "precision": share(tp, tp + fp),
            "recall": share(tp, tp + fn),
            "f1": share(2 * tp, 2 * tp + fp + fn),
        }
        for c, (tp, fp, fn, tn) in zip(combos, found, strict=True)
    }


def _grid_on_rows(
    df: DataFrame, settings: Sequence[tuple[Terms, float]], kind: tuple, split: str, text: str, truth: str
) -> list[tuple[int, int, int, int]] | None:
    """Counts on the test rows for the logistic model of every (terms, C); None if the terms are too
    many for passes over packed rows."""
    held_out = F.when(F.col(split) == "test", 1).otherwise(0)
    rows = row_models.Rows(df, text, truth, [t for t, _ in settings], *kind, part=held_out, uncounted=1)
    try:
        if rows.blocks is None:
            return None
        fits = [row_models.Fit(rows, c, rows.terms.index(t), step_tolerance(TOLERANCE), 100, out=1) for t, c in settings]
        row_models.run(rows, fits)
        return rows.judged(fits)
    finally:
        rows.discard()


def distil(
    annotated: DataFrame,
    human: DataFrame,
    text: str = "message",
    verdict: str = "verdict",
    status: str = "status",
    truth: str = "toxic",
    id_col: str = "id",
    **fit_options,
) -> tuple[PipelineModel | TermModel, DataFrame]:
    """Train a small model on machine-annotated rows and score the human-labelled ones.

    Only answered annotations are used. Rows in ``human`` never train the model.
    """
    train = (
        annotated.filter(F.col(status) == "OK")
        .join(human.select(id_col), id_col, "left_anti")
        .select(id_col, text, F.col(verdict).alias(truth))
    )
    model = fit_logistic(train, text=text, truth=truth, **fit_options)
    return model, score(human, model)
