"""Weights as a table give the optimum that weights in one vector have."""

import os
import random

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from chatsieve.operators import features, models, skew
from chatsieve.operators.term_models import TermModel
from chatsieve.sources.model_store import load_model, save_model


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(3)
    out = []
    for i in range(90):
        toxic = rng.random() < 0.3
        pool = [f"w{rng.randrange(160)}" for _ in range(rng.randrange(1, 25))]
        out.append((i, " ".join(pool + (["mean", "word"] if toxic and rng.random() < 0.8 else [])), toxic))
    out += [(90, None, False), (91, "", True), (92, "! ?", False)]
    return spark.createDataFrame(out, "id int, message string, toxic boolean").repartition(3).cache()


@pytest.fixture(scope="module")
def wide(rows):
    limit, features.MAX_VOCABULARY = features.MAX_VOCABULARY, 100
    try:
        return models.fit_logistic(rows, c=4.0)
    finally:
        features.MAX_VOCABULARY = limit


def test_the_optimum_is_that_of_the_vector(spark, rows, wide):
    assert isinstance(wide, TermModel) and wide.weights.count() > 100
    fit = models.fit_features(rows)
    with models.prepared(rows, fit, "toxic") as (train, n):
        best = models.logistic(4.0, n, 1000, tol=1e-12).fit(train)
        held = train.select("y", vector_to_array("features").alias("v")).collect()
    want = dict(zip(features.vocabulary_of(fit), best.coefficients.toArray()))
    got = {r.term: r.weight for r in wide.weights.collect()}
    assert set(got) == set(want)
    assert max(abs(got[t] - want[t]) for t in want) < 5e-3 and abs(wide.intercept - best.intercept) < 5e-3
    x, y = np.array([r.v for r in held]), np.array([r.y for r in held])
    order = features.vocabulary_of(fit)

    def objective(w, b):
        m = x @ w + b
        return np.log1p(np.exp(np.where(y == 1, -m, m))).mean() + w @ w / (2 * 4.0 * n)

    low = objective(best.coefficients.toArray(), best.intercept)
    assert objective(np.array([got[t] for t in order]), wide.intercept) <= low + 1e-6


def test_scores_explanations_and_store(spark, rows, wide, tmp_path):
    scored = {r.id: r for r in models.score(rows, wide).collect()}
    assert scored[90].probability is None and scored[90].pred is None
    assert scored[91].probability == scored[92].probability and len(scored) == 93
    assert models.toxic_scores(models.score(rows.na.drop(), wide))["f1"] > 0.8
    sums = models.explain_score(rows, wide, 100).groupBy("id").agg(F.sum("contribution").alias("s")).collect()
    for r in sums:
        assert 1 / (1 + np.exp(-(r.s + wide.intercept))) == pytest.approx(scored[r.id].probability)
    save_model(spark, wide, str(tmp_path / "m"), seed=7)
    again, kept = load_model(spark, str(tmp_path / "m"))
    assert kept == {"seed": 7}
    assert {r.id: r.probability for r in models.score(rows, again).collect()} == {i: r.probability for i, r in scored.items()}
    assert {r.term for r in models.top_terms(spark, wide, 2).collect() if r.side == "toxic"} == {"mean", "word"}


def test_ngrams_and_one_class(rows):
    limit, features.MAX_VOCABULARY = features.MAX_VOCABULARY, 100
    try:
        model = models.fit_logistic(rows, min_df=2, ngram=(1, 2), max_iter=3)
        assert isinstance(model, TermModel)
        assert model.weights.filter("term = 'mean word'").count() == 1 and model.weights.agg(F.min("df")).first()[0] == 2
        with pytest.raises(ValueError):
            models.fit_logistic(rows.withColumn("toxic", F.lit(True)))
    finally:
        features.MAX_VOCABULARY = limit


def test_discarded_tables_are_gone(spark):
    table = skew.settled(spark.range(3), "gone")
    path = table.inputFiles()[0].removeprefix("file:").replace("//", "/", 1)
    assert os.path.exists(path)
    skew.discard(table)
    skew.discard(table)
    assert not os.path.exists(path)
