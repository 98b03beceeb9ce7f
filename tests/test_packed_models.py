"""Weights in tables: every model that a vector gives, for vocabularies that outgrow one."""

import random

import pytest
from pyspark.sql import functions as F

from chatsieve.operators import features, models, skew
from chatsieve.operators.sampling import stratified_split
from chatsieve.operators.term_models import TermModel
from chatsieve.sources.model_store import load_model, save_model


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(8)
    out = []
    for i in range(120):
        label = rng.choice((0, 0, 0, 1, 2))
        pool = [f"w{rng.randrange(150)}" for _ in range(rng.randrange(1, 20))]
        out.append((i, " ".join(pool + ["mean"] * (label == 1) + ["rude"] * (label == 2)), label, label > 0))
    return spark.createDataFrame(out, "id int, message string, label int, toxic boolean").repartition(3).cache()


@pytest.fixture
def narrow(monkeypatch):
    """The same call with the weights in vectors, then in tables."""

    def both(call):
        wide = call()
        monkeypatch.setattr(features, "MAX_VOCABULARY", 60)
        out = call()
        monkeypatch.undo()
        return wide, out

    return both


def close(a, b, key):
    a, b = ({tuple(r[k] for k in key): r for r in t.collect()} for t in (a, b))
    assert a.keys() == b.keys() and len(a) > 1
    for k, r in a.items():
        for name, x in r.asDict().items():
            assert b[k][name] == (pytest.approx(x, abs=2e-3) if isinstance(x, float | list) else x), (k, name)


def test_cross_validation(rows, narrow):
    (_, wide), (model, out) = narrow(lambda: models.fit_logistic_cv(rows, 3, (0.1, 10.0), 1, 1.0, max_iter=200, tol=1e-9))
    close(wide, out, ["c"])
    assert isinstance(model, TermModel) and models.toxic_scores(models.score(rows, model))["f1"] > 0.9


@pytest.mark.parametrize("family", ["logistic", "naive_bayes"])
def test_grid(rows, narrow, family):
    strength = "c" if family == "logistic" else "alpha"
    grid = {strength: (0.5, 20.0), "min_df": (1, 2)}
    wide, out = narrow(lambda: models.grid_search(stratified_split(rows, 0.3), grid, family=family))
    close(wide, out, [strength, "min_df"])


def test_several_classes(spark, rows, narrow, tmp_path):
    wide, out = narrow(lambda: models.fit_multiclass(rows, 5.0, 1, 1.0, max_iter=500, tol=1e-11))
    assert isinstance(out, TermModel)
    close(models.class_weights_table(spark, wide), models.class_weights_table(spark, out), ["term"])
    close(models.class_chances(rows, wide), models.class_chances(rows, out), ["id"])
    close(models.score_classes(rows, wide), models.score_classes(rows, out), ["id"])
    save_model(spark, out, str(tmp_path / "m"))
    close(models.score_classes(rows, out), models.score_classes(rows, load_model(spark, str(tmp_path / "m"))[0]), ["id"])


def test_counts_model(spark, rows, narrow):
    wide, out = narrow(lambda: models.fit_naive_bayes(rows, 0.5, 1, 1.0))
    assert isinstance(out, TermModel)
    close(models.weights_table(spark, wide), models.weights_table(spark, out), ["term"])
    close(models.score(rows, wide), models.score(rows, out), ["id"])
    close(models.explain_score(rows, wide, 3), models.explain_score(rows, out, 3), ["id", "place"])


def test_terms_are_split_up_in_tasks_that_grow_in_number(rows, monkeypatch):
    few = skew.text_parts(rows, "message")
    monkeypatch.setattr(skew, "CHARS_PER_TASK", 100)
    assert skew.text_parts(rows, "message") > few
    assert features.term_counts(rows, "id", "message").rdd.getNumPartitions() > few


def test_the_texts_are_not_kept_as_terms(spark, rows):
    before = spark._jsc.getPersistentRDDs().size()
    with models.prepared(rows, models.fit_features(rows), "toxic") as (train, n):
        assert n == 120 and train.agg(F.sum("y")).first()[0] > 0
        assert spark._jsc.getPersistentRDDs().size() == before
