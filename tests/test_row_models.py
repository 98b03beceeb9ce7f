"""Models of many rows, by passes over packed rows: the same as by numbers per row."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from chatsieve.operators import features, hashed, models, row_models, term_models
from chatsieve.operators.sampling import stratified_split
from chatsieve.operators.term_models import TermModel


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(5)
    out = []
    for i in range(150):
        label = rng.choice((0, 0, 0, 1, 2))
        pool = [f"w{rng.randrange(150)}" for _ in range(rng.randrange(1, 20))]
        out.append((i // 2, " ".join(pool + ["mean"] * (label == 1) + ["rude"] * (label == 2)), label, label > 0))
    out += [(80, None, 0, False), (None, "", 1, True)]
    return spark.createDataFrame(out, "id int, message string, label int, toxic boolean").repartition(3).cache()


@pytest.fixture
def both_ways(monkeypatch):
    """The same call by numbers per row, then by passes over packed rows."""

    def both(call):
        monkeypatch.setattr(features, "MAX_VOCABULARY", 60)
        few = call()
        monkeypatch.setattr(term_models, "PACKED_ROWS", 10)
        monkeypatch.setattr(term_models, "MAX_NUMBERS", 10)
        monkeypatch.setattr(row_models, "TOKENS_PER_BLOCK", 40)
        monkeypatch.setattr(row_models, "PASS_WEIGHTS", 500)
        many = call()
        monkeypatch.undo()
        return few, many

    return both


def close(a, b, key):
    a, b = ({tuple(r[k] for k in key): r for r in t.collect()} for t in (a, b))
    assert a.keys() == b.keys() and len(a) > 1
    for k, r in a.items():
        for name, x in r.asDict().items():
            assert b[k][name] == (pytest.approx(x, abs=2e-3) if isinstance(x, float | list) else x), (k, name)


def test_several_classes_of_any_number_of_rows(spark, rows, both_ways):
    few, many = both_ways(lambda: models.fit_multiclass(rows, 5.0, 1, 1.0, max_iter=500, tol=1e-11))
    assert isinstance(many, TermModel)
    close(models.class_weights_table(spark, few), models.class_weights_table(spark, many), ["term"])
    close(few.weights, many.weights, ["term"])
    assert many.intercept == pytest.approx(few.intercept, abs=2e-3)


def test_two_classes(rows, both_ways):
    few, many = both_ways(lambda: models.fit_logistic(rows, 4.0, 2, 0.9, ngram=(1, 2), max_iter=500, tol=1e-11))
    close(few.weights, many.weights, ["term"])
    assert many.intercept == pytest.approx(few.intercept, abs=2e-3)


def test_cross_validation(rows, both_ways):
    (_, few), (model, many) = both_ways(lambda: models.fit_logistic_cv(rows, 3, (0.1, 10.0), 1, 1.0, max_iter=200, tol=1e-9))
    assert isinstance(model, TermModel)
    close(few, many, ["c"])


def test_grid(rows, both_ways):
    grid = {"c": (0.5, 20.0), "min_df": (1, 2), "max_df": (0.5, 1.0)}
    few, many = both_ways(lambda: models.grid_search(stratified_split(rows, 0.3), grid))
    close(few, many, ["c", "min_df", "max_df"])


def test_too_many_terms_and_rows_without_class(rows, monkeypatch):
    monkeypatch.setattr(row_models, "MOST_WEIGHTS", 20)
    assert term_models.fit_on_rows(rows, 1.0, term_models.Terms(), (1, 1), "word", 5, "message", "toxic", 1e-8) is None
    with pytest.raises(ValueError):
        term_models.fit_on_rows(rows.withColumn("toxic", F.lit(None)), 1.0, term_models.Terms(), (1, 1), "word", 5, "message", "toxic", 1e-8)


def test_the_search_is_not_cut_short(monkeypatch):
    from chatsieve.plans import queries

    asked = {}
    monkeypatch.setattr(queries, "train_rows", lambda spark, d: None)
    monkeypatch.setattr(models, "fit_logistic_cv", lambda rows, **options: (None, asked.update(options)))
    queries.QUERIES["fit_logistic_cv"](None, "")
    assert not set(asked) & {"max_iter", "k", "grid", "tol", "max_df", "min_df"}


def test_terms_of_one_hash_are_told_apart():
    known = hashed.Hashed(np.array([5, -3, 9]), np.array([1, 2, 3], np.int32))
    assert known.places(np.array([9, 5, 5, 7, -3]), np.array([3, 1, 8, 1, 2], np.int32)).tolist() == [2, 1, -1, -1, 0]
    assert not hashed.Hashed(np.array([5, 5]), np.array([1, 2], np.int32)).unique
