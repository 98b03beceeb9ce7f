import math

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from chatsieve.operators import features, models
from chatsieve.operators.sampling import stratified_split
from chatsieve.plans import tables, workflows
from chatsieve.sources.model_store import load_model, save_model

DATA = "/root/testdata/sf0.001"
TEXTS = ["bad dog bad", "good dog", "bad cat now", "good cat", "nice good day", "bad bad day"]


@pytest.fixture(scope="module")
def small(spark):
    rows = [(i, t, "bad" in t) for i, t in enumerate(TEXTS * 6)]
    return spark.createDataFrame(rows, "id int, message string, toxic boolean").cache()


@pytest.fixture(scope="module")
def model(small):
    return models.fit_logistic(small, c=10.0)


def test_tfidf_by_hand(frame):
    df = frame(list(enumerate(TEXTS)), "id int, message string")
    docs = [t.split() for t in TEXTS]
    idf = {w: math.log((1 + len(docs)) / (1 + sum(w in d for d in docs))) + 1 for d in docs for w in d}
    got = {(r.id, r.term): r.weight for r in features.tfidf(df, 1, 1.0).collect()}
    fitted = features.fit_features(df)
    vocabulary = features.vocabulary_of(fitted)
    rows = fitted.transform(df).select("id", vector_to_array("features").alias("v")).collect()
    dense = {(r.id, w): r.v[j] for r in rows for j, w in enumerate(vocabulary) if r.v[j]}
    for i, d in enumerate(docs):
        raw = {w: d.count(w) * idf[w] for w in d}
        norm = math.sqrt(sum(x * x for x in raw.values()))
        for w in raw:
            assert got[i, w] == pytest.approx(raw[w] / norm)
            assert dense[i, w] == pytest.approx(raw[w] / norm)


def test_vectoriser_options(frame):
    df = frame(list(enumerate(TEXTS)), "id int, message string")
    words = set(features.vocabulary_of(features.fit_features(df, min_df=2, max_df=0.4)))
    assert words == {"dog", "cat", "day"}
    pairs = set(features.vocabulary_of(features.fit_features(df, ngram=(1, 2))))
    assert {"bad", "bad dog", "dog bad", "nice good"} <= pairs
    chars = set(features.vocabulary_of(features.fit_features(df, ngram=(1, 2), analyzer="char")))
    assert {"b", "ba", "d ", " d"} <= chars and all(len(c) <= 2 for c in chars)


def test_optimum_of_the_penalised_loss(small):
    """At the optimum the gradient of C * sum(loss) + |w|^2 / 2 is zero."""
    c = 2.0
    fit = models.fit_features(small)
    with models.prepared(small, fit, "toxic") as (train, n):
        lr = models.logistic(c, n, 500, tol=1e-10).fit(train)
        rows = train.select("y", vector_to_array("features").alias("v")).collect()
    x, y = np.array([r.v for r in rows]), np.array([r.y for r in rows])
    w = lr.coefficients.toArray()
    p = 1 / (1 + np.exp(-(x @ w + lr.intercept)))
    assert np.abs(c * x.T @ (p - y) + w).max() < 1e-3
    assert abs((p - y).sum()) < 1e-3


def test_scores_and_store(spark, small, model, tmp_path):
    scored = models.score(small, model)
    assert models.toxic_scores(scored)["f1"] == 1.0
    save_model(spark, model, str(tmp_path / "m"), frac=0.2, seed=42)
    loaded, kept = load_model(spark, str(tmp_path / "m"))
    assert kept == {"frac": 0.2, "seed": 42}
    again = models.score(small, loaded).select("id", F.col("probability").alias("p2"))
    assert scored.join(again, "id").filter("probability <> p2").count() == 0
    with pytest.raises(Exception):
        load_model(spark, str(tmp_path / "none"))


def test_unknown_and_missing_text(frame, model):
    df = frame([(1, "zzz"), (2, None), (3, "")], "id int, message string")
    got = {r.id: (r.probability, r.pred) for r in models.score(df, model).collect()}
    assert got[1] == got[3] and got[1][0] is not None and got[2] == (None, None)


def test_explanations_add_up(spark, small, model):
    rows = models.explain_score(small, model, 50).groupBy("id").agg(F.sum("contribution").alias("s"))
    both = rows.join(models.score(small, model), "id").collect()
    intercept = model.stages[-1].intercept
    for r in both:
        assert 1 / (1 + math.exp(-(r.s + intercept))) == pytest.approx(r.probability)
    top = models.top_terms(spark, model, 1).collect()
    assert {(r.side, r.term) for r in top} == {("toxic", "bad"), ("clean", "good")}


def test_cross_validation(small):
    fitted, table = models.fit_logistic_cv(small, k=3, grid=(0.001, 1.0, 100.0), min_df=1, max_df=1.0, max_iter=30)
    rows = table.collect()
    assert sum(r.chosen for r in rows) == 1 and max(r.accuracy for r in rows) == next(r.accuracy for r in rows if r.chosen)
    assert models.toxic_scores(models.score(small, fitted))["accuracy"] > 0.9


def test_grid(small):
    split = stratified_split(small, 0.3)
    table = models.grid_search(split, {"c": (0.1, 1.0), "ngram": ((1, 1), (1, 2))})
    assert table.count() == 4 and table.filter("best").count() == 1
    assert models.grid_search(split, {"c": (0.1, 1.0, 10.0)}, sample=2).count() == 2


def test_counts_model_on_a_grid_and_its_terms(spark, small):
    split = stratified_split(small, 0.3)
    table = models.grid_search(split, {"alpha": (0.1, 1.0), "min_df": (1, 2)}, family="naive_bayes")
    assert table.columns[0] == "alpha" and table.count() == 4 and table.filter("best").count() == 1
    assert {r.on_edge for r in table.filter("best").collect()} <= {"alpha,min_df"}
    fitted = models.fit_naive_bayes(small)
    top = {(r.side, r.term) for r in models.top_terms(spark, fitted, 1).collect()}
    assert ("toxic", "bad") in top and ("clean", "good") in top
    sums = {r.id: r.s for r in models.explain_score(small, fitted, 50).groupBy("id").agg(F.sum("contribution").alias("s")).collect()}
    prior = fitted.stages[-1].pi[1] - fitted.stages[-1].pi[0]
    for r in models.score(small, fitted).collect():
        assert 1 / (1 + math.exp(-(sums[r.id] + prior))) == pytest.approx(r.probability)


def test_other_models(small):
    for fitted in (models.fit_naive_bayes(small), models.fit_random_forest(small, trees=5, min_df=1, max_df=1.0)):
        assert models.toxic_scores(models.score(small, fitted))["accuracy"] > 0.9
    many = small.withColumn("label", (F.col("id") % 6).cast("int"))
    fitted = models.fit_multiclass(many, c=100.0, min_df=1, max_df=1.0)
    out = models.score_classes(many, fitted)
    assert {r.pred_label for r in out.collect()} == set(range(6))
    assert out.filter("pred_label = label").count() == 36


def test_distil_never_trains_on_human_rows(small):
    annotated = small.withColumn("verdict", F.col("toxic")).withColumn("status", F.lit("OK"))
    human = small.filter("id < 6")
    _, judged = models.distil(annotated, human, c=10.0)
    assert judged.count() == 6 and models.toxic_scores(judged)["accuracy"] == 1.0


def test_train_and_evaluate_use_the_same_split(spark, tmp_path):
    messages = tables.messages(spark, DATA)
    path = str(tmp_path / "m")
    trained = workflows.train_model(messages, path, frac=0.25, seed=5, k=2, grid=(1.0, 100.0), max_iter=10)
    judged = workflows.evaluate_model(messages, path)
    assert trained["report"].collect() == judged["report"].collect()
    rules = workflows.evaluate_rules(messages, tables.WORDS)
    assert rules["report"].count() == 5
    every = tables.names(spark, DATA)
    names = workflows.review_names(every.na.drop(), tables.WORDS, review=5)
    assert names["review"].count() == 5 and names["summary"].first().flagged >= 5
    by_model, _ = load_model(spark, path)
    assert workflows.review_names(every, model=by_model, order="id")["summary"].first().total == every.na.drop().count()


def test_quality_floors(spark):
    """Rules and a tuned character model on the labelled texts."""
    from chatsieve.operators.rules import rule_flag

    messages = tables.messages(spark, "/root/testdata/sf0.01")
    rules = models.toxic_scores(rule_flag(messages, tables.WORDS), pred="flagged")
    assert rules["precision"] == 1.0 and rules["f1"] > 0.78
    split = stratified_split(messages)
    fitted = models.fit_logistic(
        split.filter("split = 'train'"), c=100.0, min_df=3, max_df=0.2, ngram=(1, 4), analyzer="char"
    )
    learned = models.toxic_scores(models.score(split.filter("split = 'test'"), fitted))
    assert learned["f1"] > 0.6 and learned["accuracy"] > 0.9
