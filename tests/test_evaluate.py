from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from chatsieve.operators import evaluate, mining


def predictions(frame, pairs):
    return frame([(i, t, p) for i, (t, p) in enumerate(pairs)], "id int, toxic boolean, flagged boolean")


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.booleans(), st.booleans()), max_size=30))
def test_report_by_hand(frame, pairs):
    df = predictions(frame, pairs)
    four = evaluate.confusion(df).first()
    c = Counter(pairs)
    assert (four.tp, four.fp, four.fn, four.tn) == (c[True, True], c[False, True], c[True, False], c[False, False])
    report = {r["class"]: r for r in evaluate.classification_report(df).collect()}
    quotient = lambda a, b: a / b if b else 0.0
    p, r = quotient(four.tp, four.tp + four.fp), quotient(four.tp, four.tp + four.fn)
    assert report["Profane"].precision == pytest.approx(p, abs=1e-6)
    assert report["Profane"].recall == pytest.approx(r, abs=1e-6)
    assert report["Profane"].f1 == pytest.approx(quotient(2 * p * r, p + r), abs=1e-6)
    assert report["accuracy"].precision == pytest.approx(quotient(four.tp + four.tn, len(pairs)), abs=1e-6)
    assert report["Clean"].support + report["Profane"].support == len(pairs)


def test_empty_input_has_null_rates(frame):
    empty = frame([], "id int, flagged boolean")
    row = evaluate.flag_summary(empty).first()
    assert row.total == 0 and row.flagged_pct is None
    stats = evaluate.label_stats(frame([], "label int")).collect()
    assert len(stats) == 9 and all(r.pct is None for r in stats)


def test_label_stats_shows_unused_labels(frame):
    stats = {r.name: (r.n, r.pct) for r in evaluate.label_stats(frame([(0,), (0,), (4,), (0,)], "label int")).collect()}
    assert stats["THREATS"] == (1, 25.0) and stats["EXTREMISM"] == (0, 0.0)
    assert stats["TOXIC"] == (1, 25.0) and stats["CLEAN"] == (3, 75.0) and stats["TOTAL"] == (4, 100.0)


def test_projection_truncates(frame):
    df = frame([(i, i < 15) for i in range(40)], "id int, flagged boolean")
    reviewed = frame([(0, True), (1, False), (2, True), (3, True), (39, True)], "id int, offensive boolean")
    row = evaluate.precision_projection(df, reviewed).first()
    assert (row.flagged, row.reviewed, row.offensive, row.precision) == (15, 4, 3, 0.75)
    assert (row.estimate_high, row.estimate_medium, row.estimate_reviewed) == (int(15 * 0.9), int(15 * 0.5), 11)


def test_triage_bands(frame):
    rows = [("en", i < 5) for i in range(100)] + [("de", False)] * 100 + [("fr", i < 1) for i in range(200)]
    out = {r.lang: r.verdict for r in evaluate.rate_triage(frame(rows, "lang string, flagged boolean")).collect()}
    assert out == {"en": "suspect_false_positives", "de": "suspect_false_negatives", "fr": "in_band"}
    wide = evaluate.rate_triage(frame(rows, "lang string, flagged boolean"), bands={"en": (0.01, 0.1)})
    assert {r.lang: r.verdict for r in wide.collect()}["en"] == "in_band"


def test_side_by_side_and_comparison(frame):
    df = predictions(frame, [(True, True), (True, False), (False, False), (False, True)])
    wide = evaluate.side_by_side({"a": df, "b": df.withColumn("flagged", F.lit(True))})
    assert wide.count() == 4 and wide.filter("a and b").count() == 2
    table = {r["filter"]: r for r in evaluate.filter_comparison(wide.join(df.select("id", "toxic"), "id"), ["a", "b"]).collect()}
    assert table["all_clean"].accuracy == 0.5 and table["all_clean"].f1 == 0.0
    assert table["b"].recall == 1.0 and table["a"].precision == 0.5


def test_disagreements(frame):
    a = predictions(frame, [(True, True), (True, False), (False, False), (False, True)])
    b = predictions(frame, [(True, True), (True, True), (False, False), (False, True)]).select("id", "flagged")
    assert {r.id for r in mining.disagreements(a, b).collect()} == {1, 3}
    assert mining.disagreements(a, b, n=1).count() == 1


def test_union_of_data_sets_keeps_all_columns(frame):
    out = mining.union_datasets({"x": frame([(1, "a")], "id int, message string"), "y": frame([(2, "b", 3)], "id int, message string, label int")})
    assert {(r.id, r.dataset, r.label) for r in out.collect()} == {(1, "x", None), (2, "y", 3)}


def test_annotation_report(frame):
    rows = [(True, "OK", True, 0.5), (False, "OK", True, 0.7), (True, "BLOCKED", None, 9.0), (True, "INVALID", None, 9.0)]
    row = evaluate.annotation_report(frame(rows, "toxic boolean, status string, verdict boolean, latency_s double")).first()
    assert (row.answered, row.blocked, row.invalid, row.correct) == (2, 1, 1, 1)
    assert (row.latency_avg, row.latency_min, row.latency_max) == (0.6, 0.5, 0.7)


def test_coarse_labels(frame):
    df = frame([(1, 0), (2, 3), (3, 5), (4, None)], "id int, label int")
    got = {r.id: r.coarse for r in evaluate.coarse_label(df, {0: "clean", 3: "hate"}).collect()}
    assert got == {1: "clean", 2: "hate", 3: "other", 4: None}
    table = frame([(3, "hate"), (3, "b"), (5, "x")], "label int, class string")
    assert {r.id: r.coarse for r in evaluate.coarse_label(df, table, rest="-").collect()} == {1: "-", 2: "b", 3: "x", 4: None}


def test_precision_projection_makes_the_names_once(spark, monkeypatch):
    from chatsieve.plans import queries

    made = []
    monkeypatch.setattr(queries, "settled", lambda df, name, keep=queries.settled: made.append(name) or keep(df, name))
    out = queries.QUERIES["precision_projection"](spark, "/root/testdata/sf0.001")
    assert made == ["flagged"] and "regexp_extract_all" not in out._jdf.queryExecution().optimizedPlan().toString()
