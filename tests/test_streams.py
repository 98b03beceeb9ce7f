import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from chatsieve.operators.rules import censor, rule_flag
from chatsieve.streaming import moderation

SCHEMA = "msg_id int, ts timestamp, lang string, text string"


def folder(frame, tmp_path, batches):
    """A folder of files, read one file per step in order of age."""
    import os

    path = str(tmp_path / "in")
    for i, rows in enumerate(batches):
        frame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(path)
        for name in os.listdir(path):
            full = os.path.join(path, name)
            if name.endswith(".parquet") and os.path.getmtime(full) > 1e9 + 1e6:
                os.utime(full, (1e9 + i * 60, 1e9 + i * 60))
    return path


def at(hour, minute):
    return datetime(2024, 1, 1, hour, minute)


def stream_of(spark, path):
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(path)


def test_stream_equals_batch(spark, frame, tmp_path):
    rows = [(i, at(0, i), "en", t) for i, t in enumerate(["you idiot", "hello", "IDIOT idiot", "idiots"])]
    path = folder(frame, tmp_path, [rows[:2], rows[2:]])
    out = moderation.drain(moderation.stream_moderate(stream_of(spark, path), ["idiot"]), "t1")
    batch = censor(rule_flag(frame(rows, SCHEMA), ["idiot"], text="text"), ["idiot"], text="text")
    assert sorted(out.collect()) == sorted(batch.collect())


def test_rates_of_closed_windows_without_late_rows(spark, frame, tmp_path):
    first = [(1, at(0, 5), "en", "idiot"), (2, at(0, 50), "en", "x"), (3, at(1, 30), "de", "x")]
    late = [(5, at(0, 55), "en", "idiot"), (6, at(3, 0), "en", "x")]
    path = folder(frame, tmp_path, [first, [(4, at(1, 40), "de", "x")], late])
    flagged = rule_flag(stream_of(spark, path), ["idiot"], text="text")
    out = moderation.drain(moderation.stream_flag_rate(flagged), "t2")
    got = {(r.window_start.hour, r.lang): (r.total, r.flagged, r.verdict) for r in out.collect()}
    assert got == {(0, "en"): (2, 1, "suspect_false_positives"), (1, "de"): (2, 0, "suspect_false_negatives")}


def test_repeats_within_the_horizon(spark, frame, tmp_path):
    path = folder(
        frame, tmp_path, [[(1, at(0, 0), "en", "a"), (2, at(0, 1), "en", "a")], [(3, at(0, 30), "en", "a"), (4, at(0, 30), "en", "b")]]
    )
    out = moderation.drain(moderation.stream_dedupe(stream_of(spark, path), "1 hour"), "t3")
    assert sorted(r.text for r in out.select("text").collect()) == ["a", "b"]
    assert out.filter(F.col("text_key").isNull()).count() == 0


def plain_dedupe(stream, horizon):
    keyed = stream.withColumn("text_key", F.sha2("text", 256))
    return keyed.withWatermark("ts", horizon).dropDuplicatesWithinWatermark(["text_key"])


def test_a_repeat_past_the_horizon_passes_again(spark, frame, tmp_path):
    """A copy at 50 minutes does not pass, and so does not hold back the one at 70."""
    steps = [[(1, at(0, 0), "en", "a")], [(2, at(0, 50), "en", "a")], [(3, at(2, 6), "en", "b")], [(4, at(2, 6), "en", "b")]]
    steps.append([(5, at(1, 10), "en", "a")])
    path = folder(frame, tmp_path, steps)
    got = {r.msg_id for r in moderation.drain(moderation.stream_dedupe(stream_of(spark, path), "1 hour"), "t4").collect()}
    want = {r.msg_id for r in moderation.drain(plain_dedupe(stream_of(spark, path), "1 hour"), "t4").collect()}
    assert got == want == {1, 3, 5}


def test_dedupe_equals_the_built_in_one_on_random_streams(spark, frame, tmp_path):
    rng = random.Random(5)
    n = 0
    for turn in range(3):
        steps = []
        for step in range(9):
            rows = []
            for _ in range(rng.randrange(1, 14)):
                n += 1
                when = at(1, 0) + timedelta(minutes=step * 25 + rng.randrange(-60, 60))
                rows.append((n, when, "en", rng.choice(["a", "b", "c", "d", None, ""])))
            steps.append(rows)
        (tmp_path / str(turn)).mkdir()
        path = folder(frame, tmp_path / str(turn), steps)
        got, want = (
            {(r.msg_id, r.text_key) for r in moderation.drain(made, "t5").collect()}
            for made in (moderation.stream_dedupe(stream_of(spark, path), "1 hour"), plain_dedupe(stream_of(spark, path), "1 hour"))
        )
        assert got == want and len(got) > 9


def test_a_text_that_everybody_sends_is_combined_before_the_shuffle(spark):
    many = spark.range(20_000).repartition(4).selectExpr(
        "CAST(id AS INT) AS msg_id", "timestamp_seconds(id % 977) AS ts", "'en' AS lang", "'hello' AS text"
    )
    kept = moderation.first_copies(many.withColumn("text_key", F.sha2("text", 256)))
    assert kept.count() <= 8 and kept.agg(F.max(F.unix_timestamp("ts"))).first()[0] == 976


def test_a_model_whose_weights_are_a_table_scores_a_stream(spark, frame, tmp_path, monkeypatch):
    from chatsieve.operators import features, models, term_models

    said = [("you idiot", True), ("hello there you", False), ("idiot idiot fool", True), ("", False), (None, False)] * 3
    rows = [(i, at(0, i), "en", text) for i, (text, _) in enumerate(said)]
    path = folder(frame, tmp_path, [rows[:7], rows[7:]])
    labelled = frame([(i, t, y) for i, (t, y) in enumerate(said)], "id int, message string, toxic boolean")
    monkeypatch.setattr(features, "MAX_VOCABULARY", 2)
    for k, model in enumerate([models.fit_naive_bayes(labelled, 1.0), models.fit_logistic(labelled, ngram=(1, 2))]):
        assert isinstance(model, term_models.TermModel)
        stream = stream_of(spark, path).select(F.col("msg_id").alias("id"), F.col("text").alias("message"))
        live = moderation.drain(moderation.stream_score(stream, model).select("id", "probability"), f"t5{k}")
        got = {r.id: r.probability for r in live.collect()}
        with monkeypatch.context() as joined:
            joined.setattr(term_models, "LOOKED_UP", 0)
            want = {r.id: r.probability for r in models.score(labelled, model).collect()}
        assert got.keys() == want.keys() and len(got) == 15
        assert all((got[i] is None) == (want[i] is None) and (want[i] is None or abs(got[i] - want[i]) < 1e-12) for i in want)
