import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from chatsieve.operators import cost, nearest, skew
from chatsieve.functions.text import text_key


def test_verdicts(frame):
    replies = {
        '{"classification": "profane"}': ("OK", True),
        '{"classification": "clean"}': ("OK", False),
        '{"classification": "clean", "why": "x"}': ("OK", False),
        '{"classification": "Profane"}': ("INVALID", None),
        '{"classification": "profane"': ("INVALID", None),
        '{"verdict": "clean"}': ("INVALID", None),
        '{"classification": null}': ("INVALID", None),
        "clean": ("INVALID", None),
        "": ("BLOCKED", None),
        "  ": ("BLOCKED", None),
        None: ("BLOCKED", None),
    }
    df = frame([(i, r) for i, r in enumerate(replies)], "id int, reply string")
    got = {r.reply: (r.status, r.verdict) for r in cost.parse_verdict(df).collect()}
    assert got == replies


def cache_of(frame, known):
    rows = [(hashlib.sha256(t.encode()).hexdigest(), v) for t, v in known.items()]
    return frame(rows, "text_key string, verdict boolean")


def test_cache(frame):
    df = frame([(i, t) for i, t in enumerate(["a", "b", "a", "c", "c"])], "id int, message string")
    answers, misses = cost.cached_annotate(df, cache_of(frame, {"a": True, "z": False}))
    assert {(r.id, r.verdict, r.cache_hit) for r in answers.collect()} == {
        (0, True, True), (1, None, False), (2, True, True), (3, None, False), (4, None, False),
    }
    assert {(r.message, r.copies) for r in misses.collect()} == {("b", 1), ("c", 2)}


def test_annotation_asks_once_per_text_in_batches(frame, tmp_path):
    log = str(tmp_path / "asked")

    def classify(texts):
        with open(log, "a") as f:
            f.write(f"{len(texts)} {' '.join(texts)}\n")
        return [None if t == "t7" else '{"classification": "%s"}' % ("profane" if t < "t5" else "clean") for t in texts]

    rows = [(i, f"t{i % 9}") for i in range(200)]
    df = frame(rows, "id int, message string")
    done = cost.annotate(df, classify, cache_of(frame, {"t0": False}), size=3, parallel=2)
    got = {r.id: (r.status, r.verdict, r.cache_hit) for r in done.collect()}
    assert done.count() == 200
    for i, t in rows:
        want = ("OK", False, True) if t == "t0" else ("BLOCKED", None, False) if t == "t7" else ("OK", t < "t5", False)
        assert got[i] == want
    asked = [line.split() for line in open(log)]
    assert sorted(t for line in asked for t in line[1:]) == [f"t{i}" for i in range(1, 9)]
    assert all(int(line[0]) <= 3 for line in asked)


def test_nearest_vector_in_every_block_layout(frame):
    rng = np.random.default_rng(3)
    new, old = rng.normal(size=(40, 4)), rng.normal(size=(30, 4))
    old[7] = old[3]
    a = frame([(i, [float(x) for x in v]) for i, v in enumerate(new)], "id long, vector array<double>")
    b = frame([(i, [float(x) for x in v], i % 3 == 0) for i, v in enumerate(old)], "id long, vector array<double>, verdict boolean")
    unit = lambda m: m / np.linalg.norm(m, axis=1, keepdims=True)
    cosines = np.round(unit(new) @ unit(old).T, 9)
    for rows, cols, limit in ((None, None, 1 << 20), (50_000, 20_000, 0), (7, 4, 0), (7, 30, 0)):
        made = cost.semantic_cache(a, b, 0.8, new_rows=rows, cache_rows=cols, broadcast_bytes=limit)
        got = {r.id: (r.match_id, r.verdict) for r in made.collect()}
        assert len(got) == 40
        for i in range(40):
            best = int(cosines[i].argmax())
            assert got[i] == ((best, best % 3 == 0) if cosines[i, best] >= 0.8 else (None, None))


def test_capacity(frame):
    df = frame([("abcdefgh",)] * 3 + [("abcde",)], "message string")
    rows = {r.scope: r for r in cost.capacity_estimate(df, 2.0, 0.5, 30, messages_per_day=1000).collect()}
    assert (rows["all"].messages, rows["all"].tokens) == (4, 8)
    assert (rows["distinct"].messages, rows["distinct"].tokens) == (2, 4)
    assert rows["all"].day_tokens == 2000.0 and rows["all"].day_cost == 0.004
    assert rows["distinct"].serial_hours == round(500 * 0.5 / 3600, 4)


def test_lookup_join_with_a_hot_key(spark, monkeypatch):
    """A third of the rows share one key; both ways through the join give the same."""
    left = spark.range(3000).select(
        "id", F.when(F.col("id") % 3 == 0, "hot" * 60).otherwise(F.concat(F.lit("k"), (F.col("id") % 500).cast("string"))).alias("word")
    )
    lookup = left.groupBy("word").count().filter("word <> 'k7'")
    for how, n in (("inner", left.filter("word <> 'k7'").count()), ("left", 3000)):
        results = []
        for limit in (1000, 5):
            monkeypatch.setattr(skew, "HEAVY_KEYS", limit)
            out = skew.join_lookup(left, lookup, "word", "count", F.col("id"), how)
            results.append(sorted((r.id, r.word, r["count"]) for r in out.collect()))
        assert results[0] == results[1] and len(results[0]) == n


def test_hot_rows_are_spread(spark, monkeypatch):
    monkeypatch.setattr(skew, "HEAVY_KEYS", 2)
    left = spark.range(4000).select("id", F.when(F.col("id") % 2 == 0, "hot").otherwise(F.col("id").cast("string")).alias("word"))
    out = skew.join_lookup(left, left.groupBy("word").count(), "word", "count", F.col("id"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        sizes = [r["n"] for r in out.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sum(sizes) == 4000 and max(sizes) < 1400


def test_text_key_is_sha256(frame):
    assert frame([("é",)], "m string").select(text_key(F.col("m"))).first()[0] == hashlib.sha256("é".encode()).hexdigest()


def test_semantic_cache_of_vectors_without_direction(frame):
    a = frame([(1, [1.0, 0.0]), (2, [0.0, 0.0]), (3, None), (4, [0.0, 1.0])], "id long, vector array<double>")
    b = frame([(7, [0.0, 0.0], True), (8, [2.0, 0.1], True), (9, None, False)], "id long, vector array<double>, verdict boolean")
    for limit in (1 << 20, 0):
        got = {r.id: (r.match_id, r.verdict) for r in cost.semantic_cache(a, b, 0.9, broadcast_bytes=limit).collect()}
        assert got == {1: (8, True), 2: (None, None), 3: (None, None), 4: (None, None)}
    assert {r.match_id for r in cost.semantic_cache(a, b.limit(0), 0.9).collect()} == {None}


def test_semantic_cache_multiplies_few_pairs_of_clusters(spark):
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(30, 16))
    rows = centres[np.arange(600) % 30] + 0.05 * rng.normal(size=(600, 16))
    table = [(int(i), [float(x) for x in v], bool(i % 2)) for i, v in enumerate(rows)]
    vectors = spark.createDataFrame(table, "id long, vector array<double>, verdict boolean")
    new, cache = vectors.filter("id >= 300"), vectors.filter("id < 300")
    unit = rows / np.linalg.norm(rows, axis=1, keepdims=True)
    cosines = np.round(unit[300:] @ unit[:300].T, 9)
    got = {r.id: r.match_id for r in cost.semantic_cache(new, cache, 0.95, cache_rows=7, new_rows=9, broadcast_bytes=0).collect()}
    assert all(got[300 + i] == (int(cosines[i].argmax()) if cosines[i].max() >= 0.95 else None) for i in range(300))


def test_missing_texts_keep_their_rows_and_are_not_sent(frame):
    def classify(texts):
        assert None not in texts
        return ['{"classification": "clean"}'] * len(texts)

    df = frame([(1, "a"), (2, None), (3, "b")], "id long, message string")
    got = {r.id: r.status for r in cost.annotate(df, classify, cache_of(frame, {"b": True})).collect()}
    assert got == {1: "OK", 2: "NO_TEXT", 3: "OK"}
    assert cost.cached_annotate(df, cache_of(frame, {"z": True}))[1].count() == 2


@pytest.mark.parametrize("kind", ["even", "flat", "few"])
def test_pairs_are_ruled_out_by_the_first_dimensions_alone(kind):
    """The nearest by full products, for vectors that the bound helps a lot, little and not."""
    rng = np.random.default_rng(2)
    size = {"even": np.ones(48), "flat": 0.7 ** np.arange(48), "few": np.ones(3)}[kind]
    mix = np.linalg.qr(rng.normal(size=(len(size), len(size))))[0]
    known, asked = rng.normal(size=(700, len(size))) * size, rng.normal(size=(2100, len(size))) * size
    known[400] = known[30]
    asked[:700] = known + 0.1 * rng.normal(size=known.shape) * size
    known, asked = (m @ mix / np.linalg.norm(m, axis=1, keepdims=True) for m in (known, asked))
    full = np.round(asked @ known.T, 9)
    for threshold in (0.3, 0.9, 0.999):
        place, cosine = nearest.Listed(known, nearest.Turn.of(known[:128])).best(asked, threshold)
        want = np.where(full.max(axis=1) >= threshold, full.argmax(axis=1), -1)
        assert (place == want).all()
        assert np.abs(cosine - full.max(axis=1))[place >= 0].max(initial=0) <= 1.1e-9


def test_texts_without_an_id_and_with_a_shared_one_are_sent_once_each(frame):
    df = frame([(None, "a"), (None, "a"), (1, "b"), (1, "c"), (None, "d"), (2, "d"), (3, "k")], "id long, message string")
    misses = cost.cached_annotate(df, cache_of(frame, {"k": True}))[1].collect()
    assert sorted((r.message, r.copies) for r in misses) == [("a", 2), ("b", 1), ("c", 1), ("d", 2)]
    done = cost.annotate(df, lambda texts: ['{"classification": "clean"}'] * len(texts), cache_of(frame, {"k": True})).collect()
    assert len(done) == 7 and {r.status for r in done} == {"OK"}


def test_annotation_goes_on_from_its_journal(spark, frame, tmp_path):
    """The model breaks down in the third wave; a second run asks only for what is missing."""
    log, journal, broken = str(tmp_path / "asked"), str(tmp_path / "journal"), tmp_path / "broken"
    broken.write_text("yes")

    def classify(texts):
        with open(log, "a") as f:
            f.write("".join(t + "\n" for t in texts))
        if broken.exists() and len(open(log).read().split()) > 20:
            raise RuntimeError("out of quota")
        return ['{"classification": "clean"}'] * len(texts)

    df = frame([(i, f"t{i}") for i in range(60)], "id int, message string")
    options = {"size": 2, "parallel": 2, "calls_per_task": 2, "journal": journal}
    with pytest.raises(Exception, match="out of quota"):
        cost.annotate(df, classify, cache_of(frame, {"none": True}), **options)
    kept = {r.text_key for r in spark.read.parquet(journal).collect()}
    assert 0 < len(kept) < 60
    broken.unlink()
    open(log, "w").close()
    done = cost.annotate(df, classify, cache_of(frame, {"none": True}), **options)
    assert {r.status for r in done.collect()} == {"OK"} and done.count() == 60
    again = open(log).read().split()
    assert len(again) == len(set(again)) == 60 - len(kept)
    cost.annotate(df, classify, cache_of(frame, {"none": True}), **options)
    assert open(log).read().split() == again


def test_calls_keep_to_the_rate(frame, tmp_path):
    log = str(tmp_path / "times")

    def classify(texts):
        import time

        with open(log, "a") as f:
            f.write(f"{time.time()}\n")
        return ['{"classification": "clean"}'] * len(texts)

    df = frame([(i, f"t{i}") for i in range(8)], "id int, message string")
    cost.annotate(df, classify, cache_of(frame, {"none": True}), size=2, parallel=1, per_minute=120)
    times = sorted(map(float, open(log).read().split()))
    assert len(times) == 4 and all(b - a > 0.45 for a, b in zip(times, times[1:]))


def test_search_holds_few_pairs_at_once_and_ties_go_to_the_first():
    """Many likely pairs: one row block against 40,000 vectors stays far below a number per pair."""
    import tracemalloc

    from chatsieve.operators.nearest import Listed, Turn

    rng = np.random.default_rng(11)
    rows = np.abs(rng.normal(size=(40_000, 12))) + 0.5
    rows[30_000:] = rows[:10_000]  # copies in another tile
    rows /= np.linalg.norm(rows, axis=1, keepdims=True)
    asked = rows[rng.integers(0, 40_000, 1024)] + 0.01 * rng.normal(size=(1024, 12))
    asked /= np.linalg.norm(asked, axis=1, keepdims=True)
    listed = Listed(rows, Turn.of(rows[:128]))
    tracemalloc.start()
    place, cosine = listed.best(asked, 0.6)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    full = np.round(asked @ rows.T, 9)
    assert (place == full.argmax(axis=1)).all() and (place < 30_000).all()
    assert np.allclose(cosine, full.max(axis=1), atol=2e-9)
    assert peak < 1024 * 40_000 * 4 * 0.75
