import hashlib
from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from chatsieve.operators import sampling


def md5(seed, i):
    return hashlib.md5(f"{seed}:{i}".encode()).hexdigest()


def test_split_takes_the_lowest_hashes_of_each_class(frame):
    rows = [(i, i % 7 == 0) for i in range(3000)]
    df = frame(rows, "id int, toxic boolean")
    for frac in (0.2, 0.0, 1.0, 0.333):
        got = {r.id for r in sampling.stratified_split(df, frac, seed=7).filter("split = 'test'").collect()}
        want = set()
        for label in (True, False):
            ids = sorted((i for i, t in rows if t == label), key=lambda i: md5(7, i))
            want.update(ids[: round(len(ids) * frac)])
        assert got == want
    assert sampling.stratified_split(df, 0.2).count() == 3000


def test_split_of_many_classes(frame, monkeypatch):
    rows = [(i, i * 31 % 37 or None) for i in range(1500)]
    df = frame(rows, "id int, toxic int")
    few = {(r.id, r.split) for r in sampling.stratified_split(df, 0.3).collect()}
    monkeypatch.setattr(sampling, "MAX_CLASSES", 10)
    assert {(r.id, r.split) for r in sampling.stratified_split(df, 0.3).collect()} == few and len(few) == 1500


def test_folds_are_even(frame):
    df = frame([(i, i % 9 == 0) for i in range(1000)], "id int, toxic boolean")
    sizes = Counter((r.toxic, r.fold) for r in sampling.stratified_folds(df, 5).collect())
    for label in (True, False):
        per_fold = [sizes[label, f] for f in range(5)]
        assert max(per_fold) - min(per_fold) <= 1


def test_sample_and_head(frame):
    df = frame([(i,) for i in range(100)], "id int")
    assert [r.id for r in sampling.seeded_sample(df, 5).collect()] == sorted(range(100), key=lambda i: md5(42, i))[:5]
    assert sampling.seeded_sample(df, 500).count() == 100
    assert [r.id for r in sampling.head_rows(df, 3).collect()] == [0, 1, 2]


def test_batches(frame):
    df = frame([(i, f"m{i}") for i in range(1050)], "id long, message string")
    batches = sampling.request_batches(df, 100, 3).collect()
    assert all(b.n == len(b["items"]) <= 100 for b in batches)
    assert sorted(i.id for b in batches for i in b["items"]) == list(range(1050))
    assert len(batches) <= 1050 // 100 + 3


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.lists(st.tuples(st.integers(0, 2), st.integers(-30, 60)), max_size=60, unique=True),
    st.integers(1, 4),
    st.sampled_from([0, 8, 100]),
)
def test_context_across_cuts(frame, keys, k, hot_rows):
    df = frame([(c, t, f"{c}:{t}") for c, t in keys], "conv_id int, turn int, text string")
    got = {(r.conv_id, r.turn): r.context for r in sampling.with_context(df, k, hot_rows=hot_rows).collect()}
    want = {}
    for c, t in keys:
        before = sorted(u for d, u in keys if d == c and u < t)[-k:]
        want[c, t] = " | ".join(f"{c}:{u}" for u in before)
    assert got == want
    assert len(got) == len(keys)


@pytest.mark.parametrize("n", [0, 1])
def test_tiny_tables(frame, n):
    df = frame([(i, True) for i in range(n)], "id int, toxic boolean")
    assert sampling.stratified_split(df).count() == n
    assert sampling.stratified_folds(df).count() == n
    assert df.withColumn("x", F.lit(1)).count() == n


def test_context_of_many_long_conversations_with_sparse_turns(spark):
    """5,000 conversations above the limit, one of them with a third of all rows, and an id that
    is missing; turns lie a million apart."""
    rows = spark.range(150_000).selectExpr(
        "CASE WHEN id % 3 = 0 THEN -1 WHEN id % 3000 = 1 THEN NULL ELSE id % 5000 END AS conv_id", "id * 1000000 AS turn", "CAST(id AS STRING) AS text"
    )
    made = sampling.with_context(rows, 2, hot_rows=5)
    order = "PARTITION BY conv_id ORDER BY turn"
    want = f"concat_ws(' | ', lag(text, 2) OVER ({order}), lag(text, 1) OVER ({order}))"
    assert made.count() == 150_000
    assert made.selectExpr("context", f"{want} AS want").filter("context <> want OR context IS NULL").count() == 0
    plain = sampling.with_context(rows, 2)
    assert plain.exceptAll(made).count() == 0


def test_a_long_conversation_is_shared_by_tasks(spark):
    rows = spark.range(20_000).selectExpr("7 AS conv_id", "id * 1000000 AS turn", "'x' AS text")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        made = sampling.with_context(rows, 2, hot_rows=100)
        sizes = [r.n for r in made.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sum(sizes) == 20_000 and max(sizes) < 16_000
