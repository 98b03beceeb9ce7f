"""The stages of the pipeline on a small table with known copies, passages and leaks."""

import random

import pytest

import corpus_pipeline

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept string, start long, _gone long"


def prose(rng, n):
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randrange(2, 8))) for _ in range(n))


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    rng = random.Random(6)
    item, passage, copied = prose(rng, 30), prose(rng, 60), prose(rng, 200)
    texts = [prose(rng, rng.randrange(30, 120)) for _ in range(40)]
    texts += [copied, copied, copied.replace(copied.split()[50], "changed", 1)]  # 40, 41, 42
    texts += [f"{prose(rng, 40)} {passage} {prose(rng, 20)}" for _ in range(3)]  # 43, 44, 45
    texts += [f"{prose(rng, 10)} {item} {prose(rng, 10)}", None, "", "12 34", "жук " * 60, "word " * 3000]  # 46 ..
    rows = [(i, t, None if i == 50 else "aa", "s", len(t or ""), "k", 1, 2) for i, t in enumerate(texts)]
    folder = str(tmp_path_factory.mktemp("tables"))
    spark.createDataFrame(rows, SCHEMA).repartition(2).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(0, item)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder, texts, passage


def test_stages(spark, tables):
    folder, texts, passage = tables
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    seen = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, folder)
        assert out.columns == docs.columns
        docs = spark.createDataFrame(out.collect(), docs.schema)
        seen[name] = {r.doc_id: r.text for r in docs.collect()}
    every = set(range(len(texts)))
    assert set(seen["language_id"]) == every - {47, 48, 49, 50}
    assert set(seen["near_dedup"]) == set(seen["language_id"]) - {41, 42}
    assert set(seen["substring_dedup"]) == set(seen["near_dedup"])
    cut = seen["substring_dedup"]
    assert cut[43] == texts[43] and all(cut[i] == texts[i].replace(passage + " ", "") for i in (44, 45))
    assert all(cut[i] == texts[i] for i in range(41))
    assert set(seen["decontamination"]) == set(cut) - {46}


def test_run_packs_what_is_left_and_empty_tables_pass(spark, tables):
    folder, texts, _ = tables
    packed = corpus_pipeline.run(spark, folder)
    assert {r.doc_id for r in packed.collect()} == set(range(len(texts))) - {41, 42, 46, 47, 48, 49, 50}
    docs = spark.read.parquet(f"{folder}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, folder).count() == 0


def test_repeated_rows_that_lose_a_passage_stay_a_row_each(spark, tables):
    _, _, passage = tables
    texts = [(1, f"first {passage}"), (2, f"some {passage} more"), (2, f"some {passage} more"), (3, "short"), (3, "short")]
    docs = spark.createDataFrame([(i, t, "aa", "s", len(t), "k", 1, 2) for i, t in texts], SCHEMA).coalesce(1)
    got = sorted((r.doc_id, r.text, r.n_chars) for r in corpus_pipeline.substring_stage(spark, docs, "").collect())
    assert got == [(1, f"first {passage}", len(passage) + 6), (2, "some more", 9), (2, "some more", 9), (3, "short", 5), (3, "short", 5)]


def rows_of(spark, rows, schema=SCHEMA):
    return spark.createDataFrame([(i, t, "aa", "s", len(t or ""), "k", 1, 2) for i, t in rows], schema).coalesce(2)


def left(out):
    return sorted(((r.doc_id, r.text) for r in out.collect()), key=repr)


def test_rows_are_judged_by_their_own_text(spark, tables):
    """An id that repeats or is missing takes no other row with it."""
    folder, texts, passage = tables
    rng = random.Random(2)
    item = next(iter(spark.read.parquet(f"{folder}/benchmark.parquet").collect())).text
    same, lone = prose(rng, 60), prose(rng, 60)
    near = rows_of(spark, [(1, same), (2, same), (2, lone), (None, same), (None, prose(rng, 50))])
    assert [i for i, _ in left(corpus_pipeline.near_dedup_stage(spark, near, folder))] == [1, 2, None]
    assert (2, lone) in left(corpus_pipeline.near_dedup_stage(spark, near, folder))
    leaks = rows_of(spark, [(1, f"a {item} b"), (1, lone), (None, f"c {item}"), (None, same)])
    assert left(corpus_pipeline.decontamination_stage(spark, leaks, folder)) == [(1, lone), (None, same)]
    cut = rows_of(spark, [(1, passage), (2, f"{passage} tail"), (2, lone), (None, passage)])
    assert left(corpus_pipeline.substring_stage(spark, cut, folder)) == sorted([(1, passage), (2, "tail"), (2, lone), (None, passage)], key=repr)
    plain = [(i, texts[i]) for i in range(40)]
    langs = rows_of(spark, plain + [(5, "12 34"), (None, "56 78"), (None, lone), (7, None)])
    assert left(corpus_pipeline.language_stage(spark, langs, folder)) == sorted(plain + [(None, lone)], key=repr)


def test_columns_with_the_names_used_inside(spark, tables):
    folder, texts, passage = tables
    schema = "doc_id long, text string, lang string, source string, n_chars long, row_key string, member long, class_id long"
    rows = [(1, f"{passage} x"), (2, f"y {passage}"), (3, texts[0]), (4, texts[0])]
    for names in (schema, schema.replace("member", "cut_id").replace("class_id", "Row_Key_"), schema.replace("member", "_doc_id").replace("class_id", "_kept")):
        docs = rows_of(spark, rows, names)
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, folder)
            assert out.columns == docs.columns and out.count() >= 2
