"""Fill-in-the-middle against slices of the text and an exact round trip."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from chatsieve.llm.infill import fill_in_middle, restored

SCHEMA = "doc_id long, text string, h string, n string, output string, form string"
ODD = [
    None, "", "a", "\n", "é", "é \U0001f600‍\U0001f600", "<P>", "x<S>y", "<M", "<<P", "a<", ">b", "<P<S<M", "S>P>M>",
    "two\r\nlines", " \x85\x0b", "\x00nul", "<p>", "�" * 30,
]


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(2)
    texts = ODD + ["".join(rng.choice("ab <PSM>é\n\U0001f600") for _ in range(rng.randrange(60))) for _ in range(300)]
    texts += ["word " * 60_000, "x" * 400_000]
    out = [(i, t) for i, t in enumerate(texts)]
    return out + [(3, "\n"), (3, "another text of id 3"), (None, "no id"), (-5, "a negative id"), (2**62, "a large id")]


def expected(doc_id, text):
    text = text or ""
    n, digest = len(text), hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[k : k + 8], 16) for k in (0, 8, 16, 24)]
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = text[:a], text[a:b], text[b:]
    if h[3] % 100 < 20:
        return n, "spm", a, b - a, f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", a, b - a, f"<P>{p}<S>{s}<M>{m}"


def frame_of(spark, rows):
    return spark.createDataFrame([(i, t, "h", "n", "o", "psm") for i, t in rows], SCHEMA).repartition(3)


def test_forms_and_round_trip(spark, rows):
    made = fill_in_middle(frame_of(spark, rows)).withColumn("back", restored(F.col("output"), F.col("form"))).collect()
    got = sorted(((r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output, r.back) for r in made), key=repr)
    want = sorted(((i, *expected(i, t), t or "") for i, t in rows), key=repr)
    assert got == want
    assert {r.form for r in made} == {"plain", "psm", "spm"}


def test_other_units(spark):
    lines = "one\n\ntwo three\nfour"
    data = frame_of(spark, [(i, lines) for i in range(200)] + [(200, ""), (201, "\n")])
    made = fill_in_middle(data, unit=r"[^\n]*\n|[^\n]+", cut_percent=100, sentinels=("[pre]", "[suf]", "[mid]"))
    back = restored(F.col("output"), F.col("form"), ("[pre]", "[suf]", "[mid]"))
    got = made.withColumn("back", back).collect()
    starts = [0, 4, 5, 15, len(lines)]
    for r in got:
        assert r.back == (lines if r.doc_id < 200 else "" if r.doc_id == 200 else "\n")
        if r.doc_id < 200:
            assert r.n == 4 and r.prefix_chars == starts[r.prefix_units]
            assert r.prefix_chars + r.middle_chars == starts[r.prefix_units + r.middle_units]
    assert len({(r.prefix_units, r.middle_units) for r in got if r.doc_id < 200}) == 15


def test_text_that_is_not_made_of_units_is_plain(spark):
    (row,) = fill_in_middle(frame_of(spark, [(1, "ab1")]), unit="[a-z]", cut_percent=100).collect()
    assert (row.n, row.form, row.prefix_chars, row.output) == (None, "plain", None, "ab1")


@pytest.mark.parametrize("marks", [("<P>", "<P>", "<M>"), ("<P>", "", "<M>"), ("ab", "ba", "x"), ("<P>", "a<P>b", "x"), ("aba", "x", "y")])
def test_control_strings_that_overlap_are_refused(spark, marks):
    with pytest.raises(ValueError):
        fill_in_middle(frame_of(spark, [(1, "a")]), sentinels=marks)


def test_empty_table_and_few_columns(spark):
    assert fill_in_middle(frame_of(spark, [(1, "a")]).limit(0)).count() == 0
    assert fill_in_middle(spark.createDataFrame([(1, "a b")], "doc_id int, text string")).count() == 1
