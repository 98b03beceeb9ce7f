"""Matches of word lists of every length against a walk over the text."""

import random
from itertools import groupby

import pytest

from chatsieve.functions.patterns import fold, is_word_char
from chatsieve.operators import matching, rules

ENTRIES = ["ass", "aß", "bad dog", "bad", "dog bad ", "ς", "a$$", "$$", "x-y", "o", "é o", "bad dog o", "++c", "straße"]
LETTERS = "abdogsxyß ẞſςΣσéÉ$-+ \t_1"


def units(text, mode):
    return list(text) if mode == "substring" else ["".join(g) for _, g in groupby(text, is_word_char)]


def by_walk(text, entries, mode):
    """(start, end, entry) from left to right, the longest entry at each place."""
    low = fold(text)
    u = units(low, mode)
    starts = [sum(map(len, u[:i])) for i in range(len(u) + 1)]
    listed = {fold(e.strip()) for e in entries}
    out, i = [], 0
    while i < len(u):
        ends = []
        for j in range(i + 1, len(u) + 1):
            key = "".join(u[i:j])
            inner = mode == "substring" or (is_word_char(key[0]) or i > 0) and (is_word_char(key[-1]) or j < len(u))
            if key in listed and inner:
                ends.append(j)
        if ends:
            out.append((starts[i], starts[ends[-1]], low[starts[i] : starts[ends[-1]]]))
            i = ends[-1]
        else:
            i += 1
    return out


def some_texts(n):
    rng = random.Random(1)
    parts = ["bad", "dog", "ASS", "Bad Dog", "aẞ", "aſſ", "a$$x", "x-Y", "É O", "c++c", "ΜΑΣ", "Σ", "STRAẞE", "$$", " "]
    out = ["".join(rng.choice(LETTERS) for _ in range(rng.randrange(14))) for _ in range(n // 2)]
    out += [" ".join(rng.choice(parts) for _ in range(rng.randrange(8))) for _ in range(n // 2)]
    return out + [None, "", "bad dog bad dog o bad", "dog bad dog", "bad dog o" * 40, "nothing here"]


@pytest.mark.parametrize("mode", ["boundary", "substring"])
@pytest.mark.parametrize("filler, limit", [(0, 20_000), (120, 20_000), (120, 50)])
def test_lists_and_tables_match_alike(frame, monkeypatch, mode, filler, limit):
    texts = some_texts(160)
    df = frame(list(enumerate(texts)), "id int, message string")
    words = ENTRIES + [f"filler {k}x" for k in range(filler)]
    monkeypatch.setattr(matching, "ROW_LOCAL_WORDS", limit)
    given = [words] if limit == 20_000 else [words, frame([(w,) for w in words] + [("Bad",), (" ",), (None,)], "word string")]
    walks = {i: by_walk(t, ENTRIES, mode) for i, t in enumerate(texts) if t is not None}
    for listed in given:
        got = {}
        for r in rules.explain_match(df, listed, mode).orderBy("id", "hit_no").collect():
            got.setdefault(r.id, []).append((r.start_pos - 1, r.end_pos, r.rule))
            assert r.matched == texts[r.id][r.start_pos - 1 : r.end_pos] and fold(r.matched) == r.rule
        assert got == {i: w for i, w in walks.items() if w}
        for per_char in (False, True):
            done = {r.id: r.censored for r in rules.censor(df, listed, mode, per_char).collect()}
            for i, text in enumerate(texts):
                want = text
                for start, end, _ in reversed(walks.get(i, [])):
                    want = want[:start] + ("*" * (end - start) if per_char else "***") + want[end:]
                assert done[i] == want
        flagged = {r.id: r.flagged for r in rules.rule_flag(df, listed, mode).collect()}
        assert flagged == {i: None if t is None else bool(walks[i]) for i, t in enumerate(texts)}


@pytest.mark.parametrize("limit", [20_000, 3])
def test_exceptions_of_any_length(frame, monkeypatch, limit):
    texts = some_texts(160) + ["the Straße", "straßenbad", "bad dogma", "BAD DOG", "bad  dog"]
    df = frame(list(enumerate(texts)), "id int, message string")
    rule, allow = ["bad", "aß", "oo", "$d"], ["bad dog", "straße", "x-y", "straßenbad", "Mood"]
    monkeypatch.setattr(matching, "ROW_LOCAL_WORDS", limit)
    table = lambda words: frame([(w,) for w in words], "word string")
    want = {}
    for i, text in enumerate(texts):
        left = None if text is None else fold(text)
        for start, end, _ in reversed(by_walk(text, allow, "boundary") if text else []):
            left = left[:start] + "\x01" + left[end:]
        want[i] = None if left is None else any(w in left for w in rule)
    for given in ((rule, allow), (table(rule), allow), (rule, table(allow)), (table(rule), table(allow))):
        assert {r.id: r.flagged for r in rules.apply_exceptions(df, *given).collect()} == want


@pytest.mark.parametrize("limit", [20_000, 3])
def test_scorecard_of_any_length(frame, monkeypatch, limit):
    texts = some_texts(160)
    df = frame([(i, t, i % 3 == 0) for i, t in enumerate(texts)], "id int, message string, toxic boolean")
    monkeypatch.setattr(matching, "ROW_LOCAL_WORDS", limit)
    want = {}
    for entry in {fold(e.strip()) for e in ENTRIES}:
        hit = [i for i, t in enumerate(texts) if t and by_walk(t, [entry], "boundary")]
        want[entry] = (len(hit), sum(i % 3 == 0 for i in hit))
    for given in (ENTRIES, frame([(w,) for w in ENTRIES], "word string")):
        assert {r.word: (r.flagged, r.correct) for r in rules.rule_scorecard(df, given).collect()} == want


@pytest.mark.parametrize("n", [20_000, 20_001])
def test_the_length_of_a_list_changes_no_answer(frame, n):
    """At the real limit: a list that is written into the expression, and one that is joined."""
    words = ENTRIES + [f"w{k} v{k}" if k % 2 else f"w{k}" for k in range(n - len(ENTRIES))]
    texts = ["you bad dog", "w7 V7 and w8", "w7 v8", "aẞ", "ſtraße", "a$$x", None, "", "ΜΑΣ Σ"]
    df = frame([(i, t, True) for i, t in enumerate(texts)], "id int, message string, toxic boolean")
    got = {r.id: r.censored for r in rules.censor(df, words).collect()}
    assert got == {
        0: "you ***", 1: "*** and ***", 2: "w7 v8", 3: "***", 4: "***", 5: "***x", 6: None, 7: "", 8: "ΜΑΣ ***"
    }
    hits = sorted((r.id, r.rule) for r in rules.explain_match(df, words).collect())
    assert hits == [(0, "bad dog"), (1, "w7 v7"), (1, "w8"), (3, "aß"), (4, "straße"), (5, "a$$"), (8, "σ")]
    allow = frame([(w,) for w in words], "word string")
    flags = [r.flagged for r in rules.apply_exceptions(df, ["dog", "w7", "aß"], allow).orderBy("id").collect()]
    assert flags == [False, False, True, False, False, False, None, False, False]
    card = {r.word: r.flagged for r in rules.rule_scorecard(df, words).filter("flagged > 0").collect()}
    assert card == {"bad dog": 1, "bad": 1, "w7 v7": 1, "w8": 1, "aß": 1, "straße": 1, "a$$": 1, "$$": 1, "σ": 1}


def test_an_empty_table_is_refused(frame):
    with pytest.raises(ValueError):
        rules.censor(frame([(1, "a")], "id int, message string"), frame([(" ",)], "word string"))


def test_a_table_of_words_is_made_once(spark, frame, monkeypatch):
    """And overlapping matches of a long text are settled some at a time, in the same way."""
    monkeypatch.setattr(matching, "ROW_LOCAL_WORDS", 3)
    monkeypatch.setattr(matching, "RUNS_AT_ONCE", 2)
    made = spark.sparkContext.accumulator(0)

    def make(batches):
        for batch in batches:
            made.add(len(batch))
            yield batch

    listed = ["aa", "bb", "cc", "aa bb", "bb cc aa", "cc aa", "dd"]
    words = frame([(w,) for w in listed], "word string").mapInArrow(make, "word string")
    text = " ".join(random.Random(4).choice(["aa", "bb", "cc", "dd", "x"]) for _ in range(300))
    df = frame([(1, text)], "id int, message string")
    got = [(r.start_pos - 1, r.end_pos, r.rule) for r in rules.explain_match(df, words).orderBy("hit_no").collect()]
    assert got == by_walk(text, listed, "boundary") and made.value == len(listed)


def test_runs_of_characters_are_looked_for_in_distinct_words(frame, monkeypatch):
    monkeypatch.setattr(matching, "ROW_LOCAL_WORDS", 2)
    looked = []
    every = matching.all_windows
    monkeypatch.setattr(matching, "all_windows", lambda df, *rest: looked.append(df.count()) or every(df, *rest))
    df = frame([(i, "some words again " * 20) for i in range(40)], "id int, message string")
    flags = rules.rule_flag(df, frame([("ords",), ("gai",), ("none",)], "word string"), "substring").collect()
    assert all(r.flagged for r in flags) and looked == [3]


def test_short_phrases_are_cut_out_by_a_pattern(frame, monkeypatch):
    """No window is looked for unit by unit, and every text is gone through once."""
    texts = ["Bad dog, bad  dog bad", "a-b c a-b-c", "É o\nÉ O", "ΜΑΣ Σ x_1", None, "", "...", "bad", "x😀y x😀yz"]
    df = frame([(i, t, i % 2 == 0) for i, t in enumerate(texts)], "id int, message string, toxic boolean")
    words = ["bad", "bad dog", "dog bad", "a-b", "a-b-c", "é o", "μασ σ", "x_1", "x😀y", "none", "o\né"]
    table = frame([(w,) for w in words], "word string")
    monkeypatch.setattr(matching, "ROW_LOCAL_WORDS", 5 + 4)
    want = {}
    for entry in words:
        hit = [i for i, t in enumerate(texts) if t and by_walk(t, [entry], "boundary")]
        want[entry] = (len(hit), sum(i % 2 == 0 for i in hit))
    monkeypatch.setattr(matching.Windows, "bound", lambda *_: pytest.fail("texts are gone through unit by unit"))
    card = rules.rule_scorecard(df, table)
    assert {r.word: (r.flagged, r.correct) for r in card.collect()} == want
    plan = card._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract_all(lambda") == 3  # words, phrases of two and of three words
    flagged = {r.id: r.flagged for r in rules.rule_flag(df, table).collect()}
    assert flagged == {i: None if t is None else any(by_walk(t, [w], "boundary") for w in words) for i, t in enumerate(texts)}


@pytest.mark.parametrize("mode", ["boundary", "substring"])
def test_long_lists_are_looked_up_without_a_shuffle(frame, monkeypatch, mode):
    import random

    from chatsieve.operators import rules

    rng = random.Random(4)
    pool = ["a", "bad", "Day", "ö", "x1", "no", "über"]
    texts = [rng.choice(["", " ", "- "]) + rng.choice([" ", ", ", "  "]).join(rng.choice(pool) for _ in range(rng.randrange(12))) for _ in range(60)]
    rows = frame([(i, t) for i, t in enumerate([*texts, None, ""])], "id int, message string")
    words = frame([(w,) for w in ["bad day", "day", "a bad", "a, bad, no", "no", "ÜBER", "x1 a", "ay", "nobody"]], "word string")
    monkeypatch.setattr(matching, "ROW_LOCAL_WORDS", 3)

    def both():
        return rules.censor(rows, words, mode, per_char=True), rules.explain_match(rows, words, mode)

    looked_up = both()
    for table in looked_up:
        assert "Exchange" not in table._jdf.queryExecution().executedPlan().toString()
    got = [sorted(map(tuple, t.collect()), key=str) for t in looked_up]
    monkeypatch.setattr(matching, "HASHED_ENTRIES", 0)
    joined = both()
    assert [t.schema for t in looked_up] == [t.schema for t in joined]
    assert got == [sorted(map(tuple, t.collect()), key=str) for t in joined]
    assert len(got[1]) > 60


def test_positions_of_ids_that_repeat_are_as_before(frame, monkeypatch):
    from chatsieve.operators import rules

    rows = frame([(1, "ab cd"), (2, "x ab"), (2, "x ab")], "id int, message string")
    words = frame([("ab",), ("cd",), ("x ab",), ("no",)], "word string")
    monkeypatch.setattr(matching, "ROW_LOCAL_WORDS", 3)
    found = rules.explain_match(rows, words).select("id", "matched", "start_pos", "end_pos").collect()
    assert sorted(map(tuple, found)) == [(1, "ab", 1, 2), (1, "cd", 4, 5), (2, "x ab", 5, 8), (2, "x ab", 5, 8)]


def test_hits_that_overlap_are_taken_from_the_left():
    import numpy as np

    row, at, k = np.array([0, 0, 0, 0, 1, 1]), np.array([4, 0, 2, 0, 1, 0]), np.array([1, 1, 3, 3, 1, 1])
    kept = matching.without_overlap(row, at, k)
    assert [(row[i], at[i], k[i]) for i in kept] == [(0, 0, 3), (0, 4, 1), (1, 0, 1), (1, 1, 1)]
    assert not len(matching.without_overlap(row[:0], at[:0], k[:0]))
