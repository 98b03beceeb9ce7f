import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from chatsieve.functions.patterns import BASIC_WORDS, clean_words
from chatsieve.operators import matching, rules

ALPHABET = "aAbBsS1_- .éÉ$ñß\n"


def flags(frame, texts, words, mode):
    df = frame(list(enumerate(texts)), "id int, message string")
    return [r.flagged for r in rules.rule_flag(df, words, mode).orderBy("id").collect()]


def segments_by_hand(name):
    """Walk over a name one character at a time, without regular expressions."""
    low, up, digits = set("abcdefghijklmnopqrstuvwxyz"), set("ABCDEFGHIJKLMNOPQRSTUVWXYZ"), set("0123456789")
    out, i = [], 0
    while i < len(name):
        j = i
        if name[i] in digits:
            while j < len(name) and name[j] in digits:
                j += 1
            out.append(name[i:j])
        elif name[i] in up or name[i] in low:
            while j < len(name) and name[j] in up:
                j += 1
            k = j
            while k < len(name) and name[k] in low:
                k += 1
            if k > j:
                out.append(name[i:k])
            elif k == len(name) or name[k] not in digits:
                out.append(name[i:j])
            j = k
        else:
            j += 1
        i = j
    return out


def test_boundary_substring_caps(frame):
    texts = ["nice assessment", "you ass", "ASS!", "class reunion", None]
    assert flags(frame, texts, ["ass"], "boundary") == [False, True, True, False, None]
    assert flags(frame, texts, ["ass"], "substring") == [True, True, True, True, None]
    assert flags(frame, texts, ["ass"], "caps") == [False, True, True, False, None]


def test_non_ascii_case_folding(frame):
    assert flags(frame, ["un élan", "un élans", "xélan"], ["ÉLAN"], "boundary") == [True, False, False]
    assert flags(frame, ["grüße", "GRÜSSE", "Über"], ["über"], "boundary") == [False, False, True]


def test_caps_names(frame):
    names = ["aBAD", "bad_name", "BadName", "BAD123", "BADword", "abad", "bad123", "ChefBoyAreBad", "élanBad"]
    assert flags(frame, names, ["bad"], "caps") == [True, True, True, False, False, False, True, True, True]


def test_words_are_literal(frame):
    assert flags(frame, ["a.b", "axb"], ["a.b"], "boundary") == [True, False]
    assert flags(frame, ["so f*ck it", "so fck it"], ["f*ck"], "boundary") == [True, False]
    assert flags(frame, ["c++ rules", "c+"], ["c++"], "substring") == [True, False]


def test_word_with_symbol_at_its_end_needs_a_word_character_there(frame):
    texts = ["a$$ x", "a$$x", "xa$$x"]
    assert flags(frame, texts, ["a$$"], "boundary") == [bool(re.search(r"\ba\$\$\b", t)) for t in texts]


def test_empty_list_is_refused():
    with pytest.raises(ValueError):
        clean_words([" ", ""])


def test_built_in_words():
    assert len(BASIC_WORDS) == 9


def test_long_list_is_cut_into_patterns(frame):
    words = [f"word{i}" for i in range(1300)]
    assert flags(frame, ["has word1299 in", "word1300"], words, "boundary") == [True, False]


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text(ALPHABET, max_size=14), min_size=60, max_size=60))
def test_rules_agree_with_python(frame, texts):
    words = ["ass", "bb", "É", "a$", "s1"]
    df = frame(list(enumerate(texts)), "id int, message string")
    for mode in ("boundary", "substring", "caps"):
        df = rules.rule_flag(df, words, mode, out=mode)
    df = rules.name_segments(df, "message")
    either = "|".join(map(re.escape, words))
    for row in df.collect():
        text = row.message
        assert row.boundary == bool(re.search(rf"\b(?:{either})\b", text, re.I)), text
        assert row.substring == bool(re.search(either, text, re.I)), text
        assert row.segments == segments_by_hand(text), text
        assert row.caps == any(s.lower() in {"ass", "bb", "s1"} for s in row.segments), text
        assert not row.boundary or row.substring


def test_word_table_equals_word_list(frame, monkeypatch):
    texts = ["the ass is here", "nothing", "BB and ass", "assess", ""]
    df = frame(list(enumerate(texts)), "id int, message string")
    table = frame([("ass",), ("bb ",), ("zz",)], "word string")
    for mode in rules.MODES:
        by_list = rules.rule_flag(df, ["ass", "bb", "zz"], mode).orderBy("id").collect()
        for limit in (100, 1):
            monkeypatch.setattr(matching, "ROW_LOCAL_WORDS", limit)
            by_table = rules.rule_flag(df, table, mode).orderBy("id").collect()
            assert [r.flagged for r in by_list] == [r.flagged for r in by_table]
    many = ["ass", *(f"w{i}" for i in range(100))]
    assert flags(frame, texts, many, "token") == [True, False, True, False, False]


@settings(max_examples=3, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text("aAbBsS1_- $é", max_size=14), min_size=60, max_size=60))
def test_long_lists_give_what_patterns_give(frame, texts):
    words = ["ass", "bb", "É", "a$", "s1", "a b", *(f"filler{i}" for i in range(120))]
    df = frame(list(enumerate(texts)), "id int, message string")
    table = frame([(w,) for w in words], "word string")
    for mode in ("boundary", "substring"):
        short = rules.rule_flag(df, words[:6], mode, out="short")
        both = rules.rule_flag(short, words, mode, out="long")
        assert both.filter("short <> long").collect() == []
        local, matching.ROW_LOCAL_WORDS = matching.ROW_LOCAL_WORDS, 30
        try:
            joined = rules.rule_flag(short, table, mode, out="joined")
            assert joined.filter("short <> joined").collect() == [] and joined.count() == len(texts)
        finally:
            matching.ROW_LOCAL_WORDS = local


def test_censor(frame):
    df = frame([(1, "you Ass ass, assessment")], "id int, message string")
    assert rules.censor(df, ["ass"]).first().censored == "you *** ***, assessment"
    assert rules.censor(df, ["ass"], "substring").first().censored == "you *** ***, ***essment"
    assert rules.censor(df, ["you", "assess"], "substring", per_char=True).first().censored == "*** Ass ass, ******ment"
    assert rules.censor(df, frame([("ass ",)], "word string")).first().censored == "you *** ***, assessment"
    once = rules.censor(df, ["ass"]).select("id", F.col("censored").alias("message"))
    assert rules.censor(once, ["ass"]).first().censored == once.first().message


@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text("as sb.é😀", max_size=16), min_size=50, max_size=50))
def test_positions_of_hits(frame, texts):
    df = frame(list(enumerate(texts)), "id int, message string")
    for mode, pattern in (("boundary", r"\b(?:ass|b)\b"), ("substring", "ass|b")):
        got = {(r.id, r.hit_no, r.matched, r.start_pos, r.end_pos) for r in rules.explain_match(df, ["ass", "b"], mode).collect()}
        want = {
            (i, n, m.group(), m.start() + 1, m.end())
            for i, t in enumerate(texts)
            for n, m in enumerate(re.finditer(pattern, t, re.I), 1)
        }
        assert got == want


def test_exceptions(frame, monkeypatch):
    texts = ["assessment", "assessment and class", "the ass", "Cassandra", None]
    df = frame(list(enumerate(texts)), "id int, message string")
    allow = ["assessment", "cassandra"]
    by_list = [r.flagged for r in rules.apply_exceptions(df, ["ass"], allow).orderBy("id").collect()]
    table = frame([(w,) for w in allow], "word string")
    assert by_list == [False, True, True, False, None]
    for limit in (20_000, 1):
        monkeypatch.setattr(matching, "ROW_LOCAL_WORDS", limit)
        by_table = [r.flagged for r in rules.apply_exceptions(df, ["ass"], table).orderBy("id").collect()]
        assert by_table == by_list


def test_exceptions_with_symbols_and_phrases(frame, monkeypatch):
    texts = ["f*ck you", "i love new york", "yorkſhire", "York, New", "a f*ck new\tyork"]
    df = frame(list(enumerate(texts)), "id int, message string")
    allow = ["new york", "Yorkshire", "\tclass ", *[f"filler{i}" for i in range(30)]]
    table = frame([(w,) for w in allow], "word string")
    rule = ["f*ck", "york"]
    want = [True, False, False, True, True]
    assert [r.flagged for r in rules.apply_exceptions(df, rule, allow).orderBy("id").collect()] == want
    for limit in (20_000, 5):
        monkeypatch.setattr(matching, "ROW_LOCAL_WORDS", limit)
        assert [r.flagged for r in rules.apply_exceptions(df, rule, table).orderBy("id").collect()] == want


def test_list_length_and_kind_change_no_answer(frame, monkeypatch):
    texts = ["you aſſ there", "μασ", "Kill it", "you ass there", "ΜΑΣ!", "K\u0131ll", "s\u00b5rf", None, "nothing", "class"]
    df = frame(list(enumerate(texts)), "id int, message string")
    base = ["ass", "μας", " kill\t", "sμrf"]
    for mode in ("boundary", "substring", "token"):
        seen = []
        for n in (0, 96, 97, 600):
            words = base + [f"filler{i}x" for i in range(n)]
            seen.append([r.flagged for r in rules.rule_flag(df, words, mode).orderBy("id").collect()])
        table = frame([(w,) for w in words], "word string")
        for limit in (20_000, 3):
            monkeypatch.setattr(matching, "ROW_LOCAL_WORDS", limit)
            seen.append([r.flagged for r in rules.rule_flag(df, table, mode).orderBy("id").collect()])
        assert all(s == seen[0] for s in seen), mode
        assert seen[0][:7] == [True] * 7 and seen[0][7] is None


def test_scorecard_paths_agree(frame):
    rows = [(1, "bad bad dog", True), (2, "bad cat", False), (3, "dog", True)]
    df = frame(rows, "id int, message string, toxic boolean")
    single = {r.word: (r.flagged, r.correct) for r in rules.rule_scorecard(df, ["bad", "dog", "cow"]).collect()}
    assert single == {"bad": (2, 1), "dog": (2, 2), "cow": (0, 0)}
    phrase = {r.word: (r.flagged, r.correct) for r in rules.rule_scorecard(df, ["bad", "bad dog", "cow"]).collect()}
    assert phrase == {"bad": (2, 1), "bad dog": (1, 1), "cow": (0, 0)}


def test_the_fold_is_the_same_with_and_without_the_ascii_way(frame):
    """ASCII texts are lower-cased alone; the plan must have that way, and both fold as Python does."""
    from chatsieve.functions.patterns import fold, folded

    texts = ["", "Plain TEXT_9", "İstanbul", "ſcum Σς", "ÉLAN", None]
    df = frame([(t,) for t in texts], "t string").select("t", folded(F.col("t")).alias("f"))
    assert "octet_length" in df._jdf.queryExecution().optimizedPlan().toString()
    assert all(r.f == (None if r.t is None else fold(r.t)) for r in df.collect())


def test_a_long_substring_list_finds_words_of_every_length(frame):
    from chatsieve.operators import matching

    words = [f"w{i:03d}" + "x" * (i % 7) for i in range(150)] + ["w001xxxxxxxxy", "étés"]
    texts = ["", "w0", "W000", "aw149xxz", "w148", "xw001xxxxxxxxY", "w001xxxxxxxx", "w009x", "L'ÉTÉS", None]
    df = frame(list(enumerate(texts)), "id long, message string")
    got = {r.id: r.flagged for r in rules.rule_flag(df, words, "substring").collect()}
    assert got == {i: None if t is None else any(w in t.lower() for w in words) for i, t in enumerate(texts)}
    assert "filter(" not in str(matching.holds_within(F.col("message"), words))  # no pass per length
