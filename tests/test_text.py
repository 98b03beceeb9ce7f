import re
from collections import Counter

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from chatsieve.functions.patterns import fold, folded
from chatsieve.functions.text import FUNCTION_WORDS, language_of, normalised
from chatsieve.operators import fuzzy, mining, tokens

LOOSE = settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))


def test_normalise(frame):
    cases = {
        "f u c k you": "fuck you",
        "f.u.c.k": "fuck",
        "tr4sh": "trash",
        "ïdïöt": "idiot",
        "looooser": "loser",
        "sсum": "scum",  # the second letter is Cyrillic
        "i am": "i am",
        "cl0wn!": "clown!",
        "sh!t": "shit",
    }
    df = frame(list(enumerate(cases)), "id int, message string")
    got = {r.message: r.normalised for r in tokens.normalise_text(df).collect()}
    assert got == cases
    assert df.select(normalised(F.col("message"))).count() == len(cases)


@LOOSE
@given(st.lists(st.text("ab_é1 -٣😀İ\n", max_size=20), min_size=40, max_size=40))
def test_tokens_and_ngrams(frame, texts):
    df = frame(list(enumerate(texts)), "id int, message string")
    want = {i: re.findall(r"\w\w+", t.lower().replace("i̇", "i̇")) for i, t in enumerate(texts) if "İ" not in t}
    got = {i: [] for i in want}
    for r in tokens.tokens(df).collect():
        if r.id in got:
            got[r.id].append(r.term)
    assert {i: sorted(v) for i, v in got.items()} == {i: sorted(v) for i, v in want.items()}
    pairs = sorted((r.id, r.n, r.term) for r in tokens.word_ngrams(df, 2, 3).collect() if r.id in want)
    assert pairs == sorted(
        (i, n, " ".join(v[k : k + n])) for i, v in want.items() for n in (2, 3) for k in range(len(v) - n + 1)
    )
    grams = sorted((r.id, r.n, r.term) for r in tokens.char_ngrams(df, 1, 3).collect() if r.id in want)
    squeezed = {i: re.sub(r"\s\s+", " ", texts[i].lower()) for i in want}
    assert grams == sorted(
        (i, n, t[k : k + n]) for i, t in squeezed.items() for n in (1, 2, 3) for k in range(len(t) - n + 1)
    )
    counted = {(r.n, r.term): r.total for r in tokens.char_ngram_counts(df.filter(F.col("id").isin(list(want))), 1, 3).collect()}
    assert counted == dict(Counter((n, g) for _, n, g in grams))


def test_stop_words(frame, monkeypatch):
    df = frame([(1, "the", 1), (1, "cat", 1), (2, "the", 1)], "id int, term string, x int")
    table = frame([("The",)], "word string")
    assert [r.term for r in tokens.remove_stop_words(df, ["THE"]).collect()] == ["cat"]
    for limit in (10, 0):
        monkeypatch.setattr(tokens, "ROW_LOCAL_WORDS", limit)
        assert [r.term for r in tokens.remove_stop_words(df, table).collect()] == ["cat"]


def test_document_frequency(frame):
    texts = ["aa bb aa", "aa cc", "aa dd", "bb ee", "ff"]
    df = frame(list(enumerate(texts)), "id int, message string")
    got = {r.term: r.df for r in tokens.document_frequency(df, 2, 0.5).collect()}
    assert got == {"bb": 2}


def test_language(frame):
    texts = ["the cat is of the king", "der Hund und die Katze", "123", "les rois et une reine", "the die"]
    df = frame(list(enumerate(texts)), "id int, message string")
    got = [r.l for r in df.select("id", language_of(F.col("message"), FUNCTION_WORDS).alias("l")).orderBy("id").collect()]
    assert got == ["en", "de", "und", "fr", "de"]


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


@LOOSE
@given(st.lists(st.text("abcdé", min_size=4, max_size=8), min_size=40, max_size=60, unique=True))
def test_fuzzy_finds_every_near_word(frame, words):
    listed = ["abcd", "dcbaa", "abéd"]
    df = frame([(i, w) for i, w in enumerate(words)], "id int, message string")
    for dist in (1, 2):
        got = {(r.id, r.word, r.distance) for r in fuzzy.fuzzy_hits(df, listed, dist).collect()}
        want = set()
        for i, w in enumerate(words):
            near = min((edit_distance(w, x), x) for x in listed)
            if near[0] <= dist:
                want.add((i, near[1], near[0]))
        assert got == want


def test_greedy_rules_by_brute_force(frame):
    rows = [
        (1, "idiot bot", True), (2, "idiot", True), (3, "bot", True), (4, "bot", True), (5, "hello bot", False),
        (6, "noob", True), (7, "noob hello", True), (8, "hello", False), (9, "idiot noob", True),
    ]
    df = frame(rows, "id int, message string, toxic boolean")
    got = [(r.step, r.word, r.gain, r.newly_flagged) for r in mining.greedy_rules(df, 4, min_df=2).collect()]
    left, want = list(rows), []
    for step in range(1, 5):
        vocabulary = {w for _, t, _ in rows for w in t.split() if sum(w in r[1].split() for r in rows) >= 2}
        scored = []
        for w in vocabulary:
            hits = [r for r in left if w in r[1].split()]
            scored.append((-sum(1 if r[2] else -1 for r in hits), w, len(hits)))
        gain, word, n = min(scored)
        if gain >= 0:
            break
        want.append((step, word, -gain, n))
        left = [r for r in left if word not in r[1].split()]
    assert got == want


def test_error_terms(frame):
    rows = [(i, "kys now" if i < 4 else "good game now", i < 4, False) for i in range(10)]
    df = frame(rows, "id int, message string, toxic boolean, flagged boolean")
    top = mining.error_terms(df, "fn", 1).first()
    assert (top.term, top.error_texts, top.other_texts) == ("kys", 4, 0)
    assert mining.error_terms(df, "fp", 5).count() == 0


def test_fold_of_every_letter_in_any_company(spark):
    """Texts whose fold is their lower case, and those with a letter for which it is not."""
    letters = [c for c in map(chr, range(0x80, 0x600)) if c.isalpha() and len(c.lower()) == 1]
    texts = [p.format(c) for c in letters for p in ("{}", "É{}b’ A", "AΣ {}", "İ{}")]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for t, f in df.select("t", folded(F.col("t"))).collect():
        assert f == fold(t) and len(f) == len(t), (t, f)
