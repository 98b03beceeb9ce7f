"""The llm operators against brute force, and on rows that are null, empty, repeated or long."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from chatsieve.llm import chat, corpus_scoring, decontaminate, fingerprint, language, licenses, minhash, packing, scoring, substrings, urls, words
from chatsieve.llm.queries import tokenizer_files

DOCS = "doc_id long, text string, lang string, source string, n_chars long, class_id long, words string, seed long"


def prose(rng, n, vocabulary=400):
    return " ".join(f"w{int(rng.random() ** 2 * vocabulary)}" for _ in range(n))


def edited(rng, text, share):
    return " ".join(w if rng.random() > share else f"x{rng.randrange(10**6)}" for w in text.split())


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(7)
    base = [prose(rng, rng.randrange(5, 300)) for _ in range(60)]
    long = prose(rng, 4000)
    copies = [edited(rng, base[k % 8], share) for k, share in enumerate([0.005, 0.01, 0.02, 0.03, 0.05] * 12)]
    passage = prose(rng, 70)
    shared = [f"{prose(rng, 30)} {passage} {prose(rng, 20)}" for _ in range(12)]
    odd = [None, "", " \n\t", "one", "one two", "a b c d", base[0], base[0], long, long + " tail", "é ü  x\t y\n\nz \n"]
    return base + copies + shared + odd + ["la " * 300, "la " * 200]


@pytest.fixture(scope="module")
def docs(spark, texts):
    rows = [(i, t, "en", "s", 1, 5, "w", 9) for i, t in enumerate(texts)] + [(3, texts[3], "en", "s", 1, 5, "w", 9)]
    return spark.createDataFrame(rows, DOCS).repartition(3)


@pytest.fixture(scope="module")
def empty(docs):
    return docs.limit(0)


def test_prob_minhash_estimates_the_weighted_index():
    rng = np.random.default_rng(1)
    ids = rng.integers(1, 1 << 44, 300).astype(np.uint64)
    x, y = rng.integers(1, 5, 300).astype(float), rng.integers(1, 5, 300).astype(float)
    x[:60] = 0
    y[240:] = 0
    row = np.repeat([0, 1], [240, 240])
    sig = minhash.prob_minhash(row, np.concatenate([ids[x > 0], ids[y > 0]]), np.concatenate([x[x > 0], y[y > 0]]), 2, 4096)
    both = (x > 0) & (y > 0)
    exact = sum(1 / np.maximum(x / x[i], y / y[i]).sum() for i in np.flatnonzero(both))
    assert abs((sig[0] == sig[1]).mean() - exact) < 0.03


def test_near_duplicates_are_the_components_of_all_pairs(docs, texts, empty):
    got = {r.doc_id: r for r in minhash.near_duplicates(docs).collect()}
    sets = []
    for t in texts:
        w = (t or "").split()
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    parent = list(range(len(texts)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            if sets[i] and sets[j] and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    assert {i: r.class_id for i, r in got.items()} == {i: root(i) for i in range(len(texts))}
    assert all(r.kept == (r.class_id == i) for i, r in got.items())
    assert minhash.near_duplicates(empty).count() == 0


def test_chain_of_copies_is_one_class(spark):
    rng = random.Random(3)
    text, rows = prose(rng, 200, 5000), []
    for k in range(30):
        rows.append((k, text))
        text = edited(rng, text, 0.01)
    got = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    assert got.select("class_id").distinct().count() == 1


def classes_of_all_pairs(texts):
    sets = [set(zip(*(t.split()[k:] for k in range(5)))) for t in texts]
    parent = list(range(len(texts)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    pairs = 0
    for i in range(len(texts)):
        for j in range(i):
            if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
                pairs += 1
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    return [root(i) for i in range(len(texts))], pairs


@pytest.mark.parametrize("seed", [11, 12, 13])
def test_few_links_in_a_family_of_edited_copies_are_all_found(spark, seed):
    """Most pairs are alike below the threshold, so that most centres find nothing."""
    rng = random.Random(seed)
    text = prose(rng, 1000, 20_000)
    texts = [edited(rng, text, rng.choice([0.011, 0.013, 0.016, 0.02])) for _ in range(61)]
    want, pairs = classes_of_all_pairs(texts)
    got = minhash.near_duplicates(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    assert [r.class_id for r in got.orderBy("doc_id").collect()] == want and 0 < pairs < 900


@pytest.mark.parametrize("limit", [2000, 2])
def test_substrings_by_brute_force(docs, texts, empty, limit):
    got = {r.doc_id: r for r in substrings.dedup_substrings(docs, shard_fragments=limit).collect()}
    words = [(t or "").split() if t and " " not in t else (t or "").encode().split() for t in texts]
    words = [[w.decode() if isinstance(w, bytes) else w for w in ws] for ws in words]
    first = {}
    for i, ws in enumerate(words):
        for k in range(len(ws) - 49):
            first.setdefault(tuple(ws[k : k + 50]), i)
    for i, ws in enumerate(words):
        gone = set()
        for k in range(len(ws) - 49):
            if first[tuple(ws[k : k + 50])] < i:
                gone |= set(range(k, k + 50))
        kept = " ".join(w for k, w in enumerate(ws) if k not in gone)
        assert (got[i].n_words, got[i].n_removed) == (len(ws), len(gone))
        assert got[i].kept_sha256 == hashlib.sha256(kept.encode()).hexdigest()
        assert got[i].kept == (kept if gone else texts[i] or "")
    assert substrings.dedup_substrings(empty).count() == 0


def test_rows_that_repeat_an_id_lose_their_own_words(spark):
    rng = random.Random(9)
    passage, more, other = prose(rng, 80, 9000), prose(rng, 20, 9000), prose(rng, 80, 9000)
    rows = [(1, passage), (2, f"{passage} {more}"), (2, other), (2, f"x {other}"), (3, f"{other} y"), (None, passage), (2, other)]
    got = substrings.dedup_substrings(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted((r.n_words, r.n_removed) for r in got.collect()) == sorted([(80, 0), (100, 80), (80, 0), (81, 0), (81, 80), (80, 0), (80, 0)])


def test_suffix_automaton_statistics():
    rng = random.Random(5)
    automaton, held = substrings.SuffixAutomaton(), []
    for _ in range(6):
        held.append([rng.choice("abc") for _ in range(25)])
        automaton.add(held[-1])
        probe = [rng.choice("abcd") for _ in range(60)]
        known = {"".join(h[i:j]) for h in held for i in range(25) for j in range(i, 26)}
        want = [max(n for n in range(k + 2) if "".join(probe[k + 1 - n : k + 1]) in known) for k in range(60)]
        assert list(automaton.statistics(probe)) == want


def test_chat_round_trip(spark, frame):
    said = ["</s>[INST] ok [/INST]", "<\\s>", "[\\INST]", "{{ROLE}}x{{\\/ROLE}}", None, "", "plain\n[", "<<SYS>>", "日本"]
    roles = ["user", "assistant", "system", "tool", None, "<s>", "assistant"]
    rows = [(c, t, roles[(c * 3 + t) % 7], said[(c + t) % 9], "junk") for c in range(20) for t in range(6)]
    rows += [(None, 0, "user", "x", ""), (3, 0, "user", "again", ""), (30, None, "assistant", "y", "")]
    turns = frame(rows, "conv_id long, turn long, role string, text string, loss string").repartition(3)
    got = {r.conv_id: r for r in chat.read_back(chat.format_conversations(turns)).collect()}
    by = {}
    for c, t, role, text, _ in rows:
        by.setdefault(c, []).append((-1 if t is None else t, role or "", text or ""))
    for c, given in by.items():
        given.sort()
        whole = "".join(f"{r}\n{x}\n" for _, r, x in given)
        loss = "".join(x for _, r, x in given if r == "assistant")
        assert got[c].n_turns == len(given)
        assert got[c].turns_sha256 == hashlib.sha256(whole.encode()).hexdigest()
        assert (got[c].loss_chars, got[c].loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    assert got[30].valid is False and got[None].valid is True
    assert chat.read_back(chat.format_conversations(turns.limit(0))).count() == 0
    for text in said:
        escaped = chat.INSTRUCT.escape(text or "")
        assert chat.INSTRUCT.unescape(escaped) == (text or "") and not any(c in escaped for c in chat.INSTRUCT.controls)


def test_template_with_overlapping_controls_is_refused():
    with pytest.raises(ValueError):
        chat.Template({"user": ("<u>", ">x<")}, ("{{", "}}"), "[END]", {})


def test_contamination(spark, frame):
    rng = random.Random(11)
    items = [prose(rng, n, 3000) for n in (15, 30, 45, 60)]
    swapped = items[2].split()
    swapped[7] = swapped[20] = swapped[33] = "other"
    texts = [
        prose(rng, 80, 3000), f"{prose(rng, 20, 3000)} {items[0]}. {prose(rng, 9, 3000)}", " ".join(swapped),
        items[3].upper() + "!", " ".join(items[1].split()[10:]), None, "", items[1], " ".join(items[3].split()[:8]), "w1 " * 5000,
    ]
    docs = frame([(i, t, i) for i, t in enumerate(texts)] + [(7, items[1], 0)], "doc_id long, text string, item_id long")
    bench = frame([*enumerate(items), (8, None), (9, "short one"), (None, items[0])], "item_id long, text string")
    small = decontaminate.contaminated(docs, bench)
    got = {(r.doc_id, r.item_id): (r.start, r.matched) for r in small.collect()}
    assert got == {(1, 0): (20, 15), (2, 2): (0, 42), (3, 3): (0, 60), (4, 1): (-10, 20), (7, 1): (0, 30)}
    big = decontaminate.contaminated(docs, bench, broadcast_seeds=0)
    assert sorted(map(tuple, big.collect())) == sorted(map(tuple, small.collect()))
    assert decontaminate.contaminated(docs.limit(0), bench).count() == 0
    assert decontaminate.contaminated(docs, bench.limit(0)).count() == 0


def test_contamination_sends_a_long_item_once(spark, frame):
    rng = random.Random(12)
    item = prose(rng, 1500, 10**6)
    docs = frame([(1, " ".join(item.split()[700:730])), (2, prose(rng, 50, 10**6))], "doc_id long, text string")
    found = decontaminate.contaminated(docs, frame([(5, item)], "item_id long, text string"))
    assert [(r.doc_id, r.item_id, r.start, r.matched) for r in found.collect()] == [(1, 5, -700, 30)]
    plan, sent = [found._jdf.queryExecution().executedPlan()], []
    while plan:
        node = plan.pop()
        name = node.getClass().getSimpleName()
        if name == "BroadcastExchangeExec":
            sent.append(node.metrics().apply("dataSize").value())
        plan += [node.executedPlan()] if name == "AdaptiveSparkPlanExec" else [node.plan()] if name.endswith("QueryStageExec") else []
        plan += [node.children().apply(k) for k in range(node.children().size())]
    assert sent and max(sent) < 5_000_000


def lanes_by_counting(text):
    """The lanes from a count of each paragraph, bit by bit."""
    lanes = [0] * 256
    for paragraph, times in Counter(p for line in text.split("\n") for p in re.split("(?<=[.!?]) +", line) if p).items():
        digest = hashlib.blake2b(paragraph.encode(), digest_size=32).digest()
        for k in range(256):
            lanes[k] += times if digest[k // 8] >> (7 - k % 8) & 1 else -times
    return tuple(lanes)


def likeness_by_counting(a, b):
    size = sum(x * x for x in a) + sum(x * x for x in b)
    return round(max(0.0, 1 - sum((x - y) ** 2 for x, y in zip(a, b)) / size), 9) if size else 1.0


def test_edited_fingerprints(docs, texts, empty):
    rows = sorted([(i, t or "") for i, t in enumerate(texts)] + [(3, texts[3] or "")], key=lambda r: (-r[0], r[1]))
    want = []
    for k, (i, text) in enumerate(rows):
        after, half = rows[(k + 1) % len(rows)][1], len(text) // 2
        changed = text[: len(text) - half] + after[:half]
        sums = [lanes_by_counting(t) for t in (text, changed, after)]
        near = [likeness_by_counting(sums[0], x) for x in sums[1:]]
        want.append((i, len(text), hashlib.sha256(changed.encode()).hexdigest(), *sums[:2], *near))
    for parts in (1, 7):
        got = fingerprint.edited_fingerprints(docs, parts).collect()
        lanes = lambda x: tuple(fingerprint.decoded(x).tolist())
        got = [(r.doc_id, r.n_chars, r.edited_sha256, lanes(r.fingerprint), lanes(r.edited_fingerprint), round(r.near_edited, 9), round(r.near_next, 9)) for r in got]
        assert sorted(got) == sorted(want)
    assert fingerprint.edited_fingerprints(empty).count() == 0


def test_fingerprints_are_sums_of_paragraphs():
    a, b, c = "one two.\nthree", "four\nfive", "three\none two."
    whole = fingerprint.fingerprint(a + "\n" + b)
    assert (fingerprint.fingerprint(a) == fingerprint.fingerprint(c)).all()
    assert (fingerprint.insert(fingerprint.fingerprint(a), b) == whole).all()
    assert (fingerprint.delete(whole, b) == fingerprint.fingerprint(a)).all()
    often = fingerprint.fingerprint("same\n" * 65_536)
    other = fingerprint.fingerprint("other")
    assert often.any() and fingerprint.likeness(often + other, other) < 0.01
    assert (fingerprint.decoded(fingerprint.encoded(often)) == often).all() and (fingerprint.decoded(fingerprint.encoded(other)) == other).all()
    assert fingerprint.likeness(fingerprint.fingerprint("same\n" * 40_000), fingerprint.fingerprint("same\n" * 20_000)) == 0.8
    many = "\n".join(f"line {k}" for k in range(200))
    half = "\n".join(f"line {k}" for k in range(100, 300))
    assert abs(fingerprint.likeness(fingerprint.fingerprint(many), fingerprint.fingerprint(half)) - 0.5) < 0.15


def test_urls(frame):
    changes = frame(
        [
            ("ads", "block", "bad.org", 10, True), ("ads", "block", "bad.org", 20, False), ("ads", "block", "bad.org", 30, True),
            ("ok", "allow", "good.bad.org", 15, True), ("x", "block", "bad.org", 12, True), ("x", "block", "bad.org", 12, False),
            (None, "block", "bad.org", 1, True), ("ads", "block", "gone.org", 5, False),
        ],
        "list string, verdict string, domain string, at long, active boolean",
    )
    rows = [
        (1, "http://a.bad.org/x", 10), (2, "http://a.bad.org:80/x", 20), (3, "https://u@good.bad.org", 16), (4, "http://BAD.org?q", 99),
        (5, "http://notbad.org/", 15), (6, None, 15), (7, "no url", 15), (8, "http://bad.org/", None), (1, "http://a.bad.org/x", 10),
    ]
    pages = frame(rows, "page_id long, url string, fetched_at long")
    got = urls.judge(pages, changes).collect()
    assert sorted((r.page_id, r.verdict, r.lists) for r in got) == [
        (1, "block", "ads"), (1, "block", "ads"), (2, "none", ""), (3, "allow", "ads,ok"), (4, "block", "ads"),
        (5, "none", ""), (6, "none", ""), (7, "none", ""), (8, "none", ""),
    ]
    assert sorted(map(str, urls.judge(pages, changes, broadcast_intervals=0).collect())) == sorted(map(str, got))
    assert urls.judge(pages.limit(0), changes).count() == 0
    spelled = frame([("ads", "block", "Bad.org", 10, True), ("ads", "block", "bad.org.", 20, False)], "list string, verdict string, domain string, at long, active boolean")
    dotted = frame([(1, "http://x.BAD.org./p", 15, "n"), (2, "http://bad.org", 30, "n")], "page_id long, url string, fetched_at long, domain string")
    assert sorted((r.page_id, r.verdict) for r in urls.judge(dotted, spelled).collect()) == [(1, "block"), (2, "none")]
    assert urls.judge(pages, changes.limit(0)).where("verdict = 'none'").count() == len(rows)


def test_licenses(frame):
    texts = [
        "Licensed under the Apache License, Version 2.0.", "under CC BY", None, "", "!gnu GENERAL public license; mit license, mit license",
        "released under my MIT license", "the gnu general public", "x " * 20000 + "This work is licensed under the GNU General Public License, version 3.",
    ]
    docs = frame([(i, t, "w", 1) for i, t in enumerate(texts)], "doc_id long, text string, words string, place long")
    got = {r.doc_id: r for r in licenses.scan_licenses(docs).collect()}
    assert [got[i].base_labels for i in range(8)] == ["apache", "cc-by", "", "", "gpl,mit", "mit", "", "gpl"]
    assert [got[i].labels for i in (0, 4, 7)] == ["apache,apache-2.0", "gpl,mit", "gpl,gpl-3.0"]
    assert (got[4].n_words, got[4].n_base, got[4].first_word, got[4].last_word) == (8, 3, 0, 6)
    assert (got[2].n_words, got[2].n_base, got[2].first_word, got[2].score) == (0, 0, None, 0.0)
    assert (got[7].n_words, got[7].first_word, got[7].score) == (20012, 20006, 1.0)
    assert licenses.scan_licenses(docs.limit(0)).count() == 0
    cased = frame([(1, "ÉTÉ MIT LICENSE"), (2, "THE MIT LICENSE İ")], "doc_id long, text string")
    assert [r[0] for r in cased.select(words.ascii_words("text")).collect()] == [["ÉtÉ", "mit", "license"], ["the", "mit", "license", "İ"]]


def test_licenses_without_their_rarest_words(frame):
    rng = random.Random(6)
    texts = []
    for _, text, must in licenses.NOTICES:
        words = text.split()
        held = set()
        for phrase in must:
            n = len(phrase.split())
            at = next(i for i in range(len(words)) if words[i : i + n] == phrase.split())
            held |= set(range(at, at + n))
        for share in (0.1, 0.3, 0.5):
            kept = [w if i in held or rng.random() > share else "other" for i, w in enumerate(words)]
            texts += [" ".join(kept), " ".join(["pad"] * 7 + kept[: max(held) + 1 + rng.randrange(len(words) - max(held))])]
    texts.append(" ".join(licenses.NOTICES[9][1].split()[:15]))
    got = {r.doc_id: r for r in licenses.scan_licenses(frame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    for i, text in enumerate(texts):
        words, want, best = text.split(), set(), 0.0
        for label, notice, must in licenses.NOTICES:
            wanted = notice.split()
            for s in range(-len(wanted), len(words)):
                same = [0 <= s + k < len(words) and words[s + k] == w for k, w in enumerate(wanted)]
                laid = " ".join(w if ok else "-" for w, ok in zip(wanted, same))
                if all(f" {p} " in f" {laid} " for p in must) and sum(same) / len(wanted) >= licenses.MIN_COVER:
                    want.add(label)
                    best = max(best, sum(same) / len(wanted))
        base = {label for phrase, label in licenses.PHRASES.items() if f" {phrase} " in f" {text} "}
        assert set(filter(None, got[i].labels.split(","))) == want | base, text
        assert abs(got[i].score - max(best, 0.5 if base else 0.0)) < 1e-12
    assert got[len(texts) - 1].labels == "bsd" and got[len(texts) - 1].score == 15 / 21


def test_scoring_prefers_what_is_like_the_target(spark, docs, empty):
    rng = random.Random(2)
    rows = [(i, " ".join(rng.choice("abcde" if i % 2 else "cdefg") for _ in range(60)), i) for i in range(200)]
    rows += [(200, None, 0), (201, "", 0)]
    table = spark.createDataFrame(rows, "doc_id long, text string, score long")
    models = scoring.fit_matched_models(table, table.where("doc_id % 2 = 1 AND doc_id < 100").select("doc_id"))
    got = {r.doc_id: r for r in scoring.score_documents(table, models).collect()}
    assert max(got[i].score for i in range(101, 200, 2)) < min(got[i].score for i in range(100, 200, 2))
    assert got[200].n_tokens == 0 and got[201].score is None
    none = scoring.fit_matched_models(empty, table.select("doc_id"))
    assert scoring.score_documents(table, none).count() == 202 and scoring.score_documents(empty, none).count() == 0
    alone = {r.doc_id: r for r in corpus_scoring.score_corpus(table, table.select("doc_id").limit(0)).collect()}
    assert len(alone) == 202 and alone[200].n_tokens == 0 and alone[201].score is None
    assert corpus_scoring.score_corpus(empty, table.select("doc_id")).count() == 0
    nulls = spark.createDataFrame([(None, "a b a"), (None, "a b a"), (3, "x " * 50_000)], "doc_id long, text string")
    assert sorted(r.n_tokens for r in corpus_scoring.score_corpus(nulls, nulls.select("doc_id")).collect()) == [3, 3, 50_000]


@pytest.mark.parametrize("shares, sample, bucket", [((scoring.WORD_SHARE, scoring.PAIR_SHARE), 1, 10**6), ((0.01, 0.002), 2, 100), ((2, 2), 16, 50), ((0.004, 2), 16, 30)])
def test_scoring_counts_every_word_and_pair(frame, monkeypatch, shares, sample, bucket):
    monkeypatch.setattr(corpus_scoring, "SAMPLE", sample)
    monkeypatch.setattr(corpus_scoring, "FLUSH", 700)
    if sample == 2:
        monkeypatch.setattr(corpus_scoring, "BROADCAST_IDS", 3)
    rng = random.Random(8)
    texts = {i: prose(rng, rng.randrange(1, 60), 300) for i in range(80)} | {80: "Once TWICE once twice", 81: "", 82: "one"}
    rows = [(i, t) for i, t in texts.items()] + [(80, texts[80])]
    docs = frame(rows, "doc_id long, text string").repartition(3)
    wanted = [i for i in texts if i % 4 == 0]
    other = {100: "w0 w1 never seen once twice w2"}
    scored = scoring.fit_matched_models(docs, frame([(i,) for i in wanted], "doc_id long"), *shares)
    got = scoring.score_documents(docs.union(frame(list(other.items()), "doc_id long, text string")), scored).collect()
    assert sorted(r.doc_id for r in got) == sorted([*texts, 80, 100])

    def losses(chosen):
        said = [t.lower().split() for i, t in rows if i in chosen]
        words = Counter(w for ws in said for w in ws)
        pairs = Counter(p for ws in said for p in zip(ws, ws[1:]))
        size, total = len({w for _, t in rows for w in t.lower().split()}) + 1, sum(words.values())
        listed = {p for _, t in rows for p in zip(t.lower().split(), t.lower().split()[1:])}

        def mean(text):
            ws, out = text.lower().split(), []
            for k, w in enumerate(ws):
                chance = (words[w] + 1) / (total + size)
                if k:
                    p = (ws[k - 1], w)
                    seen = scoring.WEIGHT * pairs[p] / max(words[p[0]], 1) if p in listed else 0.0
                    chance = seen + (1 - scoring.WEIGHT) * chance
                out.append(-np.log(chance))
            return np.mean(out) if out else None

        return mean

    target, background = losses(set(wanted)), losses(set(texts))
    whole = corpus_scoring.score_corpus(docs, frame([(i,) for i in wanted], "doc_id long"), *shares, bucket=bucket).collect()
    assert sorted(r.doc_id for r in whole) == sorted([*texts, 80])
    for r in got + whole:
        text = (texts | other)[r.doc_id]
        assert r.n_tokens == len(text.split())
        if r.n_tokens:
            assert abs(r.target_loss - target(text)) < 1e-9 and abs(r.background_loss - background(text)) < 1e-9
        else:
            assert r.score is None


def test_language(spark, frame):
    rng = random.Random(4)
    letters = {"aa": "abcdeé", "bb": "defghi", "cc": "aeioub"}
    said = lambda k: " ".join("".join(rng.choice(letters[k]) for _ in range(rng.randrange(2, 7))) for _ in range(30))
    rows = [(i, said(k), k) for i, k in enumerate(list(letters) * 60)]
    table = frame([*rows, (999, None, "aa"), (998, "abc", None)], "doc_id long, text string, lang string")
    model = language.fit_language_model(table.where(~language.held_out("doc_id")))
    got = {r.doc_id: r for r in language.identify(table, model).collect()}
    held = [(k, got[i].lang_pred) for i, _, k in rows if zlib.crc32(str(i).encode()) % 3 == 1]
    assert np.mean([a == b for a, b in held]) > 0.95
    assert not any(got[i].rejected for i, _, _ in rows)
    odd = language.identify(frame([(1, None), (2, "12 !?"), (3, "жзик " * 30), (4, "")], "doc_id long, text string"), model)
    odd = {r.doc_id: r for r in odd.collect()}
    assert [odd[i].lang_pred for i in (1, 2, 4)] == ["und"] * 3 and odd[3].rejected and odd[1].score == 0
    for n in range(2, language.ORDER + 1):  # chances of all symbols after a seen context add up to one
        table_n, bits = model.grams[n - 1], model.bits
        context = table_n[len(table_n) // 2] >> bits
        every = np.arange(len(model.grams[0]), dtype=np.uint64) + (np.uint64(context) << np.uint64(bits))
        assert np.exp(model._look(n, every)).sum(axis=0).max() <= 1 + 1e-9
    none = language.identify(table, language.fit_language_model(table.limit(0))).collect()
    assert {r.lang_pred for r in none} == {"und"} and [r.doc_id for r in none if r.rejected] == [999]


def test_packing(docs, texts, empty):
    from tokenizers import Tokenizer

    path, ranks = tokenizer_files()
    got = packing.pack(docs, path, ranks).toPandas()
    tokenizer = Tokenizer.from_file(path)
    for i, text in enumerate(texts):
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 2], dtype="<u4")
        mine = got[got.doc_id == i].drop_duplicates("piece").sort_values("piece")
        assert list(mine.start) == list(np.cumsum([0, *mine.length])[:-1]) and mine.length.sum() == len(ids)
        assert all(mine.length[1:] == 1024) and len(mine) == -(-len(ids) // 1024)
        assert all(zlib.crc32(ids[r.start : r.start + r.length].tobytes()) == r.ids_crc32 for r in mine.itertuples())
    for _, laid in got.sort_values("offset").groupby("sequence_id"):
        assert list(laid.offset) == list(np.cumsum([0, *laid.length])[:-1]) and laid.length.sum() <= 1024
    assert packing.pack(empty, path, ranks).count() == 0


def test_tokens_of_odd_white_space():
    path, ranks = tokenizer_files()
    import pyarrow as pa

    encode, whole = packing._encoders(path, ranks)
    rng = random.Random(9)
    parts = ["a", "it's", " ", "\n", "\t", " ", "　", "<|endoftext|>", "é", "'", "…", ",", "\x1f", "\x85", "x1", "  ", "\r\n", "😀"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(12))) for _ in range(3000)]
    got = list(packing._ids_of(pa.array(texts), packing.UnitTable(encode), whole))
    assert got == [np.array(whole(t), dtype="<u4").tobytes() for t in texts]


def test_best_fit_runs_are_best_fit_decreasing():
    rng = random.Random(1)
    for _ in range(50):
        lengths = sorted((rng.randrange(1, 60) for _ in range(rng.randrange(1, 200))), reverse=True)
        counts = {x: lengths.count(x) for x in set(lengths)}
        gaps = []
        for x in lengths:
            fits = [g for g in gaps if g >= x]
            if fits:
                gaps.remove(min(fits))
            gaps.append((min(fits) if fits else 60) - x)
        runs = packing.best_fit_runs(counts, 60)
        used = {s for _, lo, hi, first, _ in runs for s in range(first, first + hi - lo)}
        assert len(used) == len(gaps)


def test_fewer_columns_do_not_matter(docs):
    assert docs.select("doc_id", "text").where(F.col("doc_id") < 0).count() == 0
    assert fingerprint.fingerprints(docs.select("doc_id", "text")).count() == docs.count()


def test_near_duplicates_lose_no_link_in_a_large_bucket(spark, monkeypatch):
    """Two edited copies that are like each other and like no centre, among more than 64 texts of one bucket."""
    words = [f"w{k}" for k in range(40)]
    texts = [" ".join(words[:25] + [f"x{i}y{k}" for k in range(40)]) for i in range(80)]
    texts += [" ".join(words[:25] + [f"p{k}" for k in range(40)] + tail) for tail in (["end"], ["stop"])]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    # All texts meet in one bucket and only there.
    monkeypatch.setattr(minhash, "signatures", _one_bucket(minhash.signatures))
    got = {r.doc_id: r.class_id for r in minhash.near_duplicates(rows).collect()}
    assert got == {**{i: i for i in range(80)}, 80: 80, 81: 80}


def _one_bucket(signatures):
    from pyspark.sql import functions as F

    return lambda *given: signatures(*given).withColumn("bands", F.array(F.lit(7).cast("long")))
