"""Token alignment against a brute force over byte positions."""

import hashlib
import random
from collections import Counter

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from chatsieve.llm import alignment
from chatsieve.llm.queries import op13_alignment, tokenizer_files
from chatsieve.llm.tables import settled

PIECES = public_tokenizers.path("piece_bpe_32k.model")
SCHEMA = "doc_id long, text string, row string, pairs string, groups string, n_a string"
ODD = [
    None, "", " ", "a", "a b", "  two  blanks  ", "<s> </s> <unk> <pad>", "<|endoftext|> and <|endoftext|>", "<0x41>", "▁a ▁",
    "\n", "a\n\n\tb\r\n", "\x00\x01", "é é", "ﬁ ｆｕｌｌ Ⅷ", "日本語 한국어 文字", "🏽 🤦🏼‍♂️", "﻿x", "  ", "�" * 40,
    "x" * 3000, " " * 500 + "x", "ab" * 2000, "1234567890 12,345.67", "don't we'll I'M", "ｚ" * 50, "́" * 30,
]


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(4)
    letters = "aeinst \n\t.,-'<>/|é日▁\U0001f600 A9"
    texts = ODD + ["".join(rng.choice(letters) for _ in range(rng.randrange(1, 80))) for _ in range(150)]
    texts += [" ".join(rng.choice(["the", "thing", "unthinkable", "über", "x1", "re-do"]) for _ in range(40)) for _ in range(30)]
    out = list(enumerate(texts)) + [(3, "a"), (4, "another text of id 4"), (None, "no id here"), (None, "no id here")]
    return out + [(10**12, " ".join(f"word{k % 977}" for k in range(30_000)))]


def frame_of(spark, rows):
    return spark.createDataFrame([(i, t, "r", "p", "g", "n") for i, t in rows], SCHEMA).repartition(3)


def tokens_by_library(text):
    """(ids, ends) of both sides, or None where the text does not come back."""
    import sentencepiece
    from tokenizers import Tokenizer

    if not hasattr(tokens_by_library, "sides"):
        a = Tokenizer.from_file(tokenizer_files()[0])
        a.encode_special_tokens = True
        b = sentencepiece.SentencePieceProcessor(model_file=PIECES)
        tokens_by_library.sides = a, b, alignment.byte_letters()
    a, b, letters = tokens_by_library.sides
    if not text:
        return None
    out, whole = [], (" " + text).encode()
    made = a.encode(" " + text, add_special_tokens=False)
    pieces = b.encode(text, out_type=str)
    for ids, entries in (
        (made.ids, [bytes(letters[c] for c in t) for t in made.tokens]),
        (b.encode(text), [bytes([int(p[3:5], 16)]) if len(p) == 6 and p.startswith("<0x") else p.replace("▁", " ").encode() for p in pieces]),
    ):
        if b"".join(entries) != whole:
            return None
        ends, at = [], 0
        for e in entries:
            at += len(e)
            ends.append(at)
        out.append((ids, ends))
    return out


def groups_by_bytes(text):
    sides = tokens_by_library(text)
    if sides is None:
        return []
    (a, end_a), (b, end_b) = sides
    both, out, low = sorted(set(end_a) & set(end_b)), [], 0
    for high in both:
        out.append(([i for i, e in zip(a, end_a) if low < e <= high], [i for i, e in zip(b, end_b) if low < e <= high]))
        low = high
    return out


def expected(rows):
    held = [(i, groups_by_bytes(t) if t is None or len(t) < 10**5 else None) for i, t in rows]
    counts = Counter(p for _, gs in held for p in {(x, y) for a, b in gs for x in a for y in b})
    best = {}
    for (x, _), n in counts.items():
        best[x] = max(best.get(x, 0), n)
    out = []
    for i, gs in held:
        links = [(x, y) for a, b in gs for x in a for y in b]
        text = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in gs)
        out.append(
            (
                i, sum(len(a) for a, _ in gs), sum(len(b) for _, b in gs), len(gs), len(links),
                sum(counts[p] == best[p[0]] for p in links), sum(counts[p] for p in links), text,
            )
        )
    return sorted(out, key=repr)


@pytest.mark.parametrize("limit", [alignment.BROADCAST_PAIRS, 40, 0])
def test_by_brute_force(spark, rows, limit):
    rows = [r for r in rows if r[1] is None or len(r[1]) < 10**5]
    made = settled(alignment.align(frame_of(spark, rows), tokenizer_files()[0], PIECES, tokenizer_files()[1]), "aligned")
    counts = alignment.count_links(made)
    kept = made.join(alignment.score_links(made, counts, limit), "row", "left").fillna(0, ["n_best", "count_sum"])
    got = [tuple(r) for r in kept.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups").collect()]
    assert sorted(got, key=repr) == expected(rows)
    assert made.select(F.size("pairs") == F.size("times")).distinct().collect() == [(True,)]


def test_query_carries_the_digests(spark, rows, tmp_path):
    frame_of(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    got = {(r.doc_id, r.n_a, r.n_groups): r for r in op13_alignment(spark, str(tmp_path)).collect()}
    for i, text in rows:
        groups = groups_by_bytes(text) if text is None or len(text) < 10**5 else None
        if groups is None:
            assert [r for key, r in got.items() if key[0] == i and r.n_groups > 30_000]
            continue
        want = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)
        row = got[i, sum(len(a) for a, _ in groups), len(groups)]
        if i not in (3, 4):
            assert row.groups_sha256 == (hashlib.sha256(want.encode()).hexdigest() if groups else "")


def test_both_libraries_give_the_same_ids():
    path, ranks = tokenizer_files()
    quick, slow = alignment.byte_level_side(path, ranks), alignment.byte_level_side(path)
    rng = random.Random(9)
    letters = "ab'st dz1 \n\t 　\u0085é日\U0001f600<|endoftext|>ſ"
    for n in range(3000):
        text = "".join(rng.choice(letters) for _ in range(rng.randrange(1, 40)))
        assert list(quick.encode(text)) == list(slow.encode(text))
    for text in (" " * 300_000 + "x", "ab" * 100_000, "\n" * 100_000):
        assert list(quick.encode(text)) == list(slow.encode(text))


def test_repeats_in_a_group_are_counted_not_expanded():
    import numpy as np

    a, b = np.full(5000, 7), np.full(4000, 9)
    doc, pair, times = alignment.linked_pairs(a, b, np.zeros(5000, np.int64), np.zeros(4000, np.int64), np.array([3]), 100)
    assert (doc.tolist(), pair.tolist(), times.tolist()) == ([3], [709], [20_000_000])


def test_empty_table(spark, rows):
    empty = settled(alignment.align(frame_of(spark, rows).limit(0), tokenizer_files()[0], PIECES), "aligned")
    assert empty.count() == 0 and alignment.score_links(empty, alignment.count_links(empty)).count() == 0
