"""Packing by least squares: valid sequences, exact tokens, and the solver against a plain one."""

import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest

from chatsieve.llm import histogram_packing as packing

PATH = public_tokenizers.path("word_bpe_49k.json")
SCHEMA = "doc_id long, text string, row string, length string, ids string, start string"
ODD = [
    None, "", " ", "\n\n", "a", "A  B\tc", "don't WE'LL", "<|endoftext|>", "x<|startoftext|>y <|endoftext|>", "İstanbul ΑΣ Σ ſ",
    "é é", "日本語 한국어", "🏽🤦🏼‍♂️", " a　b\u0085c\x1cd", "\x00", "0123456789", "!?!? ...", "x" * 5000,
]


def library_ids(texts, end):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(PATH)
    return [tokenizer.encode(t or "", add_special_tokens=False).ids + [end] for t in texts]


def frame_of(spark, rows):
    return spark.createDataFrame([(i, t, "r", "l", "i", "s") for i, t in rows], SCHEMA).repartition(3)


def checked(got, rows, length, end=1):
    """Every id of every row lies in one piece, and sequences are gapless and need no padding."""
    want = defaultdict(list)
    for (i, _), ids in zip(rows, library_ids([t for _, t in rows], end)):
        want[i].append(np.array(ids, "<u4"))
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in got:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append((r.offset, r.length))
    assert set(by_doc) == set(want)
    for i, texts in want.items():
        held = sorted((r.doc_tokens, r.start, r.length, r.ids_crc32) for r in by_doc[i])
        if len(texts) == 1:
            at = 0
            for tokens, start, size, crc in held:
                assert (tokens, start) == (len(texts[0]), at)
                assert crc == zlib.crc32(texts[0][at : at + size].tobytes())
                at += size
            assert at == len(texts[0])
        else:
            assert sum(size for _, _, size, _ in held) == sum(map(len, texts))
    for parts in by_sequence.values():
        at = 0
        for offset, size in sorted(parts):
            assert offset == at and size > 0
            at += size
        assert at == length or at & (at - 1) == 0 and at < length
    return by_doc, by_sequence


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(6)
    texts = ODD + ["word " * rng.randrange(1, 90) for _ in range(400)] + ["the same length " * 7] * 150
    texts += [" ".join(rng.choice(["alpha", "Beta's", "gamma-9", "dé"]) for _ in range(rng.randrange(300))) for _ in range(200)]
    return list(enumerate(texts)) + [(3, "\n"), (3, "id three again"), (None, "no id"), (None, "no id")]


@pytest.mark.parametrize("length, cuts", [(64, packing.BROADCAST_CUTS), (64, 0), (2048, packing.BROADCAST_CUTS)])
def test_every_token_is_packed_once_and_nothing_is_padded(spark, rows, monkeypatch, length, cuts):
    monkeypatch.setattr(packing, "BROADCAST_CUTS", cuts)
    got = packing.pack(frame_of(spark, rows), PATH, length).collect()
    checked(got, rows, length)


def test_few_documents_are_cut(spark):
    rng = random.Random(8)
    rows = [(i, "a " * min(62, int(rng.expovariate(0.05)))) for i in range(4000)]
    by_doc, by_sequence = checked(packing.pack(frame_of(spark, rows), PATH, 64).collect(), rows, 64)
    assert sum(len(v) > 1 for v in by_doc.values()) < 60
    assert max(map(len, by_sequence.values())) <= 40


def test_one_length_holds_most_documents(spark):
    rows = [(i, "a " * 24) for i in range(3000)] + [(3000 + i, "a " * (i % 60)) for i in range(300)]
    checked(packing.pack(frame_of(spark, rows), PATH, 64).collect(), rows, 64)


def test_a_long_text_and_an_empty_table(spark):
    long = " ".join(f"w{k % 5000}" for k in range(200_000))
    rows = [(1, long), (2, "x")]
    checked(packing.pack(frame_of(spark, rows), PATH).collect(), rows, 2048)
    assert packing.pack(frame_of(spark, rows).limit(0), PATH).count() == 0
    assert packing.pack(spark.createDataFrame([(5, "a b")], "doc_id int, text string"), PATH).count() == 2


def test_words_give_the_ids_of_the_whole_text():
    import pyarrow as pa

    rng = random.Random(3)
    letters = "aA'stdlre \n\t\x1c\x85 　éΣİſ日1\U0001f600<|endoftext|>́"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randrange(40))) for _ in range(20_000)]
    latin = "aeinstrlAEéÉßçüñŒæỳ.,!?&$<|'\u0345"
    texts += [" ".join("".join(rng.choice(latin) for _ in range(rng.randrange(1, 14))) for _ in range(6)) for _ in range(20_000)]
    texts += ["<|ENDOFTEXT|>", "x.<|endoftext|>.", "A'S.", "it's... I'LL!!", "é.", "…,", "ſt ŉ ǰ ẞ", "don'T.'s"]
    table = packing._table_of(PATH)
    got = [ids.tolist() + [1] for ids in packing._ids_of(pa.array(texts), table)]
    assert got == library_ids(texts, 1)


def test_combinations_are_all_of_them():
    present = np.array([1, 2, 3, 5, 8, 13, 16])
    parts, sizes = packing.combinations(present, packing.free_sizes(16))
    want = set()
    some = [0, *present.tolist()]
    for a in some:
        for b in some:
            for c in some:
                if a >= b >= c and a and a + b + c in (1, 2, 4, 8, 16) and not (b == 0 and c):
                    want.add((a, b, c, a + b + c))
    assert {(*p, s) for p, s in zip(parts.tolist(), sizes.tolist())} == want and len(parts) == len(want)


@pytest.mark.parametrize("seed", range(4))
def test_repeats_are_the_least_squares_optimum(seed):
    rng = np.random.default_rng(seed)
    supply = np.append(0, rng.integers(0, 200, 16)) * (rng.random(17) < 0.8)
    parts, _ = packing.combinations(np.flatnonzero(supply), packing.free_sizes(16))
    matrix = np.zeros((17, len(parts)))
    for j, p in enumerate(parts.tolist()):
        for k in p:
            matrix[k, j] += k > 0
    x = packing.solve_repeats(parts, supply, sweeps=5000, tolerance=1e-9)
    assert (x >= 0).all()
    slope = matrix.T @ (supply * (np.arange(17) > 0) - matrix @ x)  # Kuhn-Tucker: none rises, those in use are flat
    assert slope.max() < 1e-3 and np.abs(slope[x > 1e-9]).max(initial=0) < 1e-3


def test_the_plan_takes_every_document_once():
    rng = np.random.default_rng(5)
    for n in (0, 1, 7, 500, 20_000):
        sizes, numbers = np.unique(rng.integers(1, 64, n), return_counts=True)
        counts = dict(zip(sizes.tolist(), numbers.tolist()))
        plan = packing.plan_packing(counts, 64, packing.free_sizes(64))
        for size, total in counts.items():
            ends = sorted((lo, hi) for s, lo, hi, _, _ in plan.runs if s == size) + [(lo, total) for s, lo, _ in plan.rest if s == size]
            assert [lo for lo, _ in ends] == [0, *[hi for _, hi in ends[:-1]]] and ends[-1][1] == total
