import itertools
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from barograph.llm import packing
from barograph.llm.packing import Packer, PackingRules, Piece

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def words():
    with open(PATH, encoding="utf-8") as file:
        return packing.WordTokens(file.read())


ODD = [
    "", " ", "İstanbul ŉ ſ ĳ don't WE'RE 123abc <|endoftext|>x<|startoftext|>y", "a\x1cb c\x85d e\xa0f  g",
    "é café! ́x é", "中文 \U0001f600!! ÀÉ×÷µª", "x" * 5000, "'s 'S it's IT'S''ll", "\x00 a\x00b \x7f",
    "ΑΣ ΣΑΣ Σ", "٣٤ ²³ ½ 0123456789", "!!..a--b__c", "ﬁ ﬀ ẞ ß Å Å", "<|ENDOFTEXT|>", "\t\n\x0b\x0c\r z",
]


def test_ids_equal_the_library(docs, words, tokenizer):
    texts = ODD + [r["text"] or "" for r in docs.select("text").collect()]
    for text, ids in zip(texts, words.texts(pa.array(texts)), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids
    assert words.texts(pa.array([None, "", "x"], pa.string()), 7)[:2] == [b"\7\0\0\0"] * 2
    assert words.texts(pa.array([], pa.string())) == []


def test_fullest_equals_all_subsets():
    rng = np.random.default_rng(2)
    for _ in range(200):
        capacity = int(rng.integers(1, 40))
        lengths = rng.integers(1, 30, rng.integers(0, 9)).tolist()
        chosen = packing.fullest(np.bincount(lengths, minlength=capacity + 1), capacity)
        fits = [x for x in lengths if x <= capacity]
        if not fits:
            assert chosen == {}
            continue
        rest = list(fits)
        rest.remove(max(fits))
        best = max(
            max(fits) + sum(c) for k in range(len(rest) + 1) for c in itertools.combinations(rest, k)
            if max(fits) + sum(c) <= capacity
        )
        assert sum(length * n for length, n in chosen.items()) == best
        assert chosen[max(fits)] >= 1
        assert all(n <= fits.count(length) for length, n in chosen.items())


def test_windows_are_exact_and_cut_little():
    rng = np.random.default_rng(4)
    packer = Packer(64)
    lengths = rng.integers(1, 64, 500).tolist()
    for i, length in enumerate(lengths):
        packer.put(Piece(i, 0, bytes(4 * length), length))
    windows = list(packer.windows(0))
    left = packer.tokens
    windows += packer.last()
    sizes = [sum(len(p.ids) for p in w) // 4 for w in windows]
    assert sum(sizes) == sum(lengths) and left < 64
    assert set(sizes[: sum(lengths) // 64]) == {64}
    assert all(s & (s - 1) == 0 for s in sizes)
    assert sum(map(len, windows)) < 1.3 * len(lengths)  # most remainders stay whole


def test_only_long_remainders_are_cut():
    packer = Packer(8)
    for i in range(4):
        packer.put(Piece(i, 0, bytes(4 * 6), 6))
    assert [sorted(len(p.ids) // 4 for p in w) for w in packer.windows(0)] == [[2, 6], [2, 6], [2, 6]]
    assert packer.tokens == 0


def whole(docs, rules=packing.DEFAULT_RULES):
    """The rows, after the laws of packing were checked."""
    rows = packing.packed(docs, PATH, rules).collect()
    sequences = defaultdict(list)
    for r in rows:
        assert r["length"] == len(r["ids"]) // 4 > 0
        sequences[r["sequence_id"]].append(r)
    for members in sequences.values():
        at = 0
        for r in sorted(members, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at == rules.capacity or at & (at - 1) == 0
        assert at <= rules.capacity
    return rows


def joined(rows):
    """Ids of every document, as lists of (doc_id, ids); equal documents may be interchanged."""
    starts = defaultdict(lambda: defaultdict(list))
    for r in rows:
        starts[r["doc_id"], r["doc_tokens"]][r["start"], r["ids"]].append(r["length"])
    return starts


@pytest.mark.parametrize("rules", [packing.DEFAULT_RULES, PackingRules(capacity=64, pool_tokens=500, tails_per_task=2)])
def test_every_id_in_one_piece(docs, tokenizer, rules):
    rows = whole(docs, rules)
    pieces = defaultdict(list)
    for r in rows:
        pieces[r["doc_id"]].append(r)
    given = docs.select("doc_id", "text").collect()
    want = defaultdict(list)
    for r in given:
        want[r["doc_id"]].append([*tokenizer.encode(r["text"] or "", add_special_tokens=False).ids, 1])
    assert set(pieces) == set(want)
    for doc_id, found in pieces.items():
        if len(want[doc_id]) == 1:
            found.sort(key=lambda r: r["start"])
            at, ids = 0, b""
            for r in found:
                assert r["start"] == at and r["doc_tokens"] == len(want[doc_id][0])
                at += r["length"]
                ids += r["ids"]
            assert np.frombuffer(ids, "<u4").tolist() == want[doc_id][0]
    assert sum(r["length"] for r in rows) == sum(len(x) for texts in want.values() for x in texts)


def test_odd_rows(odd, none, tokenizer):
    rows = whole(odd)
    lengths = sorted(r["doc_tokens"] for r in rows if r["start"] == 0)
    texts = [r["text"] or "" for r in odd.select("text").collect()]
    assert lengths == sorted(len(tokenizer.encode(t, add_special_tokens=False).ids) + 1 for t in texts)
    assert sum(r["length"] for r in rows) == sum(lengths)
    assert packing.packed(none, PATH).count() == 0


def test_many_small_partitions_share_their_last_sequences(docs):
    rules = PackingRules(capacity=1024, tails_per_task=64)
    rows = whole(docs.repartition(50), rules)
    short = {r["sequence_id"] for r in rows}
    total = sum(r["length"] for r in rows)
    assert len(short) <= total // 1024 + 11


def test_digests(docs):
    packed = packing.packed(docs, PATH)
    ids = {(r["doc_id"], r["start"], r["sequence_id"], r["offset"]): r["ids"] for r in packed.collect()}
    for r in packing.digests(packed).collect():
        assert r["ids_crc32"] == zlib.crc32(ids[r["doc_id"], r["start"], r["sequence_id"], r["offset"]])
