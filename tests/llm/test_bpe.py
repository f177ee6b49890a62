import hashlib
import random
import struct
import tracemalloc

import public_tokenizers
import pytest
import tiktoken

from barograph.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def codec():
    with open(PATH, "rb") as file:
        return bpe.Codec(bpe.read_ranks(file.read()), public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def reference(codec):
    return tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=codec.ranks, special_tokens={}
    )


def packed(ids):
    return struct.pack(f"<{len(ids)}I", *ids)


def test_equals_the_public_library_on_odd_texts(codec, reference):
    rng = random.Random(5)
    alphabet = "abcdeé ñ😀\n\t 12!?'sthe"
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(80))) for _ in range(400)]
    texts += ["", "a" * 4000, "ab" * 900, " " * 700, "x" * bpe.LONGEST_ROW, "x" * (bpe.LONGEST_ROW + 1), "'s't're"]
    texts += ["".join(rng.choice("etaoin") for _ in range(n)) for n in (7, 8, 9, 511, 513, 2000)]
    encoded = codec.encode(texts)
    assert encoded == [packed(reference.encode_ordinary(t)) for t in texts]
    assert [bpe.joined(x, codec.tokens) for x in encoded] == [t.encode() for t in texts]


def test_matrix_and_queue_agree(codec):
    words = [("thethe" * n).encode() for n in (1, 5, 40)]
    assert codec.merged(words) == [codec._queued(w) for w in words]


def test_pair_table_finds_all_pairs_and_no_others():
    ranks = {bytes([b]): b for b in range(256)} | {b"ab": 256, b"abc": 257, b"bc": 258}
    table = bpe.PairTable(ranks)
    import numpy as np

    found = table.ranks(np.array([97, 256, 97, 98, 97]), np.array([98, 99, 258, 99, 97]))
    assert found.tolist() == [256, 257, 257, 258, int(bpe.NONE)]


def test_forgetting_words_changes_nothing(codec, monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 900)
    memory = bpe.Memory()
    texts = ["one two three four", "two five six", "one seven", "two"]
    sizes = []
    for text in texts:
        assert codec.encode([text], memory) == codec.encode([text])
        sizes.append(memory.size)
    assert sizes[2] < sizes[1]  # forgotten in between


def test_memory_of_new_words_is_bounded(codec):
    rng = random.Random(9)
    words = ["".join(rng.choice("etaoinsr") for _ in range(48)) for _ in range(24_000)]
    texts = [" ".join(words[k : k + 200]) for k in range(0, len(words), 200)]
    memory = bpe.Memory()
    tracemalloc.start()
    encoded = list(bpe._by_portion(texts, lambda some: codec.encode(some, memory)))
    kept, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert [bpe.joined(x, codec.tokens).decode() for x in encoded] == texts
    assert peak - kept < 15_000_000


def test_rows_of_spark(odd, none, reference):
    rows = bpe.digests(bpe.encode(odd, PATH, public_tokenizers.PATTERN, decoded=True))
    again = bpe.digests(bpe.decode(bpe.encode(odd, PATH, public_tokenizers.PATTERN), PATH))
    assert sorted(map(repr, rows.collect())) == sorted(map(repr, again.collect()))
    wanted = []
    for row in odd.select("doc_id", "text").collect():
        text = row["text"] or ""
        ids = reference.encode_ordinary(text)
        digest = hashlib.sha256(packed(ids)).hexdigest()
        wanted.append((row["doc_id"], len(ids), digest, hashlib.sha256(text.encode()).hexdigest()))
    assert sorted(map(repr, map(tuple, rows.collect()))) == sorted(map(repr, wanted))
    assert bpe.encode(none, PATH, public_tokenizers.PATTERN).count() == 0
