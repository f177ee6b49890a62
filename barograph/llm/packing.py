"""Token sequences of one fixed length, packed with minimum bin slack.

A document becomes token ids and an end mark. Whole windows of a long document are sequences of their
own; its remainder joins the pool of its task. Each further sequence is the fullest multiset of
remaining lengths: a subset-sum table, kept as the bits of one integer per length, says which sums
are reachable, and walking back through it gives the count of every length. Only when no multiset
fills a sequence exactly is one more remainder cut to fill it.

A task packs what it reads, so texts and ids are never shuffled. What is left of a task, less than
one sequence, is packed again by few tasks; there the last tokens fill sequences of falling powers of
two, which need no padding. Every table in between is stored, so a lost executor changes nothing.
"""

from __future__ import annotations

import os
import re
from collections import defaultdict
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer, normalizers, pre_tokenizers

from barograph.llm.common import documents, pieces, stored
from barograph.session import ship_package


@dataclass(frozen=True)
class PackingRules:
    capacity: int = 2048  # tokens of a sequence, a power of two
    end_id: int = 1  # stands after every document
    pool_tokens: int = 1 << 20  # remainders a task holds before it packs
    tails_per_task: int = 64  # tasks whose last tokens are packed together


DEFAULT_RULES = PackingRules()

#: Text bytes whose different words are found together.
PORTION = 16_000_000
#: Latin letters that neither composition nor lower-casing turns into anything but one letter.
LATIN = "A-Za-zÀ-ÖØ-öø-įı-ſ"
PLAIN = re.compile(f"[!-~{LATIN}]+")
#: How the tokenizer splits such words, after lower-casing.
PARTS = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{LATIN}]+|[0-9]|[^{LATIN}0-9]+")
LETTERS = f"^[{LATIN}]+$"
#: Parts that the tokenizer sees in one line.
LINE = 400


def _spread(sizes: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For lists of ``sizes`` that lie one behind the other: (places of the entries of the lists named
    by ``codes``, where each of these lists ends)."""
    lengths = sizes[codes]
    ends = np.cumsum(lengths)
    places = np.repeat(np.cumsum(sizes)[codes] - ends, lengths)
    places += np.arange(len(places))
    return places, ends


class WordTokens:
    """Ids of texts by a tokenizer that drops white space and marks the ends of words.

    Such a tokenizer treats every run between ASCII white space alone, so each different run of a
    batch is looked at once. A run of common characters is split into parts here, in lower case, and
    the different parts are sent to the tokenizer's merges in lines; the marked ends divide the ids
    again. Any other run is encoded by the whole tokenizer.
    """

    def __init__(self, definition: str, suffix: str = "</w>"):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks share the cores
        self.tokenizer = Tokenizer.from_str(definition)
        self.merges = Tokenizer.from_str(definition)
        self.merges.normalizer = normalizers.Sequence([])
        self.merges.pre_tokenizer = pre_tokenizers.Sequence(
            [
                pre_tokenizers.CharDelimiterSplit(" "),
                pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False),
            ]
        )
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
        self.ends = np.zeros(self.tokenizer.get_vocab_size() + 1, bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith(suffix)]] = True
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]

    def texts(self, texts: pa.Array, end_id: int | None = None) -> list[bytes]:
        """Packed little-endian unsigned 32-bit ids of each text, closed by ``end_id`` if one is given."""
        split = pc.ascii_split_whitespace(pc.fill_null(texts, "").cast(pa.large_string()))
        coded = split.flatten().dictionary_encode()
        n_parts, parts, sizes, ids = self._words(coded.dictionary)
        at, word_ends = _spread(n_parts, coded.indices.to_numpy(zero_copy_only=False))
        at, part_ends = _spread(sizes, parts[at])
        packed = ids[at].tobytes()
        ends = np.concatenate([[0], part_ends])[np.concatenate([[0], word_ends])]
        bounds = (4 * ends[split.offsets.to_numpy()]).tolist()
        tail = b"" if end_id is None else np.array([end_id], "<u4").tobytes()
        return [packed[a:b] + tail for a, b in zip(bounds[:-1], bounds[1:], strict=True)]

    def _words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(parts per word, number of each such part, ids per numbered part, all ids)."""
        letters = pc.match_substring_regex(words, LETTERS)
        one = letters.to_numpy(zero_copy_only=False)
        n_parts = one.astype(np.int64)
        split: list[str] = []
        alone: list[tuple[int, str]] = []
        for i, word in zip(np.flatnonzero(~one).tolist(), words.filter(pc.invert(letters)).to_pylist(), strict=True):
            if self._plain(word):
                found = PARTS.findall(word.lower())
                n_parts[i] = len(found)
                split += found
            elif word:
                n_parts[i] = 1
                alone.append((len(split), word))
                split.append("")
        coded = pa.concat_arrays(
            [pc.utf8_lower(words.filter(letters)), pa.array(split, pa.large_string())]
        ).dictionary_encode()
        codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        known, n_whole = len(coded.dictionary), int(one.sum())
        for k, (at, _) in enumerate(alone):
            codes[n_whole + at] = known + k
        # in the order of the words: words of letters are one part, the others follow each other
        parts = np.empty(len(codes), np.int64)
        single = np.zeros(len(codes), bool)
        single[(np.cumsum(n_parts) - n_parts)[one]] = True
        parts[single], parts[~single] = codes[:n_whole], codes[n_whole:]
        ids = [*self._lines(coded.dictionary), *self._ids(self.tokenizer, [word for _, word in alone])]
        all_ids = np.concatenate(ids) if ids else np.zeros(0, "<u4")
        lines = len(ids) - len(alone)
        texts = pc.not_equal(coded.dictionary, "").to_numpy(zero_copy_only=False)
        sizes = np.zeros(known + len(alone), np.int64)
        if lines:
            stops = np.flatnonzero(self.ends[np.concatenate(ids[:lines])]) + 1
            if len(stops) != texts.sum():
                raise ValueError("the tokenizer does not end every part of a word with a marked token")
            sizes[np.flatnonzero(texts)] = np.diff(stops, prepend=0)
        sizes[known:] = list(map(len, ids[lines:]))
        return n_parts, parts, sizes, all_ids

    def _plain(self, text: str) -> bool:
        return PLAIN.fullmatch(text) is not None and not any(token in text for token in self.added)

    def _lines(self, parts: pa.Array) -> list[np.ndarray]:
        parts = parts.filter(pc.not_equal(parts, ""))
        offsets = np.append(np.arange(0, len(parts), LINE), len(parts))
        lists = pa.LargeListArray.from_arrays(pa.array(offsets, pa.int64()), parts)
        return self._ids(self.merges, pc.binary_join(lists, pa.scalar(" ", pa.large_string())).to_pylist())

    def _ids(self, tokenizer: Tokenizer, texts: list[str]) -> list[np.ndarray]:
        found = tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(x.ids, "<u4") for x in found]


def fullest(counts: np.ndarray, capacity: int) -> dict[int, int]:
    """{length: how often}: a multiset of the counted lengths whose sum comes nearest to ``capacity``
    from below. The greatest length that fits is always in it."""
    fits = np.flatnonzero(counts[: capacity + 1])
    if not len(fits):
        return {}
    anchor = int(fits[-1])
    goal, mask = 1 << capacity, (2 << capacity) - 1
    reach = 1 << anchor
    layers = []
    for length in fits[: np.searchsorted(fits, capacity - anchor, "right")][::-1].tolist():
        layers.append((length, reach))
        left = min(int(counts[length]) - (length == anchor), capacity // length)
        step = 1
        while left > 0:
            step = min(step, left)
            reach |= (reach << step * length) & mask
            left -= step
            step *= 2
        if reach & goal:
            break
    at = reach.bit_length() - 1
    chosen = {anchor: 1}
    for length, before in reversed(layers):
        while not before >> at & 1:
            at -= length
            chosen[length] = chosen.get(length, 0) + 1
    return chosen


class Piece(NamedTuple):
    """Part of a document: its ids from ``start`` on."""

    doc_id: int | None
    start: int
    ids: bytes
    doc_tokens: int

    def cut(self, length: int) -> tuple[Piece, Piece]:
        head, rest = self.ids[: 4 * length], self.ids[4 * length :]
        return (
            Piece(self.doc_id, self.start, head, self.doc_tokens),
            Piece(self.doc_id, self.start + length, rest, self.doc_tokens),
        )


class Packer:
    """Remainders by length; ``window`` takes out the pieces of one sequence."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.counts = np.zeros(capacity + 1, np.int64)
        self.held: dict[int, list[Piece]] = defaultdict(list)
        self.tokens = 0

    def put(self, piece: Piece) -> None:
        length = len(piece.ids) // 4
        self.counts[length] += 1
        self.held[length].append(piece)
        self.tokens += length

    def take(self, length: int) -> Piece:
        self.counts[length] -= 1
        self.tokens -= length
        return self.held[length].pop()

    def whole(self, piece: Piece) -> Iterator[list[Piece]]:
        """The full sequences of one long piece; its remainder is put to the others."""
        while len(piece.ids) >= 4 * self.capacity:
            head, piece = piece.cut(self.capacity)
            yield [head]
        if piece.ids:
            self.put(piece)

    def window(self, capacity: int) -> list[Piece]:
        """Pieces of exactly ``capacity`` tokens, of which at least as many are held."""
        out = [self.take(length) for length, n in fullest(self.counts, capacity).items() for _ in range(n)]
        slack = capacity - sum(len(piece.ids) for piece in out) // 4
        if slack:
            # whatever is still held is longer, or it would have been added
            shortest = slack + 1 + int(np.flatnonzero(self.counts[slack + 1 :])[0])
            head, rest = self.take(shortest).cut(slack)
            out.append(head)
            self.put(rest)
        return out

    def windows(self, keep: int) -> Iterator[list[Piece]]:
        """Full sequences while more than ``keep`` tokens are held."""
        while self.tokens >= max(keep, self.capacity):
            yield self.window(self.capacity)

    def last(self) -> Iterator[list[Piece]]:
        """Sequences of falling powers of two for the few tokens left."""
        while self.tokens:
            yield self.window(1 << self.tokens.bit_length() - 1)

    def leftover(self) -> list[Piece]:
        return [piece for pieces in self.held.values() for piece in pieces]


PIECES = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
_FIELDS = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("start", pa.int64()),
        ("length", pa.int64()),
        ("ids", pa.binary()),
        ("doc_tokens", pa.int64()),
        ("sequence_id", pa.int64()),
        ("offset", pa.int64()),
    ]
)


class _Rows:
    """Sequences as Arrow batches; sequences of a task are numbered from ``first``."""

    def __init__(self, first: int):
        self.next = first
        self.rows: list[tuple] = []

    def add(self, sequence: list[Piece]) -> None:
        offset = 0
        for piece in sequence:
            length = len(piece.ids) // 4
            self.rows.append((piece.doc_id, piece.start, length, piece.ids, piece.doc_tokens, self.next, offset))
            offset += length
        self.next += 1

    def left(self, pieces: list[Piece]) -> None:
        self.rows += [(p.doc_id, p.start, len(p.ids) // 4, p.ids, p.doc_tokens, None, None) for p in pieces]

    def batch(self) -> pa.RecordBatch:
        columns = list(zip(*self.rows, strict=True)) or [()] * len(_FIELDS)
        self.rows = []
        arrays = [pa.array(values, field.type) for values, field in zip(columns, _FIELDS, strict=True)]
        return pa.RecordBatch.from_arrays(arrays, schema=_FIELDS)


#: Sequence numbers of a task, and what the second pass adds to its own.
_TASK, _SECOND = 1 << 32, 1 << 62


def _packing(
    rules: PackingRules, make: Callable[[], Callable[[pa.RecordBatch], Iterator[Piece]]], final: bool
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read = make()
        packer = Packer(rules.capacity)
        rows = _Rows(TaskContext.get().partitionId() * _TASK + final * _SECOND)
        for batch in pieces(batches, PORTION):
            for piece in read(batch):
                for sequence in packer.whole(piece):
                    rows.add(sequence)
            for sequence in packer.windows(rules.pool_tokens):
                rows.add(sequence)
            yield rows.batch()
        for sequence in packer.windows(0):
            rows.add(sequence)
        if final:
            for sequence in packer.last():
                rows.add(sequence)
        else:
            rows.left(packer.leftover())
        yield rows.batch()

    return run


def packed(
    docs: DataFrame,
    path: str,
    rules: PackingRules = DEFAULT_RULES,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(doc_id, start, length, ids, doc_tokens, sequence_id, offset), one row per piece of a document.

    ``ids`` are packed little-endian unsigned 32-bit integers, ``start`` counts the ids of the document
    before the piece. A null or empty text is its end mark alone, repeated rows and null ids stay
    documents of their own, texts of any length are encoded whole, other columns are not read, an
    empty table gives no rows. Sequence ids have gaps; which pieces share a sequence depends on how
    the table is split.
    """
    spark = docs.sparkSession
    ship_package(spark)
    with open(path, encoding="utf-8") as file:
        data = spark.sparkContext.broadcast(file.read())  # a vocabulary does not grow with the data

    def encoded():
        words = WordTokens(data.value)

        def read(batch: pa.RecordBatch) -> Iterator[Piece]:
            found = words.texts(batch.column("text"), rules.end_id)
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), found, strict=True):
                yield Piece(doc_id, 0, ids, len(ids) // 4)

        return read

    first = stored(
        documents(docs, id_col, text_col).mapInArrow(_packing(rules, encoded, False), PIECES), "packed"
    )
    tails = first.where("sequence_id IS NULL")
    tasks = max(1, tails.rdd.getNumPartitions() // rules.tails_per_task)

    def read_again():
        def read(batch: pa.RecordBatch) -> Iterator[Piece]:
            columns = [batch.column(name).to_pylist() for name in ("doc_id", "start", "ids", "doc_tokens")]
            for row in zip(*columns, strict=True):
                yield Piece(*row)

        return read

    second = tails.coalesce(tasks).mapInArrow(_packing(rules, read_again, True), PIECES)
    return first.where("sequence_id IS NOT NULL").unionByName(stored(second, "packed-tails"))


def digests(packed_rows: DataFrame) -> DataFrame:
    """The pieces with a checksum in place of their ids."""
    return packed_rows.select(
        "doc_id",
        "start",
        "length",
        F.crc32("ids").alias("ids_crc32"),
        "doc_tokens",
        "sequence_id",
        "offset",
    )
