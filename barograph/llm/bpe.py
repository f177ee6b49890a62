"""Byte-level BPE: whole texts to token ids and back.

Words of a batch (matches of a split pattern) that are not known yet are laid out as rows of padded
matrices, one matrix per length bucket. In each round every row merges its leftmost pair of minimum
rank; pairs are looked up in a hash table for all rows at once, rows are compacted, and finished
rows leave the matrix. The result of a word is kept, packed, for the next texts of the task.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Callable, Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barograph.llm.common import by_batch, documents, rows_to_batch, slices, utf8

NONE = np.int32(2**31 - 1)
#: Words of more bytes are merged by a queue of pairs instead of a matrix row. The rule is the same
#: (leftmost pair of minimum rank), but a round costs the logarithm of the length, not the length.
LONGEST_ROW = 512
#: Cells of one matrix, and bytes of words and ids that a task remembers; both bound memory, not results.
CELLS = 250_000
REMEMBERED = 16_000_000
#: What a remembered word takes besides its text and ids.
ENTRY = 200


def read_ranks(data: bytes) -> dict[bytes, int]:
    """Ranks of a ``.tiktoken`` file: base64 token and rank per line."""
    ranks = {}
    for line in data.splitlines():
        if line.strip():
            token, rank = line.split()
            ranks[base64.b64decode(token)] = int(rank)
    return ranks


class PairTable:
    """Open addressing over (left id, right id) -> id of the joined token."""

    def __init__(self, ranks: Mapping[bytes, int]):
        lefts, rights, joined = [], [], []
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    lefts.append(left)
                    rights.append(right)
                    joined.append(rank)
        keys = (np.array(lefts, np.uint64) << np.uint64(32)) | np.array(rights, np.uint64)
        values = np.array(joined, np.int32)
        self.bits = max(4, int(2 * len(keys) + 1).bit_length())
        self.mask = np.uint64((1 << self.bits) - 1)
        self.keys = np.full(1 << self.bits, np.uint64(2**64 - 1))
        self.values = np.full(1 << self.bits, NONE, np.int32)
        self.probes = 0
        slot = self._slot(keys)
        left = np.arange(len(keys))
        while len(left):
            self.probes += 1
            at = slot[left]
            free = self.keys[at] == np.uint64(2**64 - 1)
            # of several keys for one free slot the last write wins; the others go on
            self.keys[at[free]] = keys[left[free]]
            won = self.keys[at] == keys[left]
            self.values[at[won]] = values[left[won]]
            left = left[~won]
            slot[left] = (slot[left] + np.uint64(1)) & self.mask

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return (keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, NONE where the pair joins to no token."""
        keys = (left.astype(np.uint64) << np.uint64(32)) | right.astype(np.uint64)
        slot = self._slot(keys)
        found = self.keys[slot]
        out = np.where(found == keys, self.values[slot], NONE)
        open_ = np.flatnonzero((found != keys) & (found != np.uint64(2**64 - 1)))
        for _ in range(self.probes):
            if not len(open_):
                break
            slot[open_] = (slot[open_] + np.uint64(1)) & self.mask
            found = self.keys[slot[open_]]
            hit = found == keys[open_]
            out[open_[hit]] = self.values[slot[open_[hit]]]
            open_ = open_[~hit & (found != np.uint64(2**64 - 1))]
        return out


class Codec:
    """A vocabulary with the split pattern; encodes and decodes texts of one task."""

    def __init__(self, ranks: Mapping[bytes, int], pattern: str):
        self.ranks = dict(ranks)
        self.split = regex.compile(pattern)
        self.pairs = PairTable(ranks)
        self.bytes_ = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        self.tokens = tokens_of(ranks)

    def merged(self, words: Sequence[bytes]) -> list[bytes]:
        """Packed ids of each word."""
        out = [b""] * len(words)
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        for i in np.flatnonzero(lengths > LONGEST_ROW):
            out[i] = self._queued(words[i])
        order = np.argsort(lengths, kind="stable")
        order = order[(lengths[order] > 0) & (lengths[order] <= LONGEST_ROW)]
        at = 0
        while at < len(order):
            least = int(lengths[order[at]])
            width = least if least <= 8 else -(-least // 8) * 8  # buckets: 1 to 8, then multiples of 8
            end = int(np.searchsorted(lengths[order], width, "right"))
            end = min(end, at + max(1, CELLS // width))
            rows = order[at:end]
            for i, ids in zip(rows, self._matrix([words[i] for i in rows], width), strict=True):
                out[i] = ids
            at = end
        return out

    def _matrix(self, words: Sequence[bytes], width: int) -> list[bytes]:
        n = len(words)
        lengths = np.fromiter(map(len, words), np.int64, n)
        raw = np.frombuffer(b"".join(w.ljust(width, b"\0") for w in words), np.uint8).reshape(n, width)
        ids = self.bytes_[raw]
        done = [b""] * n
        rows = np.arange(n)
        if width > 1:
            ranks = self.pairs.ranks(ids[:, :-1].ravel(), ids[:, 1:].ravel()).reshape(n, width - 1)
            ranks[np.arange(1, width)[None, :] >= lengths[:, None]] = NONE
        else:
            ranks = np.full((n, 1), NONE, np.int32)
        while True:
            best = ranks.argmin(axis=1)  # the leftmost of equal minima
            least = ranks[np.arange(len(rows)), best]
            finished = least == NONE
            if finished.any():
                packed, row = ids[finished].astype("<u4").tobytes(), 4 * ids.shape[1]
                for k, (i, length) in enumerate(
                    zip(rows[finished].tolist(), lengths[finished].tolist(), strict=True)
                ):
                    done[i] = packed[k * row : k * row + 4 * length]
                going = ~finished
                if not going.any():
                    return done
                ids, ranks, rows, lengths = ids[going], ranks[going], rows[going], lengths[going]
                best, least = best[going], least[going]
            # join: the pair becomes one cell, cells to its right move one to the left
            width = ids.shape[1]
            source = np.arange(width - 1)[None, :] + (np.arange(width - 1)[None, :] > best[:, None])
            line = np.arange(len(rows))
            ids = np.take_along_axis(ids, source, axis=1)
            ids[line, best] = least
            lengths = lengths - 1
            if width == 2:
                ranks = np.full((len(rows), 1), NONE, np.int32)
                continue
            # rank p stands for the pair (p, p + 1); ranks after the joined pair move along
            ranks = np.take_along_axis(ranks, np.minimum(source[:, : width - 2], width - 2), axis=1)
            for shift in (-1, 0):
                at = best + shift
                inside = (at >= 0) & (at + 1 < lengths)
                k, p = line[inside], at[inside]
                ranks[k, p] = self.pairs.ranks(ids[k, p], ids[k, p + 1])
            end = (best >= 0) & (best + 1 >= lengths) & (best < width - 2)
            ranks[line[end], best[end]] = NONE

    def _queued(self, word: bytes) -> bytes:
        """The same merges for one long word: a heap of (rank, place) over a linked list."""
        ids = self.bytes_[np.frombuffer(word, np.uint8)].tolist()
        n = len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        first = self.pairs.ranks(np.array(ids[:-1], np.int32), np.array(ids[1:], np.int32)).tolist()
        heap = [(rank, i) for i, rank in enumerate(first) if rank != NONE]
        current = {i: rank for rank, i in heap}
        heapq.heapify(heap)
        text, tokens, ranks = ids, self.tokens, self.ranks

        def renew(i: int) -> None:
            current.pop(i, None)
            if i >= 0 and after[i] < n:
                rank = ranks.get(tokens[text[i]] + tokens[text[after[i]]])
                if rank is not None:
                    current[i] = rank
                    heapq.heappush(heap, (rank, i))

        while heap:
            rank, i = heapq.heappop(heap)
            if current.get(i) != rank:
                continue
            j = after[i]
            text[i], text[j] = rank, -1
            current.pop(j, None)
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            renew(i)
            renew(before[i])
        return np.array([x for x in text if x >= 0], "<u4").tobytes()

    def encode(self, texts: Sequence[str], memory: Memory | None = None) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        memory = memory if memory is not None else Memory()
        parts = [self.split.findall(text) for text in texts]
        used = set().union(*parts)
        if memory.size > REMEMBERED:
            memory.forget()
        new = list(used.difference(memory.known))
        memory.learn(new, self.merged([w.encode() for w in new]))
        return [b"".join(map(memory.known.__getitem__, words)) for words in parts]


class Memory:
    """Words that a task has met, with their ids; it ends with the task."""

    def __init__(self):
        self.known: dict[str, bytes] = {}
        self.size = 0

    def forget(self) -> None:
        self.known, self.size = {}, 0

    def learn(self, words: Sequence[str], ids: Sequence[bytes]) -> None:
        self.known.update(zip(words, ids, strict=True))
        self.size += sum(map(len, words)) + sum(map(len, ids)) + ENTRY * len(words)


def tokens_of(ranks: Mapping[bytes, int]) -> dict[int, bytes]:
    return {rank: token for token, rank in ranks.items()}


def joined(packed: bytes, tokens: Mapping[int, bytes]) -> bytes:
    """The bytes of packed ids."""
    return b"".join(map(tokens.__getitem__, np.frombuffer(packed, "<u4").tolist()))


def vocabulary(spark: SparkSession, path: str):
    """Bytes of a rank file as a broadcast; a vocabulary does not grow with the data."""
    with open(path, "rb") as file:
        return spark.sparkContext.broadcast(file.read())


_codecs: dict[tuple[int, str], Codec] = {}


def codec(data: bytes, pattern: str) -> Codec:
    """The rank tables, one per worker process; they do not grow."""
    key = (hash(data), pattern)
    if key not in _codecs:
        _codecs.clear()
        _codecs[key] = Codec(read_ranks(data), pattern)
    return _codecs[key]


#: Text characters that are encoded at once, and bytes of a batch that are unpacked at once.
PORTION = 500_000
UNPACKED = 1_000_000


def _by_portion(texts: list, step: Callable[[list], list]) -> Iterator:
    for start, end in slices(texts, PORTION):
        yield from step(texts[start:end])


def encode(
    docs: DataFrame,
    path: str,
    pattern: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    decoded: bool = False,
) -> DataFrame:
    """(doc_id, ids): the token ids of every whole text, packed as little-endian unsigned 32-bit
    integers; with ``decoded``, also the bytes that the ids stand for. Row by row: a null or empty text
    has no ids, repeated rows and null ids stay, other columns are not read, an empty table gives no
    rows."""
    data = vocabulary(docs.sparkSession, path)
    fields = [("doc_id", pa.int64()), ("ids", pa.binary()), ("decoded", pa.binary())]
    schema = pa.schema(fields if decoded else fields[:2])

    def make():
        c, memory = codec(data.value, pattern), Memory()

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts = [text or "" for text in batch.column("text").to_pylist()]
            ids = list(_by_portion(texts, lambda some: c.encode(some, memory)))
            columns = [batch.column("doc_id"), ids]
            if decoded:
                columns.append([joined(x, c.tokens) for x in ids])
            return rows_to_batch(schema, columns)

        return step

    return by_batch(
        documents(docs, id_col, text_col),
        make,
        "doc_id long, ids binary" + ", decoded binary" * decoded,
        UNPACKED,
    )


def decode(encoded: DataFrame, path: str, ids_col: str = "ids") -> DataFrame:
    """The rows of ``encoded`` (doc_id and packed ids) with ``decoded``, the bytes of the ids; null ids
    are no bytes."""
    data = vocabulary(encoded.sparkSession, path)
    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.binary()), ("decoded", pa.binary())])

    def make():
        tokens = tokens_of(read_ranks(data.value))

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            ids = batch.column("ids")
            return rows_to_batch(
                schema, [batch.column("doc_id"), ids, [joined(x or b"", tokens) for x in ids.to_pylist()]]
            )

        return step

    return by_batch(
        encoded.select("doc_id", F.col(ids_col).alias("ids")),
        make,
        "doc_id long, ids binary, decoded binary",
        UNPACKED,
    )


def digests(decoded: DataFrame) -> DataFrame:
    """Counts and digests of encoded and decoded documents."""
    return decoded.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
