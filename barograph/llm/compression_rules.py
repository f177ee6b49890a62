"""Quality rules by compression bands, after plain counts of words, symbols and repeats.

zstandard ratios (bytes over compressed bytes) are taken of the whole text and of chunks of fixed
size. Prose stays inside a band that depends on the length of what is compressed; text above the
band repeats itself, text below it is noise or encoded data.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from barograph.llm.common import SPACES, by_batch, documents, rows_to_batch, utf8


@dataclass(frozen=True)
class Band:
    """Ratios that are fine for texts of up to ``up_to`` bytes."""

    up_to: float
    least: float
    most: float


@dataclass(frozen=True)
class Bands:
    whole: tuple[Band, ...] = (
        Band(200, 0.0, 2.5),
        Band(1_000, 1.1, 2.7),
        Band(4_000, 1.3, 3.2),
        Band(16_000, 1.4, 3.8),
        Band(float("inf"), 1.5, 4.5),
    )
    chunk_bytes: int = 2048
    chunk: Band = Band(2048, 1.3, 3.2)
    #: The largest share of chunks outside their band.
    outside: float = 0.25
    level: int = 3


DEFAULT_BANDS = Bands()
SYMBOLS = b"#*$%&|<>"
WINDOW = 5

_NO_CODE_POINT = bytes(range(0x80, 0xC0)) + SPACES
_SCHEMA = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long,"
    " n_repeat_words long, whole_ratio double, least_chunk_ratio double, most_chunk_ratio double,"
    " chunks long, chunks_outside long, in_bands boolean"
)


def repeated_words(words: Sequence[bytes], window: int = WINDOW) -> int:
    """Words covered by windows that occur twice or more; exact, window codes do not collide."""
    runs = len(words) - window + 1
    if runs < 2:
        return 0
    numbers: dict[bytes, int] = {}
    ids = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, len(words))
    size = len(numbers)
    codes, span = ids[:runs], size
    for k in range(1, window):
        if span > 2**62 // size:
            codes = np.unique(codes, return_inverse=True)[1].astype(np.int64)
            span = int(codes.max()) + 1
        codes = codes * size + ids[k : k + runs]
        span *= size
    order = np.sort(codes)
    if not (order[1:] == order[:-1]).any():
        return 0
    _, inverse, counts = np.unique(codes, return_inverse=True, return_counts=True)
    starts = np.flatnonzero(counts[inverse] > 1)
    edges = np.zeros(len(words) + 1, np.int64)
    np.add.at(edges, starts, 1)
    np.add.at(edges, starts + window, -1)
    return int((np.cumsum(edges) > 0).sum())


def counts(text: bytes) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words of a text."""
    words = text.split()
    lines = [line for line in text.split(b"\n") if line.strip()]
    return (
        len(words),
        len(text.translate(None, _NO_CODE_POINT)),
        len(text) - len(text.translate(None, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeated_words(words),
    )


def judged(text: bytes, press: zstandard.ZstdCompressor, bands: Bands) -> tuple:
    """Ratios of a text and whether they are inside their bands. A text without a byte has no ratio
    and is inside, and one shorter than a chunk is judged as a whole only. The last chunk is a full one
    that ends with the text, so it may overlap the one before."""
    if not text:
        return None, None, None, 0, 0, True
    whole = len(text) / len(press.compress(text))
    size = bands.chunk_bytes
    pieces = [text[i : i + size] for i in range(0, len(text) - size + 1, size)]
    if pieces and len(text) % size:
        pieces.append(text[-size:])
    ratios = [len(piece) / len(press.compress(piece)) for piece in pieces]
    outside = sum(not bands.chunk.least <= r <= bands.chunk.most for r in ratios)
    band = next(b for b in bands.whole if len(text) <= b.up_to)
    fine = band.least <= whole <= band.most and outside <= bands.outside * len(ratios)
    return whole, min(ratios, default=None), max(ratios, default=None), len(ratios), outside, fine


def compression_rules(
    docs: DataFrame, bands: Bands = DEFAULT_BANDS, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Counts, ratios and ``in_bands`` of every whole text. Row by row: a null text counts as empty,
    repeated rows and null ids stay, other columns are not read, no rows give no rows."""

    def make():
        press = zstandard.ZstdCompressor(level=bands.level, write_checksum=False, write_content_size=False)
        schema = pa.schema(
            [("doc_id", pa.int64()), *[(n, pa.int64()) for n in
             ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
             *[(n, pa.float64()) for n in ("whole_ratio", "least_chunk_ratio", "most_chunk_ratio")],
             ("chunks", pa.int64()), ("chunks_outside", pa.int64()), ("in_bands", pa.bool_())]
        )

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            rows = [
                (*counts(text or b""), *judged(text or b"", press, bands))
                for text in utf8(batch.column("text"))
            ]
            return rows_to_batch(schema, [batch.column("doc_id"), *map(list, zip(*rows, strict=True))])

        return step

    return by_batch(documents(docs, id_col, text_col), make, _SCHEMA)
