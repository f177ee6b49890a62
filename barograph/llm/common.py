"""Small helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barograph.session import scratch_path, ship_package

#: ASCII white space: space, tab, line feed, vertical tab, form feed, carriage return.
SPACES = b"\x20\x09\x0a\x0b\x0c\x0d"
WORD_BREAKS = "[\\x20\\x09-\\x0D]+"

#: Word shingles of near-duplicate operators and the least similarity, as a percentage.
SHINGLE_WORDS = 5
LEAST_SIMILARITY = 75


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """The same rows as a table in the shared folder: cuts lineage, survives lost executors."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def documents(docs: DataFrame, id_col: str, text_col: str, *more: str) -> DataFrame:
    """Only the columns an operator reads, so that other columns cannot clash with its own."""
    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.col(text_col).cast("string").alias("text"),
        *[F.col(name) for name in more],
    )


def remainder(column: str | Column, divisor: int) -> Column:
    """crc32 of a value written as text, modulo a divisor; a null counts as the empty text."""
    value = F.col(column) if isinstance(column, str) else column
    return F.crc32(F.coalesce(value.cast("string"), F.lit("")).cast("binary")) % divisor


def utf8(column: pa.Array | pa.ChunkedArray) -> list[bytes | None]:
    """The texts of an Arrow column as UTF-8 bytes."""
    return column.cast(pa.binary()).to_pylist()


def rows_to_batch(schema: pa.Schema, columns: Sequence) -> pa.RecordBatch:
    arrays = [
        value if isinstance(value, pa.Array) else pa.array(value, type=field.type)
        for field, value in zip(schema, columns, strict=True)
    ]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


#: Bytes of an Arrow batch that a step sees at once.
PIECE = 4_000_000


def pieces(batches: Iterable[pa.RecordBatch], size: int = PIECE) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``size`` bytes at most, or one row."""
    for batch in batches:
        rows = max(1, batch.num_rows * size // max(size, batch.nbytes))
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def give_back() -> None:
    """Return free memory to the system: Arrow's, and that of the C library where it can."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def by_batch(
    df: DataFrame,
    make: Callable[[], Callable[[pa.RecordBatch], pa.RecordBatch]],
    schema: str,
    piece: int = PIECE,
) -> DataFrame:
    """Apply ``make()`` once per task, and what it returns to the Arrow batches of the task, piece by
    piece, so that no more than ``piece`` bytes (or one row) are unpacked at once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = make()
        for batch in pieces(batches, piece):
            yield step(batch)
        del step
        give_back()  # the worker goes on to other tasks

    ship_package(df.sparkSession)
    return df.mapInArrow(run, schema)


def slices(texts: Sequence, limit: int) -> Iterator[tuple[int, int]]:
    """Runs of rows whose texts have about ``limit`` bytes together; a longer text stands alone."""
    start, size = 0, 0
    for i, text in enumerate(texts):
        length = len(text) if text is not None else 0
        if i > start and size + length > limit:
            yield start, i
            start, size = i, 0
        size += length
    if start < len(texts):
        yield start, len(texts)


_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


def mixed(values: np.ndarray) -> np.ndarray:
    """A bijective scramble of unsigned 64-bit integers."""
    x = values ^ (values >> np.uint64(30))
    x = x * _MIX[0]
    x ^= x >> np.uint64(27)
    x *= _MIX[1]
    return x ^ (x >> np.uint64(31))


def shingle_hashes(words: Sequence[bytes], width: int, hash_word: Callable[[bytes], int]) -> np.ndarray:
    """64-bit hashes of all runs of ``width`` words, in order; fewer words are one run."""
    if not words:
        return np.empty(0, np.uint64)
    codes = np.fromiter(map(hash_word, words), np.uint64, len(words))
    width = min(width, len(words))
    runs = len(words) - width + 1
    out = np.full(runs, width, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(width):
            out = mixed(out * np.uint64(0x9E3779B97F4A7C15) + codes[k : k + runs])
    return out


def union_all(frames: Iterable[DataFrame]) -> DataFrame:
    frames = list(frames)
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out


def unused(docs: DataFrame, name: str) -> str:
    """A column name that the table does not have."""
    taken = {column.lower() for column in docs.columns}
    while name.lower() in taken:
        name += "_"
    return name


def without(docs: DataFrame, keys: DataFrame, on: Sequence[str], most: int = 2_000_000) -> DataFrame:
    """Rows of ``docs`` whose key is not in ``keys``. Up to ``most`` keys are broadcast, so the texts
    stay where they are; more keys make it a shuffled join."""
    keys = keys.select(*on).distinct()
    if keys.limit(most + 1).count() <= most:
        keys = F.broadcast(keys)
    return docs.join(keys, list(on), "left_anti")
