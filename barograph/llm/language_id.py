"""Language identification by nearest centroid.

A text is a normalised TF-IDF vector of hashed n-grams of one to three bytes (letters in lower case,
every other ASCII character a space). Each language has several centroids, found by spherical
k-means. A text gets the language of the centroid with the largest cosine; it is marked as rejected
when it is farther from that centroid than nearly all rows the centroid was made of.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barograph.llm.common import by_batch, documents, pieces, remainder, rows_to_batch, slices, utf8
from barograph.session import ship_package


@dataclass(frozen=True)
class LanguageRules:
    #: Hash buckets of n-grams.
    buckets: int = 8192
    #: Rows per language that centroids are made of, about (chosen by a hash).
    rows_per_language: int = 1500
    centroids: int = 4
    rounds: int = 12
    seed: int = 7
    #: A centroid accepts rows up to this quantile of its own distances, times the slack.
    quantile: float = 0.99
    slack: float = 1.25
    #: Folds by remainder: never learned from.
    folds: int = 4
    held_out: int = 2


DEFAULT_RULES = LanguageRules()
UNKNOWN = "und"
_LETTER = regex.compile(r"\p{L}")
#: Text bytes whose n-grams are counted at once, and rows of one dense matrix.
PORTION, ROWS = 2_000_000, 256

_FOLD = np.full(256, 0x20, np.uint8)
_FOLD[0x80:] = np.arange(0x80, 0x100)
for _upper, _lower in zip(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz", strict=True):
    _FOLD[_upper] = _FOLD[_lower] = _lower


def term_counts(texts: list[bytes | None], buckets: int) -> np.ndarray:
    """Counts of hashed n-grams, a row per text."""
    out = np.zeros((len(texts), buckets), np.float32)
    shift = np.uint64(64 - int(buckets).bit_length() + 1)
    for i, text in enumerate(texts):
        if not text:
            continue
        folded = _FOLD[np.frombuffer(b" " + text + b" ", np.uint8)].astype(np.uint32)
        # white space counts once
        folded = folded[np.concatenate([[True], (folded[1:] != 0x20) | (folded[:-1] != 0x20)])]
        two = (folded[:-1] << 8) | folded[1:]
        grams = [folded | (1 << 24), two | (2 << 24), (two[:-1] << 8 | folded[2:]) + (3 << 24)]
        for gram in grams:
            with np.errstate(over="ignore"):
                cell = (gram.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> shift
            out[i] += np.bincount(cell.astype(np.int64), minlength=buckets)
    return out


def unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-12)


def vectors(texts: list[bytes | None], weights: np.ndarray) -> np.ndarray:
    """Normalised TF-IDF rows; a text without letters or spaces is a zero row."""
    return unit(np.log1p(term_counts(texts, len(weights))) * weights)


@dataclass(frozen=True)
class LanguageModel:
    """Weights of the buckets and all centroids; its size depends on the rules and languages."""

    weights: np.ndarray
    languages: list[str]
    centroids: np.ndarray
    limits: np.ndarray

    def nearest(self, texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
        """Number of the nearest centroid and the cosine, per text."""
        cosines = vectors(texts, self.weights) @ self.centroids.T
        best = cosines.argmax(axis=1)
        return best, np.clip(cosines[np.arange(len(texts)), best], 0, 1)


def document_frequencies(learned: DataFrame, rules: LanguageRules) -> np.ndarray:
    """In how many texts each bucket occurs; partitions count, Spark adds. The last cell counts texts."""
    n = rules.buckets

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(n + 1, np.int64)
        for batch in pieces(batches):
            texts = utf8(batch.column("text"))
            for first in range(0, len(texts), ROWS):
                total[:n] += (term_counts(texts[first : first + ROWS], n) > 0).sum(axis=0)
            total[n] += len(texts)
        cells = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(cells, pa.int32()), pa.array(total[cells], pa.int64())], names=["cell", "texts"]
        )

    ship_package(learned.sparkSession)
    sums = (
        learned.select("text")
        .mapInArrow(count, "cell int, texts long")
        .groupBy("cell")
        .agg(F.sum("texts").alias("texts"))
        .toPandas()
    )
    out = np.zeros(n + 1)
    out[sums["cell"]] = sums["texts"]
    return out


def clustered(rows: np.ndarray, rules: LanguageRules) -> tuple[np.ndarray, np.ndarray]:
    """Spherical k-means: unit centroids, and the limit of the distance of each."""
    rng = np.random.default_rng(rules.seed)
    k = min(rules.centroids, len(rows))
    chosen = [int(rng.integers(len(rows)))]
    for _ in range(k - 1):  # the next seed is the row farthest from all seeds
        chosen.append(int((rows @ rows[chosen].T).max(axis=1).argmin()))
    centroids = rows[chosen]
    for _ in range(rules.rounds):
        nearest = (rows @ centroids.T).argmax(axis=1)
        centroids = unit(
            np.stack(
                [rows[nearest == j].sum(axis=0) if (nearest == j).any() else centroids[j] for j in range(k)]
            )
        )
    cosines = rows @ centroids.T
    nearest = cosines.argmax(axis=1)
    everywhere = np.quantile(1 - cosines.max(axis=1), rules.quantile)
    limits = [
        max(everywhere, np.quantile(1 - cosines[nearest == j, j], rules.quantile))
        if (nearest == j).any()
        else everywhere
        for j in range(k)
    ]
    return centroids, np.minimum(np.array(limits) * rules.slack, 1.0)


def fit(docs: DataFrame, rules: LanguageRules = DEFAULT_RULES) -> LanguageModel | None:
    """The model of rows (doc_id, text, lang) outside the held-out fold that have a language and a
    text; None without such rows. Weights count all of them; centroids are made of a sample of
    bounded size per language."""
    learned = docs.where(
        F.col("lang").isNotNull()
        & F.col("text").isNotNull()
        & (remainder("doc_id", rules.folds) != rules.held_out)
    )
    sizes = {row["lang"]: row["count"] for row in learned.groupBy("lang").count().collect()}
    if not sizes:
        return None
    found = document_frequencies(learned, rules)
    weights = (np.log((1 + found[-1]) / (1 + found[:-1])) + 0.05).astype(np.float32)

    spread = 1 << 30
    share = F.lit(0)
    for lang, size in sizes.items():
        part = min(spread, int(spread * min(1.0, rules.rows_per_language / size)) + 1)
        share = F.when(F.col("lang") == lang, F.lit(part)).otherwise(share)
    sample = learned.where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(spread)) < share)

    def vectorised(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(frames):
            texts = utf8(batch.column("text"))
            for first, last in slices(texts, PORTION):
                for at in range(first, last, ROWS):
                    block = vectors(texts[at : min(last, at + ROWS)], weights)
                    cells = [np.flatnonzero(row) for row in block]
                    yield pa.RecordBatch.from_arrays(
                        [
                            batch.column("lang").slice(at, len(block)),
                            pa.array([c.astype(np.uint16).tobytes() for c in cells], pa.binary()),
                            pa.array([row[c].tobytes() for row, c in zip(block, cells, strict=True)], pa.binary()),
                        ],
                        names=["lang", "cells", "parts"],
                    )

    def cluster(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["cells", "parts"])
        rows = np.zeros((len(frame), rules.buckets), np.float32)
        for i, (cells, parts) in enumerate(zip(frame["cells"], frame["parts"], strict=True)):
            rows[i, np.frombuffer(cells, np.uint16)] = np.frombuffer(parts, np.float32)
        centroids, limits = clustered(rows, rules)
        return pd.DataFrame(
            {
                "lang": frame["lang"].iloc[0],
                "number": range(len(centroids)),
                "centroid": [c.astype(np.float32).tobytes() for c in centroids],
                "limit": limits,
            }
        )

    centroids = (
        sample.select("lang", "text")
        .mapInArrow(vectorised, "lang string, cells binary, parts binary")
        .groupBy("lang")
        .applyInPandas(cluster, "lang string, number int, centroid binary, limit double")
        .toPandas()
        .sort_values(["lang", "number"])
    )
    if not len(centroids):
        return None
    return LanguageModel(
        weights,
        centroids["lang"].tolist(),
        np.stack([np.frombuffer(c, np.float32) for c in centroids["centroid"]]),
        centroids["limit"].to_numpy(),
    )


def predicted(docs: DataFrame, model: LanguageModel | None) -> DataFrame:
    """(doc_id, lang_pred, score, rejected) for rows (doc_id, text). ``score`` is the cosine."""
    schema = pa.schema(
        [("doc_id", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64()), ("rejected", pa.bool_())]
    )

    def make():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            column = batch.column("text")
            texts = utf8(column)
            spoken = [bool(t and _LETTER.search(t)) for t in column.to_pylist()]
            names, scores, rejected = [], [], []
            for at in range(0, len(texts), ROWS):
                block = texts[at : at + ROWS]
                if model is None:
                    best, cosine = np.zeros(len(block), int), np.zeros(len(block))
                else:
                    best, cosine = model.nearest(block)
                for b, c, has in zip(best.tolist(), cosine.tolist(), spoken[at : at + ROWS], strict=True):
                    known = has and model is not None
                    names.append(model.languages[b] if known else UNKNOWN)
                    scores.append(c if known else 0.0)
                    rejected.append(not known or 1 - c > model.limits[b])
            return rows_to_batch(schema, [batch.column("doc_id"), names, scores, rejected])

        return step

    return by_batch(
        docs.select("doc_id", "text"), make, "doc_id long, lang_pred string, score double, rejected boolean"
    )


def languages(
    docs: DataFrame,
    rules: LanguageRules = DEFAULT_RULES,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
) -> DataFrame:
    """(doc_id, held_out, lang_pred, score, rejected): the text alone decides.

    One row per row. A null text, one without a letter, or nothing to learn from gives ``und`` with
    score 0. Rows with a null language are predicted, never learned. Repeated rows and null ids
    stay, other columns are not read, no rows give no rows.
    """
    rows = documents(docs, id_col, text_col, lang_col).withColumnRenamed(lang_col, "lang")
    return predicted(rows, fit(rows, rules)).select(
        "doc_id",
        (remainder("doc_id", rules.folds) == rules.held_out).alias("held_out"),
        "lang_pred",
        "score",
        "rejected",
    )
