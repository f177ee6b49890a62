"""Quality classifier: random Fourier features over document statistics, ridge, isotonic.

1. Every whole text becomes a vector of statistics (lengths, shares of character classes, repeats).
2. ``cos(W x + b)`` with Gaussian W approximates a Gaussian kernel between such vectors.
3. Each partition of labelled rows adds up its part of the normal equations; Spark sums the parts,
   and one small system gives the ridge weights.
4. Labelled rows that were kept back give the calibration: positives per score bin, pooled to a
   rising curve (pool adjacent violators).
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barograph.llm.common import SPACES, by_batch, remainder, rows_to_batch, stored, utf8


@dataclass(frozen=True)
class QualityRules:
    #: Labelled rows used for fitting and calibration together, at most (chosen by a hash).
    labelled_rows: int = 100_000
    features: int = 256
    #: Width of the kernel in standard deviations of a statistic, times the root of their number.
    width: float = 0.7
    ridge: float = 1e-3
    seed: int = 20240501
    #: Raw scores are pooled in bins of this size before calibration.
    bin: float = 0.002
    #: Folds of the labels by remainder: never used, used for calibration.
    folds: int = 5
    held_out: int = 0
    calibration: int = 1
    threshold: float = 0.3


DEFAULT_RULES = QualityRules()

# ---------------------------------------------------------------- statistics

NAMES = (
    "log_bytes", "log_words", "word_length", "word_length_spread", "long_words", "distinct_words",
    "top_word", "same_as_before", "upper", "digits", "symbols", "exclamations", "stops", "commas",
    "other_marks", "spaces", "line_breaks", "log_line", "repeated_lines", "non_ascii",
    "byte_entropy", "compression", "capital_words",
)


def _class(chars: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(chars)] = True
    return out


_UPPER = _class(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ")
_DIGIT = _class(b"0123456789")
_SYMBOL = _class(b"#*$%&|<>{}[]\\^~@=_+/")
_MARK = _class(b";:'\"()-?`")
_SPACE = _class(SPACES)
_HIGH = np.arange(256) >= 128


def statistics(text: bytes) -> list[float]:
    """The statistics of a whole text; an empty text has zeros."""
    if not text:
        return [0.0] * len(NAMES)
    n = len(text)
    share = np.bincount(np.frombuffer(text, np.uint8), minlength=256) / n
    words = text.split()
    n_words = max(1, len(words))
    lengths = np.fromiter(map(len, words), np.float64, len(words)) if words else np.zeros(1)
    tally: dict[bytes, int] = {}
    for word in words:
        tally[word] = tally.get(word, 0) + 1
    lines = [line for line in text.split(b"\n") if line.strip()]
    same = sum(map(bytes.__eq__, words[1:], words[:-1]))
    seen = share[share > 0]
    return [
        float(np.log1p(n)),
        float(np.log1p(len(words))),
        float(lengths.mean()),
        float(lengths.std()),
        float((lengths > 20).mean()),
        len(tally) / n_words,
        max(tally.values(), default=0) / n_words,
        same / n_words,
        float(share[_UPPER].sum()),
        float(share[_DIGIT].sum()),
        float(share[_SYMBOL].sum()),
        float(share[ord("!")]),
        float(share[ord(".")]),
        float(share[ord(",")]),
        float(share[_MARK].sum()),
        float(share[_SPACE].sum()),
        float(share[ord("\n")]),
        float(np.log1p(n / max(1, len(lines)))),
        1 - len(set(lines)) / max(1, len(lines)),
        float(share[_HIGH].sum()),
        float(-(seen * np.log2(seen)).sum()),
        n / len(zlib.compress(text, 1)),
        sum(map(bytes.isupper, words)) / n_words,
    ]


def document_statistics(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", key_col: str | None = None
) -> DataFrame:
    """(doc_id, key, stats) of every whole text; ``key`` is a number of the caller's, or null."""
    key = F.lit(None) if key_col is None else F.col(key_col)
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        key.cast("long").alias("key"),
        F.col(text_col).cast("string").alias("text"),
    )
    schema = pa.schema([("doc_id", pa.int64()), ("key", pa.int64()), ("stats", pa.list_(pa.float64()))])

    def make():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            stats = [statistics(text or b"") for text in utf8(batch.column("text"))]
            return rows_to_batch(schema, [batch.column("doc_id"), batch.column("key"), stats])

        return step

    return by_batch(rows, make, "doc_id long, key long, stats array<double>")


# ---------------------------------------------------------------- model


@dataclass(frozen=True)
class QualityModel:
    """Everything that scoring needs; its size depends on the rules only."""

    mean: np.ndarray
    scale: np.ndarray
    waves: np.ndarray
    phases: np.ndarray
    weights: np.ndarray
    curve_x: np.ndarray
    curve_y: np.ndarray

    def features(self, stats: np.ndarray) -> np.ndarray:
        x = np.clip((stats - self.mean) / self.scale, -6, 6)
        waves = np.cos(x @ self.waves + self.phases) * np.sqrt(2 / len(self.phases))
        return np.concatenate([waves, np.ones((len(x), 1))], axis=1)

    def raw(self, stats: np.ndarray) -> np.ndarray:
        return self.features(stats) @ self.weights

    def score(self, stats: np.ndarray) -> np.ndarray:
        """Calibrated scores. On the flat parts of the curve a small share of the raw score keeps
        the order."""
        raw = self.raw(stats)
        curve = np.interp(raw, self.curve_x, self.curve_y)
        return 0.999 * curve + 0.001 / (1 + np.exp(-4 * (raw - 0.5)))


def pooled(x: np.ndarray, positives: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators: rising positive shares at the mean x of each pool."""
    pools: list[list[float]] = []
    for at, good, n in zip(x, positives, rows, strict=True):
        pools.append([at * n, float(good), float(n)])
        while len(pools) > 1 and pools[-2][1] * pools[-1][2] >= pools[-1][1] * pools[-2][2]:
            last = pools.pop()
            pools[-1] = [a + b for a, b in zip(pools[-1], last, strict=True)]
    parts = np.array(pools)
    return parts[:, 0] / parts[:, 2], parts[:, 1] / parts[:, 2]


def constant_model(share: float) -> QualityModel:
    k = len(NAMES)
    return QualityModel(
        np.zeros(k), np.ones(k), np.zeros((k, 1)), np.zeros(1), np.zeros(2), np.zeros(1), np.array([share])
    )


def labelled_sample(stats: DataFrame, labels: DataFrame, rules: QualityRules) -> DataFrame:
    """(stats, label, fold) of labelled documents outside the held-out fold. Of several labels of
    one document the largest counts; null labels and ids have no part. Beyond ``labelled_rows`` a
    hash of the id chooses, so the choice does not depend on the order of rows."""
    marks = (
        labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull())
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.max("quality").cast("double").alias("label"))
        .withColumn("fold", remainder("doc_id", rules.folds))
        .where(F.col("fold") != rules.held_out)
    )
    share = min(1.0, rules.labelled_rows / max(1, marks.count()))
    if share < 1:
        marks = marks.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < int(share * (1 << 20)))
    return stored(stats.join(marks, "doc_id").select("stats", "label", "fold"), "quality-sample")


def fit(stats: DataFrame, labels: DataFrame, rules: QualityRules = DEFAULT_RULES) -> QualityModel:
    """The model. Without labelled rows every score is one half; with one kind of label, its share."""
    sample = labelled_sample(stats, labels, rules)
    k = len(NAMES)
    moments = sample.agg(
        F.count(F.lit(1)),
        F.avg("label"),
        *[f(F.col("stats")[i]) for i in range(k) for f in (F.avg, F.stddev_pop)],
    ).first()
    rows, share = moments[0], moments[1]
    if not rows or share in (0.0, 1.0):
        return constant_model(0.5 if not rows else share)
    mean = np.array(moments[2::2], float)
    scale = np.maximum(np.array(moments[3::2], float), 1e-6)
    rng = np.random.default_rng(rules.seed)
    waves = rng.normal(size=(k, rules.features)) / (rules.width * np.sqrt(k))
    phases = rng.uniform(0, 2 * np.pi, rules.features)
    model = QualityModel(mean, scale, waves, phases, np.zeros(rules.features + 1), np.zeros(1), np.zeros(1))

    calibration = F.col("fold") == rules.calibration
    if not sample.where(calibration).limit(1).count() or not sample.where(~calibration).limit(1).count():
        calibration = F.lit(True)  # too few rows to keep some back
        fitting = sample
    else:
        fitting = sample.where(~calibration)
    weights = solved(fitting, model, rules)
    model = QualityModel(mean, scale, waves, phases, weights, np.zeros(1), np.zeros(1))

    def raw(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            score = model.raw(np.stack(frame["stats"].to_numpy()))
            yield pd.DataFrame({"bin": np.floor(np.clip(score, -1, 2) / rules.bin), "label": frame["label"]})

    bins = (
        sample.where(calibration)
        .mapInPandas(raw, "bin double, label double")
        .groupBy("bin")
        .agg(F.sum("label").alias("good"), F.count(F.lit(1)).alias("n"))
        .toPandas()
        .sort_values("bin")
    )
    x, y = pooled((bins["bin"].to_numpy() + 0.5) * rules.bin, bins["good"].to_numpy(), bins["n"].to_numpy())
    return QualityModel(mean, scale, waves, phases, weights, x, y)


def solved(sample: DataFrame, model: QualityModel, rules: QualityRules) -> np.ndarray:
    """Ridge weights from normal equations that partitions sum up and Spark adds."""
    size = rules.features + 1

    def part(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((size, size + 1))
        for frame in frames:
            z = model.features(np.stack(frame["stats"].to_numpy()))
            total += z.T @ np.column_stack([z, frame["label"].to_numpy()])
        i, j = np.indices(total.shape)
        yield pd.DataFrame({"i": i.ravel(), "j": j.ravel(), "part": total.ravel()})

    sums = (
        sample.mapInPandas(part, "i int, j int, part double")
        .groupBy("i", "j")
        .agg(F.sum("part").alias("total"))
        .toPandas()
    )
    matrix = np.zeros((size, size + 1))
    matrix[sums["i"], sums["j"]] = sums["total"]
    rows = matrix[-1, -2]  # the constant feature with itself
    penalty = np.eye(size) * rules.ridge * rows / size
    penalty[-1, -1] = 0
    return np.linalg.solve(matrix[:, :-1] + penalty + 1e-9 * np.eye(size), matrix[:, -1])


def scored(stats: DataFrame, model: QualityModel, rules: QualityRules = DEFAULT_RULES) -> DataFrame:
    """(doc_id, key, score, predicted) for every row of ``stats``."""
    schema = pa.schema(
        [("doc_id", pa.int64()), ("key", pa.int64()), ("score", pa.float64()), ("predicted", pa.int32())]
    )

    def make():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            flat = batch.column("stats").flatten().to_numpy(zero_copy_only=False)
            score = model.score(flat.reshape(batch.num_rows, len(NAMES)))
            good = (score >= rules.threshold).astype(np.int32)
            return rows_to_batch(schema, [batch.column("doc_id"), batch.column("key"), score, good])

        return step

    return by_batch(stats, make, "doc_id long, key long, score double, predicted int")


def quality(
    docs: DataFrame,
    labels: DataFrame,
    rules: QualityRules = DEFAULT_RULES,
    id_col: str = "doc_id",
    text_col: str = "text",
    key_col: str | None = None,
) -> DataFrame:
    """(doc_id, held_out, score, predicted, key): the text alone decides the score.

    One row per row: a null text counts as empty, repeated rows and null ids stay, other columns
    are not read, no rows give no rows.
    """
    stats = stored(document_statistics(docs, id_col, text_col, key_col), "quality-statistics")
    model = fit(stats, labels, rules)
    return scored(stats, model, rules).select(
        "doc_id",
        (remainder("doc_id", rules.folds) == rules.held_out).alias("held_out"),
        "score",
        "predicted",
        "key",
    )
