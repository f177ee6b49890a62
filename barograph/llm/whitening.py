"""Whitening of embeddings with principal components by spectral divide and conquer.

Sums and the covariance of the distinct integer vectors are added up by partitions. On the driver, a
matrix of the embedding's dimension is split: the polar factor U of (V - shift) has the eigenvalues
-1 and 1 below and above the shift, so (U + I) / 2 projects on the upper invariant subspace. Both
subspaces are split again until each is one component. Polar factors come from the QR form of the
dynamically weighted Halley iteration. The whitening matrix is sent to every task.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barograph.llm.common import pieces, stored
from barograph.session import ship_package

EPS = float(np.finfo(float).eps)
LARGEST = 2**63 - 1


def polar(a: np.ndarray) -> np.ndarray:
    """The orthogonal polar factor of a symmetric matrix that is not singular."""
    n = len(a)
    x = a / np.linalg.norm(a)
    try:
        low = 1 / np.linalg.norm(np.linalg.inv(x))  # not above the least singular value
    except np.linalg.LinAlgError:
        low = EPS
    low = min(1.0, max(low, EPS))
    for _ in range(12):
        square = low * low
        d = np.cbrt(4 * (1 - square) / (square * square))
        root = np.sqrt(1 + d)
        p = root + np.sqrt(max(0.0, 8 - 4 * d + 8 * (2 - square) / (square * root))) / 2
        q = (p - 1) ** 2 / 4
        r = p + q - 1
        both, _ = np.linalg.qr(np.vstack([np.sqrt(r) * x, np.eye(n)]))
        new = q / r * x + (p - q / r) / np.sqrt(r) * both[:n] @ both[n:].T
        new = (new + new.T) / 2
        low = min(1.0, low * (p + q * square) / (1 + r * square))
        moved = np.linalg.norm(new - x)
        x = new
        if abs(1 - low) < 10 * EPS and moved < EPS ** (1 / 3):
            break
    return x


def _shifts(a: np.ndarray) -> Iterator[float]:
    """Values to split the spectrum at: the median and mean of the diagonal, then its gaps, widest first."""
    entries = np.sort(np.diag(a))
    yield float(np.median(entries))
    yield float(entries.mean())
    gaps = np.diff(entries)
    for k in np.argsort(-gaps, kind="stable"):
        yield float(entries[k] + gaps[k] / 2)


def _split(a: np.ndarray, shift: float, size: float) -> tuple[np.ndarray, int] | None:
    """(basis, rank): columns of the upper subspace, then of the lower one; None if this shift fails."""
    n = len(a)
    moved = a - shift * np.eye(n)
    if not np.linalg.norm(moved):
        return None
    upper = (polar(moved) + np.eye(n)) / 2
    if not np.isfinite(upper).all():
        return None
    rank = round(float(np.trace(upper)))
    if not 0 < rank < n:
        return None
    draw = np.random.default_rng(n).normal(size=(n, n))
    start, _ = np.linalg.qr(upper @ draw[:, :rank])
    start, _ = np.linalg.qr(upper @ start)
    rest = draw[:, rank:] - upper @ draw[:, rank:]
    rest -= upper @ rest
    basis, _ = np.linalg.qr(np.hstack([start, rest]))
    between = basis[:, :rank].T @ a @ basis[:, rank:]
    return (basis, rank) if np.linalg.norm(between) <= 50 * n * EPS * size else None


def eigenvectors(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(values, vectors) of a symmetric matrix, values falling, vectors as columns."""
    size = float(np.linalg.norm(a))
    columns: list[np.ndarray] = []
    work = [(a, np.eye(len(a)))]
    while work:
        part, basis = work.pop()
        n = len(part)
        beside = part - np.diag(np.diag(part))
        if n == 1 or np.linalg.norm(beside) <= EPS * size:
            columns.append(basis)
            continue
        found = next(filter(None, (_split(part, shift, size) for shift in _shifts(part))), None)
        if found is None:  # equal values to working precision: any basis serves
            columns.append(basis)
            continue
        turn, rank = found
        turned = turn.T @ part @ turn
        for rows in (slice(0, rank), slice(rank, n)):
            block = turned[rows, rows]
            work.append(((block + block.T) / 2, basis @ turn[:, rows]))
    vectors = np.hstack(columns) if columns else np.zeros((0, 0))
    vectors /= np.linalg.norm(vectors, axis=0)
    values = np.einsum("ij,ij->j", vectors, a @ vectors)
    order = np.argsort(-values, kind="stable")
    return values[order], vectors[:, order]


@dataclass(frozen=True)
class Whitening:
    """What the fit list gives: its size, sums and means, and the projection that whitens."""

    n: int
    sums: tuple[int, ...]
    mean: np.ndarray
    projection: np.ndarray  # a column per component: unit vector over the root of its value
    explained: np.ndarray

    def centred(self, x: np.ndarray) -> np.ndarray:
        return x - self.mean

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ self.projection

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sum over the dimensions of (n x - S)^2; None where it does not fit a long."""
        most = float(self.n) * float(np.abs(x).max(initial=0)) + max(map(abs, self.sums), default=0)
        if most * most * max(1, x.shape[1]) < LARGEST / 2:
            y = self.n * x - np.array(self.sums, np.int64)
            return np.einsum("ij,ij->i", y, y).tolist()
        exact = [sum((self.n * c - s) ** 2 for c, s in zip(row, self.sums, strict=True)) for row in x.tolist()]
        return [value if value <= LARGEST else None for value in exact]


def _matrices(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for batch in pieces(batches):
        if batch.num_rows:
            flat = batch.column("x").flatten().to_numpy(zero_copy_only=False)
            yield batch, flat.reshape(batch.num_rows, size)


def vectors(rows: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """(vec_id, x) of the rows whose vector is there and has only finite entries."""
    entries = rows.select(
        F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v")
    )
    bad = F.exists("v", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    whole = F.transform("v", lambda c: F.floor(c * F.lit(float(scale))).cast("long"))
    return entries.where(F.col("v").isNotNull() & ~bad).select("vec_id", whole.alias("x"))


def added_rows(part: Callable[[Iterator[pa.RecordBatch]], np.ndarray], df: DataFrame) -> np.ndarray | None:
    """The sum over all partitions of a matrix that ``part`` makes of each, or None without rows.

    Matrix rows meet in Spark by number, so no task and no message holds more than one matrix."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = part(batches)
        if total is not None:
            yield pa.record_batch({"i": np.arange(len(total)), "part": list(total)})

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for i, row in zip(batch.column("i").to_pylist(), batch.column("part"), strict=True):
                row = row.values.to_numpy()
                sums[i] = sums[i] + row if i in sums else row.copy()
        if sums:
            yield pa.record_batch({"i": np.array(list(sums)), "part": list(sums.values())})

    schema = "i long, part array<double>"
    rows = df.mapInArrow(emit, schema).repartition("i").mapInArrow(add, schema).collect()
    if not rows:
        return None
    return np.array([row["part"] for row in sorted(rows, key=lambda row: row["i"])])


def fitted(fit: DataFrame, size: int, components: int) -> Whitening:
    """Sums, covariance and leading components of the vectors ``x`` of one size."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = 0, [0] * size
        for _, x in _matrices(batches, size):
            n += len(x)
            if float(np.abs(x).max()) * len(x) < LARGEST / 2:
                new = x.sum(axis=0).tolist()
            else:
                new = [sum(column) for column in zip(*x.tolist(), strict=True)]
            sums = [a + b for a, b in zip(sums, new, strict=True)]
        if n:
            # a sum is sent in two halves, so that it can exceed a long
            high, low = zip(*(divmod(s, 1 << 32) for s in sums), strict=True)
            yield pa.record_batch({"i": range(size), "n": [n] * size, "high": high, "low": low})

    sums = (
        fit.mapInArrow(partial, "i long, n long, high long, low long")
        .groupBy("i")
        .agg(F.sum("n").alias("n"), F.sum("high").alias("high"), F.sum("low").alias("low"))
        .orderBy("i")
        .collect()
    )
    n = sums[0]["n"]
    exact = tuple((row["high"] << 32) + row["low"] for row in sums)
    mean = np.array([float(Fraction(s, n)) for s in exact])

    def products(batches: Iterator[pa.RecordBatch]) -> np.ndarray | None:
        total = None
        for _, x in _matrices(batches, size):
            y = x - mean
            total = y.T @ y if total is None else total + y.T @ y
        return total

    covariance = added_rows(products, fit) / n
    covariance = (covariance + covariance.T) / 2
    values, columns = eigenvectors(covariance)
    # values that rounding alone can make carry no component
    keep = values > 4 * size * EPS * max(values.max(), 0.0)
    values, columns = values[keep][:components], columns[:, keep][:, :components]
    trace = float(np.trace(covariance))
    return Whitening(n, exact, mean, columns / np.sqrt(values), values / trace if trace else values)


def identity_error(fit: DataFrame, size: int, model: Whitening) -> float:
    """Largest absolute entry of the covariance of the whitened fit list minus the identity."""
    k = len(model.explained)
    if not k:
        return 0.0

    def moments(batches: Iterator[pa.RecordBatch]) -> np.ndarray | None:
        total = None
        for _, x in _matrices(batches, size):
            w = np.column_stack([model.whitened(x), np.ones(len(x))])
            total = w.T @ w if total is None else total + w.T @ w
        return total

    sums = added_rows(moments, fit) / model.n
    covariance = sums[:k, :k] - np.outer(sums[k, :k], sums[k, :k])
    return float(np.abs(covariance - np.eye(k)).max())


RESULT = (
    "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
)


def whitened(
    rows: DataFrame,
    components: int = 4,
    scale: int = 256,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error), a row per remaining row
    and component.

    Rows without a vector, or with null or non-finite entries, are dropped; so are vectors of another
    length than most distinct vectors have (of two such lengths, the greater counts). An entry counts
    as floor(scale * entry). Repeated rows and null ids keep rows of their own, while each distinct
    vector is fitted once, however often it occurs. Components whose variance is zero to working
    precision are left out, so a single distinct vector gives no rows, as does an empty table. A
    deviation beyond a long is null. Other columns are not read. The driver holds a few square
    matrices of the vectors' length.
    """
    ship_package(rows.sparkSession)
    found = vectors(rows, id_col, vector_col, scale)
    distinct = stored(found.select("x", F.size("x").alias("size")).distinct(), "whitening-fit")
    sizes = distinct.groupBy("size").count().orderBy(F.desc("count"), F.desc("size")).limit(1).collect()
    size = sizes[0]["size"] if sizes else 0
    if not size:
        return rows.sparkSession.createDataFrame([], RESULT)
    fit = distinct.where(F.col("size") == size).select("x")
    model = fitted(fit, size, components)
    error = identity_error(fit, size, model)
    k = len(model.explained)
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch, x in _matrices(batches, size):
            take = np.repeat(np.arange(len(x)), k)
            yield pa.record_batch(
                {
                    "vec_id": batch.column("vec_id").take(pa.array(take)),
                    "component": pa.array(np.tile(np.arange(1, k + 1), len(x)), pa.int32()),
                    "n": np.full(len(x) * k, model.n),
                    "deviation": pa.array(model.deviations(x), pa.int64()).take(pa.array(take)),
                    "whitened": model.whitened(x).ravel(),
                    "explained": np.tile(model.explained, len(x)),
                    "identity_error": np.full(len(x) * k, error),
                }
            )

    return found.where(F.size("x") == size).mapInArrow(project, RESULT)
