import math
from fractions import Fraction

import numpy as np
import pytest

from barograph.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, label int, x string, size string, n string, component string"


def frame(spark, rows, parts=3):
    return spark.createDataFrame([(i, v, 0, "x", "x", "x", "x") for i, v in rows], SCHEMA).repartition(parts)


def expected(rows, components=4):
    """{vec_id: rows} by plain arithmetic and the library's eigenvectors."""
    good = [(i, v) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    xs = [(i, [math.floor(256 * float(np.float32(c))) for c in v]) for i, v in good]
    fit = sorted({tuple(x) for _, x in xs})
    n, sums = len(fit), [sum(c) for c in zip(*fit, strict=True)]
    mean = np.array([float(Fraction(s, n)) for s in sums])
    y = np.array(fit, float) - mean
    values, vectors = np.linalg.eigh(y.T @ y / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    out = []
    for i, x in xs:
        deviation = sum((n * c - s) ** 2 for c, s in zip(x, sums, strict=True))
        w = (np.array(x) - mean) @ vectors[:, :components] / np.sqrt(values[:components])
        out.append((i, deviation, w, values[:components] / values.sum(), n))
    return out


def compared(spark, rows):
    got = {}
    for row in whitening.whitened(frame(spark, rows)).collect():
        got.setdefault((row["vec_id"], row["component"]), []).append(row)
        assert row["identity_error"] < 1e-10
    want = expected(rows)
    signs = {}
    for i, deviation, w, explained, n in want:
        for k in range(4):
            row = got[i, k + 1][0]
            assert (row["n"], row["deviation"]) == (n, deviation)
            assert row["explained"] == pytest.approx(explained[k], rel=1e-9)
            if abs(w[k]) > 1e-6:
                sign = signs.setdefault(k, math.copysign(1, w[k] * row["whitened"]))
                assert row["whitened"] * sign == pytest.approx(w[k], rel=1e-7, abs=1e-8)
    assert sum(map(len, got.values())) == 4 * len(want)


def test_equals_plain_arithmetic(spark):
    rng = np.random.default_rng(1)
    rows = [(i, (rng.normal(size=12) * np.arange(1, 13)).tolist()) for i in range(300)]
    hot = rows[0][1]
    rows += [(1000 + i, hot) for i in range(400)]  # one vector holds most rows
    rows += [(2000, None), (2001, [None] * 12), (2002, [float("nan")] * 12), (2003, [float("inf")] * 12), (2004, [])]
    rows += [(None, rows[5][1])]
    compared(spark, rows)


def test_given_embeddings(spark, folder):
    table = spark.read.parquet(f"{folder}/embeddings.parquet")
    compared(spark, [(r["vec_id"], r["embedding"]) for r in table.collect()])


def test_few_vectors(spark):
    assert whitening.whitened(frame(spark, [])).collect() == []
    assert whitening.whitened(frame(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).collect() == []
    rows = whitening.whitened(frame(spark, [(1, [1.0, 2.0]), (2, [3.0, 2.0]), (2, [3.0, 2.0]), (3, [1.0])])).collect()
    assert sorted((r["vec_id"], r["component"], r["n"], round(abs(r["whitened"]), 9)) for r in rows) == [
        (1, 1, 2, 1.0), (2, 1, 2, 1.0), (2, 1, 2, 1.0),
    ]  # one direction varies; the vector of another length is dropped
    assert {r["explained"] for r in rows} == {1.0}


def test_long_sums_stay_exact(spark):
    rows = [(1, [3.0e9, 1.0]), (2, [-3.0e9, 2.0]), (3, [1.0e30, 3.0])]
    found = whitening.whitened(frame(spark, rows), components=1).collect()
    assert {r["deviation"] for r in found} == {None}
    assert all(math.isfinite(r["whitened"]) for r in found)


@pytest.mark.parametrize(
    "values",
    [
        [5.0, 4.0, 3.0, 2.0, 1.0],
        [1e6, 1.0, 1e-6, 1e-9],
        [2.0, 2.0, 2.0, 1.0],  # equal values
        [1.0] * 6,
        [3.0, 0.0, 0.0, 0.0],
        [1.0 + 1e-9 * k for k in range(8)],  # a cluster
        [0.0] * 3,
    ],
)
def test_components_of_known_matrices(values):
    rng = np.random.default_rng(len(values))
    turn, _ = np.linalg.qr(rng.normal(size=(len(values),) * 2))
    a = turn @ np.diag(values) @ turn.T
    a = (a + a.T) / 2
    found, vectors = whitening.eigenvectors(a)
    scale = max(values) or 1.0
    assert np.allclose(found, sorted(values, reverse=True), atol=1e-13 * scale, rtol=0)
    assert np.allclose(vectors.T @ vectors, np.eye(len(values)), atol=1e-12)
    assert np.allclose(a @ vectors, vectors * found, atol=1e-12 * scale)


def test_diagonal_and_large_matrices():
    assert whitening.eigenvectors(np.diag([1.0, 3.0, 2.0]))[0].tolist() == [3.0, 2.0, 1.0]
    rng = np.random.default_rng(3)
    x = rng.normal(size=(400, 96))
    a = x.T @ x / 400
    values, vectors = whitening.eigenvectors(a)
    assert np.allclose(values, np.linalg.eigvalsh(a)[::-1], atol=1e-12)
    assert np.abs(a @ vectors - vectors * values).max() < 1e-12


def test_polar_factor():
    rng = np.random.default_rng(5)
    a = rng.normal(size=(20, 20))
    a = a + a.T
    u = whitening.polar(a)
    values, vectors = np.linalg.eigh(a)
    assert np.allclose(u, vectors @ np.diag(np.sign(values)) @ vectors.T, atol=1e-10)
