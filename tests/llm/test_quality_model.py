import numpy as np
import pytest
from pyspark.sql import functions as F

from barograph.llm import quality_model as q


def test_held_out_accuracy(spark, larger):
    docs, labels = (spark.read.parquet(f"{larger}/{t}.parquet") for t in ("documents", "labels"))
    rows = q.quality(docs, labels).join(labels, "doc_id").where("held_out").toPandas()
    assert len(rows) > 50
    assert (rows["predicted"] == rows["quality"]).mean() >= 0.9
    ranks, good = rows["score"].rank(), rows["quality"] == 1
    auc = (ranks[good].sum() - good.sum() * (good.sum() + 1) / 2) / (good.sum() * (~good).sum())
    assert auc >= 0.95
    assert ((rows["score"] >= 0.3) == (rows["predicted"] == 1)).all()


def test_held_out_labels_have_no_part(spark, docs, folder):
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    held = (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5) == 0
    flipped = labels.withColumn("quality", F.when(held, 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = (q.quality(docs, x).orderBy("doc_id").toPandas() for x in (labels, flipped))
    assert np.allclose(a["score"], b["score"], atol=1e-9)
    moved = docs.withColumns({"doc_id": F.col("doc_id") + 0, "lang": F.lit("xx"), "source": F.lit(None).cast("string")})
    c = q.quality(moved, labels).orderBy("doc_id").toPandas()
    assert np.allclose(a["score"], c["score"], atol=1e-9)


def test_odd_rows(spark, odd, none):
    labels = spark.createDataFrame([(1, 1), (2, 1), (15, 0), (14, 0), (None, 1), (3, None), (15, 0)], "doc_id long, quality int")
    rows = q.quality(odd, labels).collect()
    assert len(rows) == odd.count() and all(0 <= r["score"] <= 1 for r in rows)
    assert sorted(str(r["doc_id"]) for r in rows) == sorted(str(r["doc_id"]) for r in odd.collect())
    assert q.quality(none, labels).count() == 0
    nobody = labels.where("false")
    assert {round(r["score"], 2) for r in q.quality(odd, nobody).collect()} == {0.5}
    assert {r["predicted"] for r in q.quality(odd, labels.where("quality = 0")).collect()} == {0}


def test_pools_rise():
    x, y = q.pooled(np.arange(6.0), np.array([0, 3, 1, 2, 2, 4.0]), np.array([4, 4, 4, 4, 4, 4.0]))
    assert y.tolist() == pytest.approx([0, 0.5, 1]) and (np.diff(x) > 0).all()


def test_features_approximate_the_kernel():
    rng = np.random.default_rng(1)
    k = len(q.NAMES)
    rules = q.QualityRules(features=20_000)
    width = rules.width * np.sqrt(k)
    model = q.QualityModel(
        np.zeros(k), np.ones(k), rng.normal(size=(k, rules.features)) / width,
        rng.uniform(0, 2 * np.pi, rules.features), np.zeros(rules.features + 1), np.zeros(1), np.zeros(1),
    )
    x = rng.normal(size=(5, k))
    z = model.features(x)[:, :-1]
    wanted = np.exp(-((x[:, None] - x[None]) ** 2).sum(-1) / (2 * width**2))
    assert np.abs(z @ z.T - wanted).max() < 0.05


def test_partition_sums_do_not_depend_on_partitions(spark):
    rng = np.random.default_rng(2)
    rows = [([float(v) for v in rng.normal(size=len(q.NAMES))], float(i % 2), 2) for i in range(60)]
    sample = spark.createDataFrame(rows, "stats array<double>, label double, fold int")
    k, rules = len(q.NAMES), q.QualityRules(features=16)
    model = q.QualityModel(
        np.zeros(k), np.ones(k), rng.normal(size=(k, 16)), rng.uniform(0, 6, 16), np.zeros(17), np.zeros(1), np.zeros(1)
    )
    one, many = q.solved(sample.coalesce(1), model, rules), q.solved(sample.repartition(7), model, rules)
    z = model.features(np.array([r[0] for r in rows]))
    y = np.array([r[1] for r in rows])
    penalty = np.eye(17) * rules.ridge * 60 / 17
    penalty[-1, -1] = 0
    wanted = np.linalg.solve(z.T @ z + penalty + 1e-9 * np.eye(17), z.T @ y)
    assert np.allclose(one, wanted) and np.allclose(many, wanted)


def test_statistics_equal_plain_counts(docs):
    import math
    import zlib
    from collections import Counter

    for row in docs.limit(40).collect():
        text = row["text"].encode()
        got = dict(zip(q.NAMES, q.statistics(text), strict=True))
        words, lines = text.split(), [x for x in text.split(b"\n") if x.strip()]
        tally, bytes_ = Counter(words), Counter(text)
        entropy = -sum(n / len(text) * math.log2(n / len(text)) for n in bytes_.values())
        plain = [
            math.log1p(len(text)), math.log1p(len(words)), sum(map(len, words)) / len(words),
            math.sqrt(sum((len(w) - sum(map(len, words)) / len(words)) ** 2 for w in words) / len(words)),
            sum(len(w) > 20 for w in words) / len(words), len(tally) / len(words), max(tally.values()) / len(words),
            sum(a == b for a, b in zip(words, words[1:], strict=False)) / len(words),
        ]
        assert list(got.values())[:8] == pytest.approx(plain)
        assert list(got.values())[18:] == pytest.approx(
            [
                1 - len(set(lines)) / len(lines), sum(n for b, n in bytes_.items() if b >= 128) / len(text), entropy,
                len(text) / len(zlib.compress(text, 1)), sum(w.isupper() for w in words) / len(words),
            ]
        )


def test_scores_equal_a_plain_fit(spark, docs, folder):
    """Ridge weights from all rows at once, a curve that rises by brute force, and the score of every text."""
    rules = q.QualityRules(features=12)
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    stats = q.document_statistics(docs)
    model = q.fit(stats, labels, rules)
    rows = q.labelled_sample(stats, labels, rules).collect()
    x = np.array([r["stats"] for r in rows])
    y, fold = np.array([r["label"] for r in rows], float), np.array([r["fold"] for r in rows])
    assert np.allclose(model.mean, x.mean(axis=0)) and np.allclose(model.scale, np.maximum(x.std(axis=0), 1e-6))

    def waves(some):
        z = np.clip((some - x.mean(axis=0)) / np.maximum(x.std(axis=0), 1e-6), -6, 6)
        return np.column_stack([np.cos(z @ model.waves + model.phases) * np.sqrt(2 / 12), np.ones(len(z))])

    seen = fold != rules.calibration
    z = waves(x[seen])
    penalty = np.eye(13) * rules.ridge * len(z) / 13
    penalty[-1, -1] = 0
    weights = np.linalg.solve(z.T @ z + penalty + 1e-9 * np.eye(13), z.T @ y[seen])
    assert np.allclose(model.weights, weights, atol=1e-6)
    raw = np.floor(np.clip(waves(x[~seen]) @ weights, -1, 2) / rules.bin)
    bins = sorted(set(raw))
    share = [y[~seen][raw == b].mean() for b in bins]
    size = [(raw == b).sum() for b in bins]
    level = [  # the largest of the least means of runs that hold a bin
        max(min(np.average(share[i : j + 1], weights=size[i : j + 1]) for j in range(k, len(bins))) for i in range(k + 1))
        for k in range(len(bins))
    ]
    assert sorted(set(np.round(model.curve_y, 9))) == sorted(set(np.round(level, 9)))
    scores = {r["doc_id"]: r["score"] for r in q.scored(stats, model, rules).collect()}
    for r in stats.collect():
        at = float((waves(np.array([r["stats"]])) @ weights)[0])
        wanted = 0.999 * np.interp(at, model.curve_x, model.curve_y) + 0.001 / (1 + np.exp(-4 * (at - 0.5)))
        assert scores[r["doc_id"]] == pytest.approx(wanted, abs=1e-5)
