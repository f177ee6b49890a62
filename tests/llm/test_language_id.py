import numpy as np
from pyspark.sql import functions as F

from barograph.llm import language_id as lang


def test_held_out_accuracy(spark, larger):
    docs = spark.read.parquet(f"{larger}/documents.parquet")
    rows = lang.languages(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").toPandas()
    assert (rows["lang"] == rows["lang_pred"]).mean() >= 0.97
    assert rows["score"].between(0, 1).all()


def test_only_text_and_learnable_rows_matter(docs):
    held = (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4) == 2
    changed = docs.withColumns({"lang": F.when(held, F.lit("xx")).otherwise(F.col("lang")), "source": F.lit("y")})
    a, b = (lang.languages(x).orderBy("doc_id").toPandas() for x in (docs, changed))
    assert (a["lang_pred"] == b["lang_pred"]).all() and np.allclose(a["score"], b["score"], atol=1e-6)


def test_odd_rows(spark, odd, none):
    rows = lang.languages(odd).collect()
    assert len(rows) == odd.count()
    for r, text in ((r, t["text"]) for r in rows for t in odd.collect() if t["doc_id"] == r["doc_id"] is not None):
        if not text or not any(ch.isalpha() for ch in text):
            assert (r["lang_pred"], r["score"], r["rejected"]) == ("und", 0.0, True)
        else:
            assert r["lang_pred"] in {"en", "de"} and 0 <= r["score"] <= 1
    assert lang.languages(none).count() == 0
    unlabelled = odd.withColumn("lang", F.lit(None).cast("string"))
    assert {r["lang_pred"] for r in lang.languages(unlabelled).collect()} == {"und"}


def test_document_frequencies_equal_brute_force(docs):
    rules = lang.LanguageRules(buckets=64)
    texts = [r["text"].encode() for r in docs.collect()]
    wanted = (lang.term_counts(texts, 64) > 0).sum(axis=0)
    found = lang.document_frequencies(docs.repartition(5), rules)
    assert found[:-1].tolist() == wanted.tolist() and found[-1] == len(texts)


def test_foreign_text_is_rejected(spark, larger):
    docs = spark.read.parquet(f"{larger}/documents.parquet").select("doc_id", "text", "lang")
    model = lang.fit(docs)
    foreign = spark.createDataFrame([(1, "Зелёный дом стоит у реки и ждёт гостей " * 5)], "doc_id long, text string")
    assert lang.predicted(foreign, model).first()["rejected"]
    assert lang.predicted(docs, model).where("rejected").count() <= 0.02 * docs.count()


def test_clusters_separate():
    rng = np.random.default_rng(0)
    rows = lang.unit(np.abs(np.repeat(np.eye(4, 32) * 5, 20, axis=0) + rng.normal(size=(80, 32)) * 0.1))
    centroids, limits = lang.clustered(rows.astype(np.float32), lang.DEFAULT_RULES)
    assert sorted((rows @ centroids.T).argmax(axis=1).reshape(4, 20).std(axis=1)) == [0, 0, 0, 0]
    assert (limits > 0).all()


def test_predictions_equal_plain_cosines(docs):
    """Counts, weights, norms and cosines of every text written out, one n-gram at a time."""
    import math
    import re
    from collections import Counter

    rules = lang.LanguageRules(buckets=256, rows_per_language=30, centroids=2)
    model = lang.fit(docs.select("doc_id", "text", "lang"), rules)
    found = {r["doc_id"]: r for r in lang.predicted(docs, model).collect()}

    def cell(gram):
        code = int.from_bytes(gram, "big") + (len(gram) << 24)
        return (code * 0x9E3779B97F4A7C15 % 2**64) >> 56

    for row in docs.limit(60).collect():
        data = (" " + row["text"] + " ").encode()
        data = re.sub(rb"[A-Z]", lambda m: m[0].lower(), data)
        data = re.sub(rb"[\x00-\x60\x7b-\x7f]+", b" ", data)
        counts = Counter(cell(data[i : i + n]) for n in (1, 2, 3) for i in range(len(data) - n + 1))
        vector = {k: math.log1p(n) * float(model.weights[k]) for k, n in counts.items()}
        norm = math.sqrt(sum(v * v for v in vector.values()))
        cosines = [sum(v / norm * float(centroid[k]) for k, v in vector.items()) for centroid in model.centroids]
        r = found[row["doc_id"]]
        assert abs(r["score"] - max(0.0, min(1.0, max(cosines)))) < 1e-4
        near = [model.languages[i] for i, x in enumerate(cosines) if x > max(cosines) - 1e-5]
        assert r["lang_pred"] in near
