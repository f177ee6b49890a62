import math
from collections import Counter
from dataclasses import replace

import pytest

from barograph.llm import lm_scoring
from barograph.llm.lm_scoring import LanguageModelRules

RULES = LanguageModelRules(least_count=2, word_weight=20.0)


def brute(rows, targets, rules):
    texts = [(d, (t or "").encode().lower().split()) for d, t in rows]
    words, pairs, sizes = [Counter(), Counter()], [Counter(), Counter()], [0, 0]
    for d, ws in texts:
        for corpus in (0, 1) if d in targets else (1,):
            words[corpus].update(ws)
            words[corpus].update([None] * bool(ws))  # the start
            pairs[corpus].update(zip([None, *ws], ws))
            sizes[corpus] += len(ws)
    vocabulary = len([w for w in words[1] if w is not None])
    scale = sizes[0] / sizes[1] if all(sizes) else 1.0

    def count(table, corpus, key):
        if table[1][key] < rules.least_count:
            return 0
        return table[corpus][key] * (scale if corpus else 1.0)

    def loss(corpus, a, b):
        known = words[1][b] if words[1][b] >= rules.least_count else 0
        shared = (known + 1) / (sizes[1] + vocabulary + 1)
        size = sizes[corpus] * (scale if corpus else 1.0)
        share = (count(words, corpus, b) + rules.word_weight * shared) / (size + rules.word_weight)
        p = (count(pairs, corpus, (a, b)) + rules.pair_weight * share) / (count(words, corpus, a) + rules.pair_weight)
        return -math.log2(p)

    out = []
    for d, ws in texts:
        found = [(loss(0, a, b), loss(1, a, b)) for a, b in zip([None, *ws], ws)]
        n = len(found)
        out.append((d, n, *([sum(x[k] for x in found) / n for k in (0, 1)] if n else [None, None])))
    return out


def same(got, wanted):
    key = lambda r: (r[0] is None, r[0] or 0, r[1], r[2] or 0)
    for g, w in zip(sorted(map(tuple, got), key=key), sorted(wanted, key=key), strict=True):
        assert g[:2] == w[:2]
        if w[1]:
            assert g[2:] == pytest.approx((w[2], w[3], w[2] - w[3]), abs=1e-9)
        else:
            assert g[2:] == (None, None, None)


@pytest.mark.parametrize("broadcast", [10**6, 3])
def test_equals_brute_force(spark, odd, broadcast):
    rows = [r for r in odd.collect() if r["text"] is None or len(r["text"]) < 20_000]
    small = spark.createDataFrame(rows, odd.schema).repartition(3)
    targets = spark.createDataFrame([(1,), (2,), (2,), (None,), (15,)], "doc_id long")
    rules = replace(RULES, broadcast_rows=broadcast)
    got = lm_scoring.cross_entropy_difference(small, targets, rules).collect()
    same(got, brute([(r["doc_id"], r["text"]) for r in rows], {1, 2, 15}, rules))


@pytest.mark.parametrize("broadcast", [10**6, 3])
def test_given_documents(spark, docs, folder, broadcast):
    good = spark.read.parquet(f"{folder}/labels.parquet").where("quality = 1").select("doc_id")
    rules = LanguageModelRules(broadcast_rows=broadcast)
    got = lm_scoring.cross_entropy_difference(docs, good, rules).collect()
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    same(got, brute(rows, {r["doc_id"] for r in good.collect()}, rules))


def test_tables_grow_with_the_corpus(spark, larger):
    docs = spark.read.parquet(f"{larger}/documents.parquet").selectExpr("text", "false is_target")
    sizes = []
    for share in (4, 1):
        part = docs.where(f"pmod(xxhash64(text), {share}) = 0")
        sizes.append(lm_scoring.counted(part, RULES).where(f"background >= {RULES.least_count}").count())
    assert sizes[1] > 2 * sizes[0]


def test_no_targets_and_no_rows(spark, odd, none):
    nobody = spark.createDataFrame([], "doc_id long")
    for broadcast in (10**6, 0):
        rules = replace(RULES, broadcast_rows=broadcast)
        rows = lm_scoring.cross_entropy_difference(odd, nobody, rules).where("n_tokens > 0").collect()
        assert rows and all(r["target_loss"] > 0 for r in rows)
        assert lm_scoring.cross_entropy_difference(none, nobody, rules).count() == 0


def test_good_documents_score_lower(spark, larger):
    labels = spark.read.parquet(f"{larger}/labels.parquet")
    docs = spark.read.parquet(f"{larger}/documents.parquet")
    good = labels.where("quality = 1").select("doc_id")
    means = dict(
        lm_scoring.cross_entropy_difference(docs, good).join(labels, "doc_id").groupBy("quality").avg("score").collect()
    )
    assert means[1] < 0 < means[0]
