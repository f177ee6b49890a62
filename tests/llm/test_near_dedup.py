import random

import numpy as np
import pytest

from barograph.llm import near_dedup as near
from barograph.llm.graph import components
from tests.llm import brute


def equal_to_brute(frame, rules=near.DEFAULT_RULES):
    rows = frame.select("doc_id", "text").collect()
    wanted = brute.components([(r["doc_id"], r["text"]) for r in rows])
    texts = {}
    for r in rows:
        texts.setdefault(r["doc_id"], []).append(r["text"])
    found = near.near_duplicates(frame, rules).collect()
    assert len(found) == len(rows)
    for r in found:
        if r["doc_id"] is not None and len(set(texts[r["doc_id"]])) == 1:
            size, component = wanted[texts[r["doc_id"]][0]]
            assert (r["n_shingles"], r["component_id"]) == (size, component if size else r["doc_id"])
            assert r["kept"] == (r["component_id"] == r["doc_id"])
    return found


def varied(rng, base, edits):
    out = list(base)
    for at in rng.sample(range(len(out)), edits):
        out[at] = f"new{rng.randrange(10**6)}"
    return " ".join(out)


def clusters(seed, sizes, length=80, edits=(0, 4)):
    rng = random.Random(seed)
    rows = []
    for size in sizes:
        base = [f"w{rng.randrange(5000)}" for _ in range(length)]
        rows += [varied(rng, base, rng.randint(*edits)) for _ in range(size)]
    rng.shuffle(rows)
    return [(i, text) for i, text in enumerate(rows)]


def test_given_documents(docs):
    equal_to_brute(docs)


def test_odd_rows(odd, none):
    found = equal_to_brute(odd)
    ids = [(r["doc_id"], r["component_id"], r["kept"]) for r in found]
    assert ids.count((3, 1, False)) == 2  # repeated rows, same words in other case
    assert (None, 7, False) in ids and (None, None, False) in ids
    assert near.near_duplicates(none).count() == 0


def test_no_links(spark):
    rows = spark.createDataFrame([(1, "a b c d e f"), (2, "g h i j k l"), (3, None)], "doc_id long, text string")
    assert all(r["kept"] for r in near.near_duplicates(rows).collect())


def test_clusters_of_all_sizes(spark):
    rows = clusters(1, [1] * 40 + [2] * 20 + [3, 5, 8, 13, 60])
    equal_to_brute(spark.createDataFrame(rows, "doc_id long, text string"))


def test_large_cluster_takes_deeper_regions(spark):
    rules = near.ForestRules(leaf=4, neighbours=1, blocks=3, all_at_once=10)
    rows = clusters(2, [150, 30, 2, 2, 1, 1], edits=(0, 2))
    equal_to_brute(spark.createDataFrame(rows, "doc_id long, text string").repartition(5), rules)


def test_copies_that_only_resemble_their_original(spark):
    rng = random.Random(4)
    base = [f"w{i}" for i in range(200)]
    # each copy changes its own stretch: similar to the original, not to each other
    rows = [(0, " ".join(base))]
    for k in range(40):
        copy = list(base)
        for at in rng.sample(range(0, 196, 7), 4):
            copy[at] = f"c{k}x{at}"
        rows.append((k + 1, " ".join(copy)))
    found = equal_to_brute(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {r["component_id"] for r in found} == {0}


def test_threshold_is_exact():
    a = np.arange(100, dtype=np.uint64)
    assert near.similar(a, np.arange(75, dtype=np.uint64), 75)
    assert not near.similar(a, np.arange(74, dtype=np.uint64), 75)
    assert not near.similar(a, a[:0], 75)


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(0)
    errors = []
    for _ in range(60):
        pool = rng.integers(0, 2**63, 400, dtype=np.uint64)
        left, right = near.signature(pool[:350], 128), near.signature(pool[50:], 128)
        errors.append((left == right).mean() - 0.75)
    assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.06


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_components_equal_brute_force(spark, seed):
    rng = random.Random(seed)
    links = [(rng.randrange(120), rng.randrange(120)) for _ in range(90)] + [(k, k + 1) for k in range(200, 260)]
    links += [(300, k) for k in range(301, 400)] + [(None, 1)]
    rng.shuffle(links)
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in links:
        if a is not None and a != b:
            low, high = sorted((root(a), root(b)))
            parent[high] = low
    found = components(spark.createDataFrame(links, "a long, b long"), "a", "b").collect()
    assert {r["node"]: r["component"] for r in found} == {x: root(x) for x in list(parent)}
    assert len(found) == len(parent)


def test_pairs_inside_a_template_family(spark):
    rng = random.Random(6)
    boilerplate = [f"b{i}" for i in range(200)]

    def member(name, own):
        return boilerplate + [f"{name}x{i}" for i in range(own)]

    # all share the boilerplate, which is no link; a few pairs share a little more, which is one
    texts = [member(f"m{k}", 36) for k in range(300)]
    for k in range(40):
        base = member(f"p{k}", 36)
        texts += [base[:-27] + [f"{k}y{side}z{i}" for i in range(27)] for side in range(2)]
    rng.shuffle(texts)
    rows = [(i, " ".join(text)) for i, text in enumerate(texts)]
    found = equal_to_brute(spark.createDataFrame(rows, "doc_id long, text string"), near.ForestRules(leaf=8, neighbours=1))
    assert sum(not r["kept"] for r in found) == 40


def test_rare_shingles_lose_no_pair(spark):
    rng = random.Random(7)
    pool = [f"w{i}" for i in range(60)]
    rows = []
    for k in range(120):
        words = pool[: rng.randint(40, 60)]
        rows.append((k, k, 1, varied(rng, words, rng.randint(0, 3))))
    texts = spark.createDataFrame(rows, "rep long, component long, weight long, text string")
    got = {frozenset((r["a"], r["b"])) for r in near.possible(texts, near.ForestRules(block=7)).collect()}
    sets = {r[0]: near.shingle_set(r[3].encode(), 5) for r in rows}
    wanted = {frozenset((a, b)) for a in sets for b in sets if a < b and near.similar(sets[a], sets[b], 75)}
    assert wanted and wanted <= got


def test_a_text_without_an_id_links_others(spark):
    rng = random.Random(9)
    base = [f"w{i}" for i in range(100)]
    left, right = list(base), list(base)
    for k in range(2):
        left[k * 10 + 3], right[k * 10 + 55] = f"l{k}", f"r{k}"  # each is near the middle, not near the other
    texts = [" ".join(x) for x in (left, base, right)]
    sets = [near.shingle_set(t.encode(), 5) for t in texts]
    assert near.similar(sets[0], sets[1], 75) and near.similar(sets[1], sets[2], 75) and not near.similar(sets[0], sets[2], 75)
    other = " ".join(f"o{rng.randrange(10**6)}" for _ in range(50))
    rows = [(5, texts[0]), (None, texts[1]), (9, texts[2]), (None, other), (None, other)]
    found = near.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r["doc_id"] or 0, r["component_id"] or 0, r["kept"]) for r in found) == [
        (0, 0, False), (0, 0, False), (0, 5, False), (5, 5, True), (9, 5, False),
    ]
