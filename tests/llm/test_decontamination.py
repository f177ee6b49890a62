import random

import pytest
from pyspark.sql import functions as F

from barograph.llm import decontamination as dec
from tests.llm import brute


def equal_to_brute(docs, items, rules=dec.DEFAULT_RULES):
    found = dec.contaminated(docs, items, rules).collect()
    wanted = brute.leaks(
        [tuple(r) for r in docs.select("doc_id", "text").distinct().collect()],
        [tuple(r) for r in items.select("item_id", "text").collect()],
    )
    assert {(r["doc_id"], r["item_id"]) for r in found} == set(wanted)
    for r in found:
        best, windows, first = wanted[(r["doc_id"], r["item_id"])]
        assert r["similarity"] == pytest.approx(best) and (r["windows"], r["first_word"]) == (windows, first)
    return found


def test_given_tables(spark, docs, folder):
    assert equal_to_brute(docs, spark.read.parquet(f"{folder}/benchmark.parquet"))


def test_edited_shortened_and_short_items(spark):
    rng = random.Random(2)
    base = [f"w{i}" for i in range(60)]
    items = [(1, " ".join(base)), (2, "three small words"), (3, ""), (4, None), (None, "no id here at all"),
             (5, "x y z " * 12), (6, " ".join(base)), (7, "word")]
    texts = [" ".join(base), " ".join(base[:50]), " ".join(base[:30]), "and THREE small\twords here", "small words three"]
    for edits in range(6):
        text = list(base)
        for at in rng.sample(range(60), edits):
            text[at] = "changed"
        texts.append("before it " + " ".join(text) + " and after " + " ".join(base[10:20]))
    texts += ["x y z " * 40, "word", "", None, "x y " * 30]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)] + [(None, texts[0])], "doc_id long, text string")
    equal_to_brute(docs, spark.createDataFrame(items, "item_id long, text string"))


def test_shuffled_joins_give_the_same(spark, docs, folder):
    items = spark.read.parquet(f"{folder}/benchmark.parquet")
    rules = dec.WindowRules(broadcast_rows=0, broadcast_ids=0)
    a, b = (dec.contaminated(docs, items, r) for r in (dec.DEFAULT_RULES, rules))
    assert sorted(a.collect()) == sorted(b.collect())


def test_odd_rows(spark, odd, none):
    items = spark.createDataFrame([(1, PROSE_START), (2, "ein wort")], "item_id long, text string")
    found = {(r["doc_id"], r["item_id"]) for r in dec.contaminated(odd, items).collect()}
    assert found == {(1, 1), (2, 1), (3, 1), (9_000_000_000, 1), (9, 2), (10, 2)}
    assert dec.contaminated(none, items).count() == 0
    assert dec.contaminated(odd, items.where("false")).count() == 0


PROSE_START = "the quick brown fox jumps over the lazy dog while seven calm sailors watch the harbour lights"


def test_fingerprint_is_the_majority_of_bits(spark):
    rng = random.Random(1)
    rows = [[rng.randrange(-(2**63), 2**63) for _ in range(n)] for n in (1, 2, 3, 8, 33, 127)] + [[-1] * 127]
    frame = spark.createDataFrame(list(enumerate(rows)), "number int, h array<bigint>")
    for longest in (127, 128, 40_000):  # counters of 8, 16 and 32 bits
        for r in dec.fingerprints(frame, "number", "h", longest).collect():
            bag = rows[r["number"]]
            bits = [sum((x >> b) & 1 for x in bag) * 2 > len(bag) for b in range(64)]
            assert r["print"] % 2**64 == sum(1 << b for b in range(64) if bits[b])


def test_index_finds_everything_within_the_radius(spark):
    rng = random.Random(3)
    rules = dec.DEFAULT_RULES
    item = rng.randrange(-(2**63), 2**63)
    near = []
    for k in range(rules.radius + 1):
        flipped = item
        for b in rng.sample(range(64), k):
            flipped ^= 1 << b if b < 63 else -(1 << 63)
        near.append((k, flipped))
    index = dec.item_index(
        spark.createDataFrame([(1, 40, item)], "item_id long, n int, print long"), rules
    ).select("block", "value")
    looked = spark.createDataFrame(near, "k int, print long").crossJoin(spark.range(rules.blocks).withColumnRenamed("id", "block"))
    hits = looked.withColumn("value", dec.block_of(F.col("print"), F.col("block").cast("int"), rules)).join(index, ["block", "value"])
    assert hits.select("k").distinct().count() == rules.radius + 1


def test_plan_has_no_python(spark, docs, folder):
    found = dec.contaminated(docs, spark.read.parquet(f"{folder}/benchmark.parquet"))
    assert "Python" not in found._jdf.queryExecution().toString() and "Arrow" not in found._jdf.queryExecution().toString()


def test_near_copies_at_the_threshold_are_found(spark):
    """Passages with as many edits as the threshold allows: the radius may lose one in ten at most."""
    rng = random.Random(11)
    items, docs = [], []
    for i in range(60):
        words = [f"w{rng.randrange(4000)}" for _ in range(60)]
        items.append((i, " ".join(words)))
        copy = list(words)
        copy[rng.randrange(10, 50)] = "edit"  # 51 of 61 shingles shared
        filler = [f"f{rng.randrange(4000)}" for _ in range(40)]
        docs.append((i, " ".join([*filler, *copy, *filler])))
    found = dec.contaminated(
        spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    ).collect()
    wanted = brute.leaks(docs, items)
    assert len(wanted) == 60
    assert len({(r["doc_id"], r["item_id"]) for r in found} & set(wanted)) >= 54
    assert {(r["doc_id"], r["item_id"]) for r in found} <= set(wanted)
