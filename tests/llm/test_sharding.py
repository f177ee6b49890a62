import zlib
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from barograph.llm import sharding


def law_holds(rows, shards=40):
    counts = Counter(r["shard"] for r in rows)
    sizes = [counts.get(s, 0) for s in range(shards)]
    assert max(sizes) - min(sizes) <= 1 and set(counts) <= set(range(shards))
    slots = defaultdict(list)
    for r in rows:
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert {r["law"] for r in rows} <= {"rows"} and all(r["grown_shard"] is None for r in rows)


def test_odd_rows(odd, none):
    rows = sharding.sharded(odd).collect()
    law_holds(rows)
    wanted = Counter()
    for r in odd.select("doc_id", "text").collect():
        data = (r["text"] or "").encode()
        wanted[(r["doc_id"], len(data) + 16, zlib.crc32(data))] += 1
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in rows) == wanted
    assert sharding.sharded(none).count() == 0


def test_small_groups_stay_together(docs):
    rows = sharding.sharded(docs, sharding.ShardRules(shards=7)).collect()
    law_holds(rows, 7)
    where = {r["doc_id"]: r["shard"] for r in rows}
    groups = defaultdict(set)
    for r in docs.collect():
        groups[r["text"]].add(where[r["doc_id"]])
    assert all(len(shards) == 1 for shards in groups.values())


def test_a_group_with_a_third_of_all_rows_takes_few_shards(spark):
    rows = spark.range(3000).select(
        F.col("id").alias("doc_id"),
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, F.concat(F.lit("p"), F.col("id") % 500))
        .otherwise(F.concat(F.lit("single"), "id")).alias("text"),
    )
    out = sharding.sharded(rows, sharding.ShardRules(shards=10, bucket_rows=50)).join(rows, "doc_id").collect()
    law_holds(out, 10)
    spread = defaultdict(set)
    for r in out:
        spread[r["text"]].add(r["shard"])
    assert len(spread["hot"]) <= 5
    assert sum(len(s) - 1 for t, s in spread.items() if t.startswith("p")) <= 50


def test_documents_with_several_hubs(spark):
    links = spark.createDataFrame(
        [(n, h, 4) for h, members in {100: range(4), 200: range(4, 8)}.items() for n in members] + [(3, 300, 2), (4, 300, 2)],
        "node long, hub long, k int",
    ).withColumn("k", F.col("k").cast("long"))
    start = spark.createDataFrame([(n, n % 2) for n in range(8)], "node long, shard int")
    labels = {r["node"]: r["shard"] for r in sharding.propagated(links, start, [6, 6], sharding.ShardRules(2)).collect()}
    assert len({labels[n] for n in range(4)}) == 1 or len({labels[n] for n in range(4, 8)}) == 1
    assert max(Counter(labels.values()).values()) <= 6


def test_propagation_decides_where_groups_go(spark, monkeypatch):
    rows = spark.range(400).select(F.col("id").alias("doc_id"), F.concat(F.lit("g"), F.floor(F.col("id") / 2) % 150).alias("text"))
    rules = sharding.ShardRules(shards=5)
    rounds, kept = [], sharding.propagated

    def watched(links, start, quotas, rules):
        before = {r["node"]: r["shard"] for r in start.collect()}
        labels = kept(links, start, quotas, rules)
        rounds.append((before, {r["node"]: r["shard"] for r in labels.collect()}, links.collect()))
        return labels

    monkeypatch.setattr(sharding, "propagated", watched)
    found = {r["doc_id"]: r["shard"] for r in sharding.sharded(rows, rules).collect()}
    monkeypatch.setattr(sharding, "propagated", lambda links, start, quotas, rules: start)
    without = {r["doc_id"]: r["shard"] for r in sharding.sharded(rows, rules).collect()}
    assert found != without
    (before, after, links), = rounds
    spread = [defaultdict(set), defaultdict(set)]
    for r in links:
        for where, labels in zip(spread, (before, after), strict=True):
            where[r["hub"]].add(labels[r["node"]])
    apart = [sum(len(s) > 1 for s in where.values()) for where in spread]
    assert apart[1] < apart[0]
    assert max(Counter(after.values()).values()) <= 80


def test_numbers_are_gapless(spark):
    rows = spark.range(500).withColumn("g", F.col("id") % 3)
    out = sharding.numbered(rows, ["g"], F.pmod(F.xxhash64("id"), F.lit(7)), ["id"], "number").collect()
    for g in range(3):
        assert sorted(r["number"] for r in out if r["g"] == g) == list(range(sum(r["g"] == g for r in out)))


def cuts(rows):
    """(groups in several shards, shards too many) of rows (text, shard)."""
    where = defaultdict(set)
    for text, shard in rows:
        where[text].add(shard)
    return sum(len(s) > 1 for s in where.values()), sum(len(s) - 1 for s in where.values())


def test_full_shards_exchange_whole_groups(spark):
    # 300 groups of 20 in 40 shards of 150: seven and a half groups each, so 280 can stay whole
    rows = spark.range(6000).select(F.col("id").alias("doc_id"), F.concat(F.lit("g"), F.col("id") % 300).alias("text"))
    out = sharding.sharded(rows).join(rows, "doc_id").collect()
    law_holds(out)
    groups, extra = cuts((r["text"], r["shard"]) for r in out)
    assert groups <= 20 and extra <= 25


def test_the_way_a_table_is_split_changes_nothing(spark, docs):
    rows = docs.select("doc_id", "text").dropDuplicates(["doc_id"])
    found = []
    for parts in (1, 5):
        frame = rows.repartition(parts)
        found.append(sorted((r["doc_id"], r["shard"], r["slot"]) for r in sharding.sharded(frame).collect()))
    assert found[0] == found[1]


def best_cuts(sizes, quotas):
    """The fewest shards too many, over all ways to give groups whole to shards and cut the rest."""
    best = len(quotas) * len(sizes)

    def place(i, room, cut):
        nonlocal best
        if cut >= best:
            return
        if i == len(sizes):
            best = cut
            return
        for s in {r: s for s, r in enumerate(room) if r >= sizes[i]}.values():
            place(i + 1, [r - sizes[i] * (s == k) for k, r in enumerate(room)], cut)
        left, used = sizes[i], []
        for s in sorted(range(len(room)), key=lambda s: -room[s]):
            if left and room[s]:
                used.append((s, min(left, room[s])))
                left -= used[-1][1]
        if len(used) > 1 and not left:
            place(i + 1, [r - dict(used).get(k, 0) for k, r in enumerate(room)], cut + len(used) - 1)

    place(0, list(quotas), 0)
    return best


def test_cuts_are_near_the_best_packing(spark):
    import random

    rng = random.Random(8)
    for case in range(3):
        sizes = sorted((rng.randint(2, 9) for _ in range(9)), reverse=True)
        rows = [(100 * g + i, f"c{case}g{g}") for g, n in enumerate(sizes) for i in range(n)]
        total = len(rows)
        quotas = [total // 4 + (s < total % 4) for s in range(4)]
        frame = spark.createDataFrame(rows, "doc_id long, text string")
        out = sharding.sharded(frame, sharding.ShardRules(shards=4)).join(frame, "doc_id").collect()
        law_holds(out, 4)
        assert cuts((r["text"], r["shard"]) for r in out)[1] <= best_cuts(sizes, quotas) + 3
