"""Balanced label propagation: documents into shards of equal row counts, linked ones together.

Documents are linked through hubs: all documents of one hub (here: of one text) belong together. A
label is a shard; documents start evenly spread. In each round

* hubs count the labels of their documents and choose the fullest shards that have room for all;
* documents elsewhere ask to move there;
* every shard admits as many as its quota leaves room for, hub by hub.

Hubs stand between documents, so a group of n documents costs n links, not n * n. Then shards settle:
one over its quota gives whole groups to shards with room, largest rooms first, round by round, until
none fits; only what is left is cut, and documents without links fill every shard up to its quota, so
the counts differ by one at most. Results depend on ids and texts, not on how the table is split.

Only DataFrame functions; the driver sees one number per shard, and the groups larger than a shard,
of which there are fewer than shards.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barograph.llm.common import documents, stored


@dataclass(frozen=True)
class ShardRules:
    shards: int = 40
    #: A stop for links that never come to rest; rounds end when none moves a document.
    rounds: int = 50
    #: Rows of one numbering bucket, about.
    bucket_rows: int = 10_000


DEFAULT_RULES = ShardRules()


def cumulated(rows: DataFrame, keys: list[str], bucket: Column, order: list[str], size: str | None, name: str) -> DataFrame:
    """Rows with the sum of ``size`` (a count without one) over the rows before them within the keys, by
    bucket, then by order.

    Buckets are added up first; only inside a bucket are rows sorted, so no task sorts a whole group.
    """
    one = F.lit(1).cast("long") if size is None else F.col(size)
    rows = rows.withColumns({"_bucket": bucket, "_size": one})
    sums = rows.groupBy(*keys, "_bucket").agg(F.sum("_size").alias("_n"))
    earlier = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(*keys, "_bucket", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_offset"))
    inside = Window.partitionBy(*keys, "_bucket").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return (
        rows.join(offsets, [*keys, "_bucket"])
        .withColumn(name, F.col("_offset") + F.coalesce(F.sum("_size").over(inside), F.lit(0)))
        .drop("_bucket", "_offset", "_size")
    )


def numbered(rows: DataFrame, keys: list[str], bucket: Column, order: list[str], name: str) -> DataFrame:
    """Rows with a gapless number from 0 within the keys, by bucket, then by order."""
    return cumulated(rows, keys, bucket, order, None, name)


def _at(values: list[int], index: str) -> Column:
    return F.get(F.array(*[F.lit(v).cast("long") for v in values]), F.col(index))


def _loads(labels: DataFrame, shards: int) -> list[int]:
    found = {row["shard"]: row["count"] for row in labels.groupBy("shard").count().collect()}
    return [found.get(s, 0) for s in range(shards)]


def plans(votes: DataFrame, room: list[int]) -> DataFrame:
    """(hub, targets): the fewest shards, fullest first, that can hold all documents of a hub. What
    a shard can hold is what it holds already and its room. A list has one entry per shard at most."""
    ranked = F.reverse(
        F.sort_array(
            F.collect_list(
                F.struct(
                    F.least(F.col("votes") + _at(room, "shard"), F.col("k")).alias("useful"),
                    "votes",
                    F.xxhash64("hub", "shard").alias("chance"),
                    "shard",
                )
            )
        )
    )
    none = F.struct(F.lit(0).cast("long").alias("held"), F.array().cast("array<int>").alias("targets"))
    chosen = F.aggregate(
        "ranked",
        none,
        lambda acc, x: F.when(acc["held"] >= F.col("k"), acc).otherwise(
            F.struct(
                (acc["held"] + x["useful"]).alias("held"),
                F.concat(acc["targets"], F.array(x["shard"])).alias("targets"),
            )
        ),
    )
    return votes.groupBy("hub", "k").agg(ranked.alias("ranked")).select("hub", chosen["targets"].alias("targets"))


def propagated(links: DataFrame, start: DataFrame, quotas: list[int], rules: ShardRules) -> DataFrame:
    """Labels (node, shard) after the rounds, from links (node, hub, k) with k the documents of the
    hub, and the labels to start with. No shard gains a document beyond its quota."""
    labels = start
    for _ in range(rules.rounds):
        room = [max(0, q - n) for q, n in zip(quotas, _loads(labels, len(quotas)), strict=True)]
        state = links.join(labels, "node")
        votes = state.groupBy("hub", "k", "shard").agg(F.count(F.lit(1)).alias("votes"))
        wishes = state.join(plans(votes, room), "hub").withColumn(
            "target",
            F.when(F.array_contains("targets", F.col("shard")), F.col("shard")).otherwise(
                F.get("targets", F.pmod(F.xxhash64("node"), F.size("targets")).cast("int"))
            ),
        )
        # of several hubs of a document the largest speaks
        spoken = wishes.groupBy("node", "shard").agg(
            F.max_by(F.struct("target", "hub", "k"), F.struct("k", "hub")).alias("w")
        )
        asked = spoken.where("w.target <> shard").select("node", "w.target", "w.hub", "w.k")
        # a hub stays together in the queue; a very large one stands in several places
        parts = 1 + F.floor(F.col("k") / 1024)
        place = F.xxhash64("hub", F.pmod(F.xxhash64("node"), parts))
        queue = numbered(asked, ["target"], F.pmod(place, F.lit(256)), ["hub", "node"], "number")
        admitted = stored(
            queue.where(F.col("number") < _at(room, "target")).select("node", "target"), "shard-moves"
        )
        if not admitted.limit(1).count():
            break
        labels = stored(
            labels.join(admitted, "node", "left").select("node", F.coalesce("target", "shard").alias("shard")),
            "shard-labels",
        )
    return labels


#: Buckets of groups on their way to another shard.
POOL = 1024


def _placed(pool: DataFrame, room: list[int], seed: int) -> DataFrame:
    """(hub, from, n, shard): groups laid end to end along the rooms, the largest room first; shard is
    null where a group would not lie in one room."""
    order = sorted(range(len(room)), key=lambda s: (-room[s], s))
    first = [sum(room[s] for s in order[:i]) for i in range(len(order) + 1)]
    laid = cumulated(
        pool.withColumn("_all", F.lit(0)), ["_all"], F.pmod(F.xxhash64("hub", "from", F.lit(seed)), F.lit(POOL)),
        ["hub", "from"], "n", "start",
    )
    at = F.size(F.filter(F.array(*[F.lit(x).cast("long") for x in first[:-1]]), lambda x: x <= F.col("start"))) - 1
    end = F.get(F.array(*[F.lit(x).cast("long") for x in first[1:]]), at)
    shard = F.get(F.array(*[F.lit(s) for s in order]), at)
    return laid.select("hub", "from", "n", F.when(F.col("start") + F.col("n") <= end, shard).alias("shard"))


def settled(groups: DataFrame, quotas: list[int], rules: ShardRules) -> tuple[DataFrame, list[int]]:
    """((hub, from, n, shard), room): where the members ``from`` to ``from + n`` of every group (hub, shard,
    n) go, null where a group fits nowhere whole, and the room that is left in each shard."""
    least = min(quotas)
    shards = len(quotas)
    free = list(range(shards))
    giants = []
    if least:
        # groups that fill shards alone: fewer than there are shards
        for row in groups.where(F.col("n") >= least).orderBy(F.desc("n"), "hub").collect():
            start = 0
            while row["n"] - start >= least and free and row["n"] - start >= quotas[free[0]]:
                shard = free.pop(0)
                giants.append((row["hub"], start, quotas[shard], shard))
                start += quotas[shard]
            if start < row["n"]:
                giants.append((row["hub"], start, row["n"] - start, None))
    session = groups.sparkSession
    schema = "hub long, from long, n long, shard int"
    parts = session.createDataFrame(giants, schema)
    usual = groups.where(F.col("n") < least) if least else groups
    room = [quotas[s] if s in free else 0 for s in range(shards)]
    # each shard keeps what its quota holds
    buckets = max(16, sum(quotas) // rules.bucket_rows)
    queue = cumulated(
        usual, ["shard"], F.pmod(F.xxhash64("hub"), F.lit(max(4, buckets // shards))), ["hub"], "n", "start"
    )
    fits = F.col("start") + F.col("n") <= _at(room, "shard")
    kept = queue.select("hub", F.lit(0).cast("long").alias("from"), "n", F.when(fits, F.col("shard")).alias("shard"))
    state = stored(kept.unionByName(parts.where("shard IS NULL")), "shard-groups")
    done = [parts.where("shard IS NOT NULL"), state.where("shard IS NOT NULL")]
    pool = state.where("shard IS NULL")
    seed = 0
    while True:
        sums = state.where("shard IS NOT NULL").groupBy("shard").agg(F.sum("n").alias("n"))
        taken = {row["shard"]: row["n"] for row in sums.collect()}
        room = [r - taken.get(s, 0) for s, r in enumerate(room)]
        if (seed and not taken) or not pool.limit(1).count():
            break
        state = stored(_placed(pool.drop("shard"), room, seed), "shard-groups")
        done.append(state.where("shard IS NOT NULL"))
        pool = state.where("shard IS NULL")
        seed += 1
    out = done[0]
    for part in [*done[1:], pool]:
        out = out.unionByName(part)
    return out, room


def sharded(
    docs: DataFrame, rules: ShardRules = DEFAULT_RULES, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) for every row.

    Law ``rows``: counts of shards differ by one at most, for any number of rows. A null text has no
    bytes and no links; empty texts are equal texts. Repeated rows and null ids are rows like any
    other. Other columns are not read; no rows give no rows.
    """
    text = F.coalesce("text", F.lit(""))
    rows = documents(docs, id_col, text_col).select(
        "doc_id",
        (F.octet_length(text) + 16).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.when(F.col("text").isNotNull(), F.xxhash64("text")).alias("hub"),
        F.monotonically_increasing_id().alias("node"),
    )
    # the number of a row only tells rows apart that are alike; rows without an id are spread by it
    chance = F.xxhash64(F.coalesce("doc_id", "node"), F.coalesce("hub", F.lit(0)))
    rows = stored(rows.withColumn("chance", chance), "shard-rows")
    total = rows.count()
    quotas = [total // rules.shards + (s < total % rules.shards) for s in range(rules.shards)]
    buckets = max(16, total // rules.bucket_rows)
    per_shard = max(4, buckets // rules.shards)
    order = ["chance", "doc_id", "node"]

    hubs = rows.where("hub IS NOT NULL").groupBy("hub").agg(F.count(F.lit(1)).alias("k")).where("k > 1")
    # members of a hub by number; labels belong to numbers, so they do not depend on how the table is split
    members = rows.select("node", "chance", "doc_id", "hub").join(hubs, "hub")
    members = numbered(members, ["hub"], F.pmod(F.col("chance"), F.lit(buckets)), order, "number")
    links = stored(members.withColumn("member", F.xxhash64("hub", "number")), "shard-links")
    linked = links.select(F.col("member").alias("node"), "hub", "k")
    start = linked.select("node", F.pmod("node", F.lit(rules.shards)).cast("int").alias("shard"))
    labels = propagated(linked, stored(start, "shard-labels"), quotas, rules)

    # a group that propagation left in several shards settles where most of it is
    here = linked.join(labels, "node").groupBy("hub", "k", "shard").agg(F.count(F.lit(1)).alias("votes"))
    groups = here.groupBy("hub", F.col("k").alias("n")).agg(F.max_by("shard", F.struct("votes", "shard")).alias("shard"))
    pieces, room = settled(stored(groups, "shard-hubs"), quotas, rules)

    # members up to the number ``to`` go to ``shard``; a list has one entry per shard at most
    piece = F.struct((F.col("from") + F.col("n")).alias("to"), "shard")
    of_hub = pieces.groupBy("hub").agg(F.sort_array(F.collect_list(piece)).alias("pieces"))
    mine = F.filter("pieces", lambda p: p["to"] > F.col("number"))[0]["shard"]
    kept = stored(links.join(of_hub, "hub").select("node", mine.alias("shard")), "shard-kept")
    merged = stored(
        rows.join(kept.withColumn("linked", F.lit(True)), "node", "left").withColumn("linked", F.coalesce("linked", F.lit(False))),
        "shard-merged",
    )

    # the rest fills the rooms: groups that had to be cut first, member by member, then single documents
    first = [sum(room[:s]) for s in range(rules.shards)]
    bounds = F.array(*[F.lit(x).cast("long") for x in first])
    rest = merged.where("shard IS NULL").drop("shard").withColumn("all", F.lit(0))
    place = F.when(F.col("linked"), F.pmod(F.xxhash64("hub"), F.lit(POOL))).otherwise(
        POOL + F.pmod(F.col("chance"), F.lit(buckets))
    )
    free = numbered(rest, ["all"], place, [F.when(F.col("linked"), F.col("hub")), *order], "number").drop("all")
    free = free.withColumn("shard", F.size(F.filter(bounds, lambda x: x <= F.col("number"))) - 1).drop("number")
    placed = merged.where("shard IS NOT NULL").unionByName(free)
    slotted = numbered(placed, ["shard"], F.pmod(F.col("chance"), F.lit(per_shard)), order, "slot")
    return slotted.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        F.col("shard").cast("int").alias("shard"),
        F.col("slot").cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
