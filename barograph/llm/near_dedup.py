"""Near-duplicate classes by a MinHash LSH forest.

1. Every text becomes a set of word shingles, a digest of the set and a MinHash signature. Texts
   with equal sets form one class, represented by the smallest id.
2. A forest of trees: each tree sorts the representatives by its own order of the signature. A
   region is a set of representatives with a common prefix in one tree. Where a region holds many,
   the prefix grows, region by region, until few are left.
3. First candidates are neighbours by longest common prefix, the next ones in the sorted order inside
   a small region, and the hub of a large one, the member with the greatest hash. Of its candidates
   with a similar signature, each text is compared with the most similar one and with the greatest
   hub, on the full shingle sets. Their links are contracted to components. In large regions that
   hold several components, members meet anchors of other components, round by round.
4. What can still join two components: all members of a small region are candidates of each other;
   members of large regions that hold several components are joined exactly. Two similar sets share
   one of their rarest shingles, so the rarest quarter of each set is joined on the shingle, and
   every pair that can still be similar by sizes and positions is compared on the full sets.

Two texts at the threshold share a region of some tree with probability 1 - (1 - 0.75^4)^32, all but
5 in a million. In a small region a pair is compared if 59 % of the signature is equal, which a pair
at the threshold misses 3 or 4 times in 100,000; in a large region no pair is missed.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barograph.llm.common import (
    LEAST_SIMILARITY,
    SHINGLE_WORDS,
    by_batch,
    documents,
    pieces,
    rows_to_batch,
    shingle_hashes,
    stored,
    union_all,
    utf8,
)
from barograph.llm.graph import components
from barograph.session import ship_package


@dataclass(frozen=True)
class ForestRules:
    words: int = SHINGLE_WORDS
    #: Least similarity of a link: 100 * intersection >= similarity * union.
    similarity: int = LEAST_SIMILARITY
    trees: int = 32
    #: Signature values of the shortest prefix; longer ones are multiples.
    prefix: int = 4
    deepest: int = 4
    #: Regions of more members get a longer prefix.
    leaf: int = 32
    neighbours: int = 2
    #: Trees whose large regions name hubs; the same few texts are hubs in all trees.
    hub_trees: int = 16
    #: Members of other components that a member of a large region meets per round.
    anchors: int = 2
    #: Rounds go on while they leave at most this share of the components of large regions.
    progress: float = 0.8
    #: Share of equal signature values below which a candidate is not compared. At the threshold
    #: the share is 0.75 with a deviation of 0.038.
    share: float = 0.6
    #: Members outside the largest component of a shingle that meet the others in one task.
    block: int = 256
    #: Most counters (4 bytes each) that tell rare shingles from common ones.
    counters: int = 1 << 22
    #: More candidates between components than this are compared in two turns, the best first.
    all_at_once: int = 50_000
    #: Representatives up to this number are broadcast as ids (8 bytes each); beyond, texts are shuffled.
    broadcast_ids: int = 2_000_000
    broadcast_signatures: int = 100_000
    #: An anchor's text is sent once per block of its partners.
    blocks: int = 256

    @property
    def hashes(self) -> int:
        return self.trees * self.prefix


DEFAULT_RULES = ForestRules()

#: Numbers from here on stand for texts that only rows without an id hold.
STAND_INS = 1 << 62

_rng = np.random.default_rng(20240607)
_A = _rng.integers(1, 2**63, 4096, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_B = _rng.integers(0, 2**63, 4096, dtype=np.uint64)


def shingle_set(text: bytes | None, width: int) -> np.ndarray:
    """Distinct shingles of a text as sorted 64-bit hashes."""
    words = text.lower().split() if text else []
    return np.unique(shingle_hashes(words, width, xxhash.xxh3_64_intdigest))


def signature(shingles: np.ndarray, hashes: int) -> np.ndarray:
    """MinHash values as signed 32-bit integers."""
    least = np.full(hashes, np.uint64(2**64 - 1))
    keys = (shingles >> np.uint64(32))[:, None]
    a, b = _A[:hashes][None, :], _B[:hashes][None, :]
    with np.errstate(over="ignore"):
        for at in range(0, len(keys), 512):
            block = keys[at : at + 512] * a
            block += b
            np.minimum(least, block.min(axis=0), out=least)
    return (least >> np.uint64(32)).astype(np.uint32).view(np.int32)


def similar(left: np.ndarray, right: np.ndarray, percent: int) -> bool:
    if not len(left) or not len(right):
        return False
    if 100 * min(len(left), len(right)) < percent * max(len(left), len(right)):
        return False
    both = len(np.intersect1d(left, right, assume_unique=True))
    return 100 * both >= percent * (len(left) + len(right) - both)


def sketches(rows: DataFrame, rules: ForestRules = DEFAULT_RULES) -> DataFrame:
    """(doc_id, text_key, n_shingles, d1, d2, sig) per row (doc_id, text); an empty set has nulls."""
    schema = pa.schema(
        [("doc_id", pa.int64()), ("text_key", pa.int64()), ("n_shingles", pa.int64()), ("d1", pa.int64()),
         ("d2", pa.int64()), ("sig", pa.list_(pa.int32()))]
    )

    def make():
        def one(text: bytes | None) -> tuple:
            shingles = shingle_set(text, rules.words)
            if not len(shingles):
                return 0, None, None, None
            d1, d2 = np.frombuffer(xxhash.xxh3_128_digest(shingles.tobytes()), np.int64).tolist()
            return len(shingles), d1, d2, signature(shingles, rules.hashes)

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = [one(text) for text in utf8(batch.column("text"))]
            keys = [batch.column("doc_id"), batch.column("text_key")]
            return rows_to_batch(schema, [*keys, *map(list, zip(*found, strict=True))])

        return step

    return by_batch(
        rows.withColumn("text_key", F.xxhash64("text")),
        make,
        "doc_id long, text_key long, n_shingles long, d1 long, d2 long, sig array<int>",
    )


# ---------------------------------------------------------------- forest


def _order(rules: ForestRules, depth: int) -> Column:
    """The first ``depth`` prefixes in the order of a tree; orders go round the signature."""
    turned = F.concat("sig", F.slice("sig", 1, rules.prefix * (rules.deepest - 1)))
    return F.slice(turned, F.col("tree") * rules.prefix + 1, rules.prefix * depth)


def forest(classes: DataFrame, rules: ForestRules) -> DataFrame:
    """(rep, tree, key, n, order): representatives in regions of two or more, with the number of
    members of the region and their place in the order of the tree.

    A region with more than ``leaf`` members also appears cut up by a longer prefix, and so on; each
    depth is a table, so that later steps only read.
    """
    in_trees = classes.select("rep", "sig", F.explode(F.sequence(F.lit(0), F.lit(rules.trees - 1))).alias("tree"))
    keyed = in_trees.select("rep", "tree", F.xxhash64("tree", _order(rules, 1)).alias("key"))
    shared = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    order = F.slice(_order(rules, rules.deepest), rules.prefix + 1, rules.prefix * (rules.deepest - 1))
    members = stored(
        keyed.join(shared, "key")
        .join(classes.select("rep", "sig"), "rep")
        .select("rep", "tree", "key", "n", order.alias("order")),
        "forest",
    )
    levels = [members]
    for depth in range(1, rules.deepest):
        large = members.where(F.col("n") > rules.leaf)
        if not large.limit(1).count():
            break
        longer = F.xxhash64("key", F.slice("order", rules.prefix * (depth - 1) + 1, rules.prefix))
        cut = large.withColumn("key", longer).drop("n")
        sizes = cut.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        members = stored(cut.join(sizes, "key").select(levels[0].columns), "forest")
        levels.append(members)
    return union_all(levels)


def _neighbours(small: DataFrame, ahead: int) -> DataFrame:
    """Each member of a small region with the next ``ahead`` in the order of the tree, where they are
    not connected yet. A list holds ``leaf`` members at most."""
    sorted_ = F.sort_array(F.collect_list(F.struct("order", "rep", "component")))
    lists = small.groupBy("key").agg(sorted_.alias("list"))
    pairs = F.flatten(
        F.transform(
            "list",
            lambda x, i: F.transform(
                F.filter(
                    F.slice("list", i + 2, ahead), lambda y: y["component"] != x["component"]
                ),
                lambda y: F.struct(x["rep"].alias("a"), y["rep"].alias("b")),
            ),
        )
    )
    return lists.select(F.explode(pairs).alias("pair")).select("pair.a", "pair.b")


def _with_hubs(members: DataFrame) -> DataFrame:
    """Every member of a region with the one that has the greatest hash there. The hash does not
    depend on the region, so the same few texts are hubs in all trees."""
    hub = F.max_by("rep", F.struct(F.xxhash64("rep"), "rep"))
    hubs = members.groupBy("key").agg(hub.alias("b"))
    return members.join(hubs, "key").where("rep <> b").select(F.col("rep").alias("a"), "b")


def _once(found: DataFrame) -> DataFrame:
    """Each pair once, in the direction of its greatest hash, so that a hub comes as b."""
    a, b = F.struct(F.xxhash64("a"), "a"), F.struct(F.xxhash64("b"), "b")
    return found.select(
        F.when(a < b, F.col("a")).otherwise(F.col("b")).alias("a"),
        F.when(a < b, F.col("b")).otherwise(F.col("a")).alias("b"),
    ).distinct()


def short_signatures(classes: DataFrame, ids: DataFrame, rules: ForestRules) -> DataFrame:
    """(rep, sig) of the given representatives, seven bits per value. Up to ``broadcast_signatures``
    of them are broadcast (128 bytes each)."""
    bits = F.transform("sig", lambda x: x.bitwiseAND(127).cast("tinyint"))
    short = stored(classes.join(ids, "rep", "left_semi").select("rep", bits.alias("sig")), "signatures")
    return F.broadcast(short) if short.count() <= rules.broadcast_signatures else short


def promising(pairs: DataFrame, signatures: DataFrame, least: float) -> DataFrame:
    """(a, b, equal): pairs with the number of equal signature values, if it is not below ``least``."""
    left = signatures.select(F.col("rep").alias("a"), F.col("sig").alias("left"))
    right = signatures.select(F.col("rep").alias("b"), F.col("sig").alias("right"))
    equal = F.size(F.filter(F.zip_with("left", "right", lambda x, y: x == y), lambda same: same))
    return (
        pairs.join(left, "a")
        .join(right, "b")
        .select("a", "b", equal.alias("equal"))
        .where(F.col("equal") >= int(least))
    )


# ---------------------------------------------------------------- large regions


def crowded(placed: DataFrame, rules: ForestRules) -> DataFrame:
    """(key, rep, component): large regions that hold several components."""
    large = placed.where(F.col("n") > rules.leaf)
    mixed = large.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    rows = large.join(mixed.where("low <> high").select("key"), "key").select("key", "rep", "component")
    return stored(rows, "crowded")


def weighted(regions: DataFrame) -> DataFrame:
    """(rep, component, weight) of the members of regions; the weight is the number of members of the
    component."""
    reps = regions.select("rep", "component").distinct()
    return reps.join(reps.groupBy("component").agg(F.count(F.lit(1)).alias("weight")), "component")


def _with_anchors(regions: DataFrame, rules: ForestRules) -> DataFrame:
    """Every member of a region with a few members of other components: of each part of the region's
    components, by hash, the greatest hash in the heaviest component."""
    rows = regions.join(weighted(regions).select("rep", "weight"), "rep")
    part = F.pmod(F.xxhash64("component"), F.lit(rules.anchors))
    anchors = (
        rows.groupBy("key", part.alias("part"))
        .agg(F.max_by(F.struct("rep", "component"), F.struct("weight", "component", F.xxhash64("rep"))).alias("top"))
        .select("key", F.col("top.rep").alias("b"), F.col("top.component").alias("other"))
    )
    return regions.join(anchors, "key").where("component <> other").select(F.col("rep").alias("a"), "b")


def shingle_weights(texts: DataFrame, bits: int, rules: ForestRules) -> np.ndarray:
    """How often shingles occur, counted by the first ``bits`` of their hash. Any counts give an order of
    all shingles; good ones put common shingles last."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << bits, np.int64)
        for batch in pieces(batches):
            for text in utf8(batch.column("text")):
                np.add.at(total, (shingle_set(text, rules.words) >> np.uint64(64 - bits)).astype(np.int64), 1)
        found = np.flatnonzero(total)
        for at in range(0, len(found), 100_000):
            part = found[at : at + 100_000]
            yield pa.RecordBatch.from_arrays([pa.array(part.astype(np.int32)), pa.array(total[part])], names=["at", "n"])

    ship_package(texts.sparkSession)
    sums = texts.select("text").mapInArrow(count, "at int, n long").groupBy("at").agg(F.sum("n").alias("n"))
    out = np.zeros(1 << bits, np.int32)
    counted = stored(sums.select("at", F.least("n", F.lit(2**31 - 1)).cast("int").alias("n")), "weights").toArrow()
    out[counted["at"].to_numpy()] = counted["n"].to_numpy()
    return out


def prefixes(n: int, percent: int) -> tuple[int, int]:
    """Sets of ``n`` shingles or fewer that are similar to one of ``n`` share one of its so many rarest
    shingles, and one of those in the first such part of their own, which is the second number."""
    return n - -(-percent * n // 100) + 1, n - -(-2 * percent * n // (100 + percent)) + 1


def rare_shingles(texts: DataFrame, rules: ForestRules) -> DataFrame:
    """(shingle, rep, component, weight, size, place, short): the rarest shingles of every set with
    their place in the order from rare to common; ``short`` marks those that suffice against a
    larger set."""
    session = texts.sparkSession
    reps = texts.count()
    bits = min(max(64 * reps, 1 << 16), rules.counters).bit_length() - 1
    shared = session.sparkContext.broadcast(shingle_weights(texts, bits, rules))
    schema = pa.schema(
        [("shingle", pa.int64()), ("rep", pa.int64()), ("component", pa.int64()), ("weight", pa.int64()),
         ("size", pa.int32()), ("place", pa.int32()), ("short", pa.bool_())]
    )

    def rarest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        often = shared.value
        for batch in pieces(batches):
            keys = [batch.column(n).to_pylist() for n in ("rep", "component", "weight")]
            for rep, component, weight, text in zip(*keys, utf8(batch.column("text")), strict=True):
                shingles = shingle_set(text, rules.words)
                n = len(shingles)
                if not n:
                    continue
                long, short = prefixes(n, rules.similarity)
                common = often[(shingles >> np.uint64(64 - bits)).astype(np.int64)]
                first = shingles[np.lexsort((shingles, common))[:long]].view(np.int64)
                place = np.arange(long, dtype=np.int32)
                same = [np.full(long, x, np.int64) for x in (rep, component, weight)]
                yield rows_to_batch(
                    schema, [*map(pa.array, (first, *same, np.full(long, n, np.int32), place, place < short))]
                )

    ship_package(session)
    return texts.mapInArrow(
        rarest, "shingle long, rep long, component long, weight long, size int, place int, short boolean"
    )


def possible(texts: DataFrame, rules: ForestRules) -> DataFrame:
    """Pairs (a, b) with every pair of similar sets of different components among the rows (rep, component,
    weight, text).

    Of a shingle, members of the component with the greatest weight meet only the others, and these
    come in blocks, so that a common shingle is spread over tasks.
    """
    rare = stored(rare_shingles(texts, rules), "rare")
    mixed = (
        rare.groupBy("shingle")
        .agg(
            F.min("component").alias("low"),
            F.max("component").alias("high"),
            F.bool_or("short").alias("any"),
            F.max(F.struct("weight", "component")).alias("most"),
        )
        .where("low <> high AND any")
        .select("shingle", F.col("most.component").alias("major"))
    )
    rows = stored(rare.join(mixed, "shingle").drop("weight"), "rare")
    others = rows.where("component <> major")
    blocks = others.groupBy("shingle").agg(F.ceil(F.count(F.lit(1)) / rules.block).cast("int").alias("blocks"))
    few = others.join(blocks, "shingle").select(
        "shingle",
        F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int").alias("block"),
        *[F.col(n).alias(f"{n}_b") for n in ("rep", "component", "size", "place", "short")],
    )
    many = rows.join(blocks, "shingle").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    percent = rules.similarity
    left = F.least(F.col("size") - F.col("place"), F.col("size_b") - F.col("place_b"))
    pairs = many.join(few, ["shingle", "block"]).where(
        (F.col("component") != F.col("component_b"))
        & (100 * F.least("size", "size_b") >= percent * F.greatest("size", "size_b"))
        & ((F.col("short") & (F.col("size") <= F.col("size_b"))) | (F.col("short_b") & (F.col("size_b") <= F.col("size"))))
        & ((100 + percent) * left >= percent * (F.col("size") + F.col("size_b")))
    )
    return _once(pairs.select(F.col("rep").alias("a"), F.col("rep_b").alias("b")))


# ---------------------------------------------------------------- comparison


def confirmed(pairs: DataFrame, texts: DataFrame, rules: ForestRules) -> DataFrame:
    """(a, b) of the pairs whose full shingle sets are similar enough.

    Rows are sorted so that the anchor's text comes before those of its partners; a task keeps the
    set of one anchor. A popular anchor is split over blocks of partners.
    """
    blocked = pairs.select("a", "b", F.pmod(F.xxhash64("a"), F.lit(rules.blocks)).alias("block"))
    partners = blocked.select(F.col("a").alias("rep"), "b", "block", F.lit(1).alias("turn"))
    anchors = blocked.select(F.col("b").alias("rep"), "b", "block", F.lit(0).alias("turn")).distinct()
    asked = partners.unionByName(anchors).join(texts, "rep")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, sets = None, []
        for batch in pieces(batches):
            a, b = [], []
            for key, block, turn, partner, text in zip(
                *[batch.column(n).to_pylist() for n in ("b", "block", "turn", "rep")],
                utf8(batch.column("text")),
                strict=True,
            ):
                shingles = shingle_set(text, rules.words)
                if turn == 0:
                    sets = [*sets, shingles] if at == (key, block) else [shingles]
                    at = (key, block)
                elif at == (key, block) and any(similar(shingles, s, rules.similarity) for s in sets):
                    a.append(partner)
                    b.append(key)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    ship_package(pairs.sparkSession)
    return (
        asked.repartition("b", "block")
        .sortWithinPartitions("b", "block", "turn")
        .mapInArrow(compare, "a long, b long")
    )


def _known(rows: DataFrame, found: DataFrame | None, end: str, component: str) -> DataFrame:
    """The rows with the component of a node; a node without links is its own."""
    if found is None:
        return rows.withColumn(component, F.col(end))
    known = found.select(F.col("node").alias(end), F.col("component").alias("known"))
    return rows.join(known, end, "left").withColumn(component, F.coalesce("known", end)).drop("known")


def _across(pairs: DataFrame, found: DataFrame | None) -> DataFrame:
    """Pairs whose ends are not connected yet."""
    placed = _known(_known(pairs, found, "a", "of_a"), found, "b", "of_b")
    return placed.where("of_a <> of_b").select(pairs.columns)


def _leading(scored: DataFrame) -> DataFrame:
    """Of the scored pairs (a, b, equal) each text's most similar partner and its greatest hub."""
    scored = stored(scored, "scored")

    def best(end: str, other: str) -> DataFrame:
        return scored.groupBy(F.col(end).alias("a")).agg(
            F.max(F.struct("equal", (-F.col(other)).alias("back"), F.col(other).alias("b"))).alias("nearest"),
            F.max(F.struct(F.xxhash64(other).alias("chance"), F.col(other).alias("b"))).alias("hub"),
        )

    both = best("a", "b").unionByName(best("b", "a")).groupBy("a").agg(
        F.max("nearest").alias("nearest"), F.max("hub").alias("hub")
    )
    return _once(both.select("a", F.explode(F.array("nearest.b", "hub.b")).alias("b")))


def contracted(found: DataFrame | None, links: DataFrame) -> DataFrame:
    """(node, component) after more links: only their ends' components are joined anew."""
    if found is None:
        return components(links, "a", "b")
    ends = _known(_known(links, found, "a", "of_a"), found, "b", "of_b")
    joined = components(ends, "of_a", "of_b")
    before = found.join(joined.select(F.col("node").alias("component"), F.col("component").alias("now")), "component", "left")
    fresh = joined.join(found.select("node"), "node", "left_anti")
    return stored(
        before.select("node", F.coalesce("now", "component").alias("component")).unionByName(fresh), "components"
    )


def linked(classes: DataFrame, rows: DataFrame, rules: ForestRules) -> DataFrame | None:
    """(node, component) of all representatives that have a link; None if there is none."""
    members = forest(classes, rules)
    reps = stored(members.select("rep").distinct(), "forest-ids")
    ids = F.broadcast(reps) if reps.count() <= rules.broadcast_ids else reps
    texts = stored(rows.join(ids, "rep", "left_semi"), "forest-texts")
    signatures = short_signatures(classes, ids, rules)
    found: DataFrame | None = None

    def add(pairs: DataFrame) -> None:
        """Compare pairs and join the components of the similar ones."""
        nonlocal found
        links = stored(confirmed(pairs, texts, rules), "links")
        if links.limit(1).count():
            found = contracted(found, links)

    alone = members.withColumn("component", F.col("rep"))
    small = F.col("n") <= rules.leaf
    first = _neighbours(alone.where(small), rules.neighbours).unionByName(_with_hubs(members.where(~small & (F.col("tree") < rules.hub_trees))))
    add(_leading(promising(_once(first), signatures, rules.share * rules.hashes)))

    placed = _known(members, found, "rep", "component")
    regions = crowded(placed, rules)
    apart = regions.select("component").distinct().count()
    while apart:
        add(_leading(promising(_once(_with_anchors(regions, rules)), signatures, rules.share * rules.hashes)))
        placed = _known(members, found, "rep", "component")
        regions = crowded(placed, rules)
        before, apart = apart, regions.select("component").distinct().count()
        if apart > rules.progress * before:
            break

    pairs = promising(_once(_neighbours(placed.where(small), rules.leaf)), signatures, rules.share * rules.hashes)
    if apart:
        exact = promising(possible(texts.join(weighted(regions), "rep"), rules), signatures, 0)
        pairs = pairs.unionByName(exact).distinct()
    pairs = stored(pairs, "candidates")
    count = pairs.count()
    if count > rules.all_at_once:
        add(_leading(pairs))
        add(_across(pairs, found))
    elif count:
        add(pairs)
    return found


def near_duplicates(
    docs: DataFrame, rules: ForestRules = DEFAULT_RULES, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept, text_key), a row per row; ``text_key`` is Spark's
    xxhash64 of the text. Ids are below 2^62.

    A text with fewer words than a shingle is one shingle; a null text or one without words has none
    and is linked with nothing. Texts with equal sets are linked. Rows that repeat an id with the
    same text get the same component. A row without an id takes part: texts linked through it are
    linked. It never names a component, is not kept, and has no component if no id is reachable.
    Other columns are not read; no rows give no rows.
    """
    rows = documents(docs, id_col, text_col)
    sketched = stored(sketches(rows, rules), "sketches")
    # sets without an id get a number above all ids
    stand_in = F.lit(STAND_INS) + F.shiftrightunsigned(F.xxhash64("d1", "d2"), 2)
    sets = stored(
        sketched.where("n_shingles > 0")
        .groupBy("d1", "d2")
        .agg(
            F.min("doc_id").alias("doc_id"),
            F.any_value("sig").alias("sig"),
            F.min(F.when(F.col("doc_id").isNull(), F.col("text_key"))).alias("nameless"),
        )
        .withColumn("rep", F.coalesce("doc_id", stand_in)),
        "sets",
    )
    nameless = sets.where("doc_id IS NULL").select("rep", F.col("nameless").alias("text_key"))
    named = rows.where("doc_id IS NOT NULL").select(F.col("doc_id").alias("rep"), "text")
    if nameless.limit(1).count():
        texts = rows.where("doc_id IS NULL").select(F.xxhash64("text").alias("text_key"), "text")
        texts = texts.join(nameless, "text_key").dropDuplicates(["rep"]).select("rep", "text")
        named = named.unionByName(texts)
    found = linked(sets.select("rep", "sig"), named, rules)
    of_set = _known(sets.select("d1", "d2", "rep"), found, "rep", "component")
    component = F.when(F.col("component") < STAND_INS, F.col("component"))
    return (
        sketched.select("doc_id", "text_key", "n_shingles", "d1", "d2")
        .join(of_set.select("d1", "d2", component.alias("component")), ["d1", "d2"], "left")
        .select(
            "doc_id",
            "n_shingles",
            F.when(F.col("n_shingles") > 0, F.col("component")).otherwise(F.col("doc_id")).alias("component_id"),
            "text_key",
        )
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)))
    )
