"""Benchmark decontamination by SimHash over item-sized windows.

1. Items and documents become sequences of shingle hashes. Only a window that holds a shingle of an
   item can be similar to that item, so windows are laid around such shingles, for the items that
   have them (a join; nothing is lost, and no other items are looked at).
2. A window has as many words as the item. Its 64-bit fingerprint is the majority of each bit over
   its shingles, each counted as often as it occurs.
3. Fingerprints within the radius are found by a multi-index: cut into blocks, two fingerprints
   within radius r agree in some block up to r / blocks bits. Items are listed under every such
   block value, windows look up their own blocks under their item.
4. Candidates are compared exactly: the weighted similarity of the two bags of shingles.

Only DataFrame functions; no Python runs on the executors.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barograph.llm.common import LEAST_SIMILARITY, SHINGLE_WORDS, WORD_BREAKS, documents, stored, union_all

SPACES = " \t\n\x0b\x0c\r"


@dataclass(frozen=True)
class WindowRules:
    words: int = SHINGLE_WORDS
    #: Least similarity of the bags: 100 * shared >= similarity * (all - shared).
    similarity: int = LEAST_SIMILARITY
    #: At the threshold 11 of 64 bits differ, with a deviation of 3.
    radius: int = 23
    blocks: int = 8
    #: Benchmark tables up to this number of rows are broadcast, larger ones are shuffled.
    broadcast_rows: int = 200_000
    broadcast_ids: int = 2_000_000

    @property
    def bits(self) -> int:
        return 64 // self.blocks


DEFAULT_RULES = WindowRules()


def words_of(text: Column) -> Column:
    """Words between ASCII white space, in lower case."""
    trimmed = F.btrim(F.lower(F.coalesce(text, F.lit(""))), F.lit(SPACES))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, WORD_BREAKS))


def shingles_of(words: str, width: int) -> Column:
    """Hashes of all runs of ``width`` words; none where there are fewer words."""
    runs = F.sequence(F.lit(0), F.size(words) - width)
    hashes = F.transform(runs, lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(width)]))
    return F.when(F.size(words) >= width, hashes).otherwise(F.array().cast("array<bigint>"))


def places_of(rows: DataFrame, width: int) -> DataFrame:
    """(doc_id, row, length, place, key) for all runs of ``width`` words: the same hashes as rows, made
    from the word array and its shifted slices without a function call per run."""
    runs = F.greatest(F.size("words") - (width - 1), F.lit(0))
    shifted = F.arrays_zip(*[F.slice("words", k + 1, runs).alias(f"w{k}") for k in range(width)])
    placed = rows.select("doc_id", "row", F.size("words").alias("length"), F.posexplode(shifted).alias("place", "run"))
    return placed.select(
        "doc_id", "row", "length", "place", F.xxhash64(*[F.col(f"run.w{k}") for k in range(width)]).alias("key")
    )


def fingerprints(rows: DataFrame, key: str, shingles: str, longest: int) -> DataFrame:
    """(key, print): bit b is set if more than half of the hashes of a bag have it.

    Several counters share a number, as many as the longest bag allows, so that a few sums count all
    64 bits.
    """
    lane = 8 if longest <= 127 else 16 if longest <= 32_767 else 32
    lanes = range(64 // lane)
    mask = F.lit(sum(1 << (lane * j) for j in lanes))
    hashes = rows.select(key, F.explode(shingles).alias("x"))
    counters = hashes.groupBy(key).agg(
        F.count(F.lit(1)).alias("n"),
        *[F.sum(F.shiftrightunsigned("x", k).bitwiseAND(mask)).alias(f"c{k}") for k in range(lane)],
    )
    bits = F.lit(0).cast("long")
    for k in range(lane):
        for j in lanes:
            count = F.shiftrightunsigned(f"c{k}", j * lane).bitwiseAND(F.lit((1 << lane) - 1))
            bit = 1 << (j * lane + k)
            value = F.lit(bit - (1 << 64) if bit >> 63 else bit).cast("long")
            bits = bits.bitwiseOR(F.when(count * 2 > F.col("n"), value).otherwise(F.lit(0).cast("long")))
    return counters.select(key, bits.alias("print"))


def benchmark_items(benchmark: DataFrame, rules: WindowRules) -> DataFrame:
    """(item_id, item, n, width, shingles, print) of items with an id and at least one word. Items of
    fewer words than a shingle are one shingle."""
    rows = documents(benchmark, "item_id", "text").withColumnRenamed("doc_id", "item_id")
    rows = rows.where("item_id IS NOT NULL").withColumn("words", words_of(F.col("text")))
    rows = rows.withColumn("n", F.size("words")).where("n > 0")
    rows = rows.withColumn("width", F.least("n", F.lit(rules.words)))
    shingles = F.coalesce(
        *[F.when(F.col("width") == w, shingles_of("words", w)) for w in range(1, rules.words + 1)]
    )
    items = rows.withColumn("shingles", shingles).select("item_id", "n", "width", "shingles").distinct()
    items = stored(items.withColumn("item", F.monotonically_increasing_id()), "benchmark-bags")
    longest = items.agg(F.max(F.size("shingles"))).first()[0] or 0
    prints = fingerprints(items, "item", "shingles", longest)
    return stored(items.join(prints, "item"), "benchmark-items")


def _sized(df: DataFrame, most: int) -> DataFrame:
    """Marked for broadcast if it has at most ``most`` rows."""
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df


def block_of(print_: Column, block: Column | int, rules: WindowRules) -> Column:
    shift = F.lit(block) * rules.bits if isinstance(block, int) else block * rules.bits
    return F.call_function("shiftrightunsigned", print_, shift).bitwiseAND(F.lit((1 << rules.bits) - 1))


def item_index(items: DataFrame, rules: WindowRules) -> DataFrame:
    """The rows of ``items`` with (block, value, item_print) in place of ``print``: each item under every
    block value within its share of the radius."""
    near = rules.radius // rules.blocks
    masks = [m for m in range(1 << rules.bits) if m.bit_count() <= near]
    blocks = F.explode(F.sequence(F.lit(0), F.lit(rules.blocks - 1))).alias("block")
    keys = [name for name in items.columns if name != "print"]
    rows = items.select(*keys, "print", blocks)
    rows = rows.select("*", F.explode(F.array(*map(F.lit, masks))).alias("mask"))
    value = block_of(F.col("print"), F.col("block"), rules).bitwiseXOR(F.col("mask").cast("long"))
    return rows.select(*keys, "block", value.alias("value"), F.col("print").alias("item_print"))


def starts_of(places: Column, n: Column, width: Column, length: Column) -> Column:
    """First words of the windows of n words that hold one of the places (sorted): each place adds
    the windows that the place before did not have. A text of fewer words is one window."""
    size = F.size(places)
    spans = F.transform(
        F.sequence(F.lit(0), size - 1),
        lambda k: F.struct(
            F.greatest(
                F.lit(0),
                F.get(places, k) - (n - width),
                F.when(k > 0, F.get(places, k - 1) + 1).otherwise(F.lit(0)),
            ).alias("first"),
            F.least(F.get(places, k), length - n).alias("last"),
        ),
    )
    full = F.flatten(
        F.transform(
            F.filter(spans, lambda s: s["first"] <= s["last"]), lambda s: F.sequence(s["first"], s["last"])
        )
    )
    return F.when(length <= n, F.array(F.lit(0))).otherwise(full)


def shared(left: str, right: str) -> Column:
    """Size of the intersection of two bags: of sets, mostly; a repeated entry counts as often as it
    occurs in both."""
    common = F.array_intersect(left, right)
    repeated = F.aggregate(
        common,
        F.lit(0),
        lambda total, x: total
        + F.least(
            F.size(F.filter(left, lambda y: y == x)), F.size(F.filter(right, lambda y: y == x))
        ),
    )
    sets = (F.size(F.array_distinct(left)) == F.size(left)) | (F.size(F.array_distinct(right)) == F.size(right))
    return F.when(sets, F.size(common)).otherwise(repeated)


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    rules: WindowRules = DEFAULT_RULES,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(doc_id, item_id, similarity, windows, first_word): documents with a window similar to a
    benchmark item, one row per pair, with the largest similarity and the first such window.

    Null or empty texts and items match nothing, rows without an id are not examined, rows that
    repeat an id count as one document with several texts, equal items are each reported, other
    columns are not read, and no documents or no items give no rows.
    """
    spark = docs.sparkSession
    items = benchmark_items(benchmark, rules)
    widths = [row["width"] for row in items.select("width").distinct().collect()]  # at most 5 numbers
    rows = documents(docs, id_col, text_col).where("doc_id IS NOT NULL AND text IS NOT NULL")
    if not widths:
        return rows.where("false").selectExpr(
            "doc_id", "0L item_id", "0.0D similarity", "0L windows", "0L first_word"
        )

    words = rows.select("doc_id", F.xxhash64("text").alias("row"), words_of(F.col("text")).alias("words"))
    found = []
    for width in widths:
        keys = items.where(F.col("width") == width).select("item", "n", F.explode("shingles").alias("key")).distinct()
        hits = places_of(words, width).join(_sized(stored(keys, "benchmark-keys"), rules.broadcast_rows), "key")
        found.append(
            hits.groupBy("doc_id", "row", "item", "n")
            .agg(F.first("length").alias("length"), F.sort_array(F.collect_set("place")).alias("places"))
            .withColumn("width", F.lit(width))
        )
    marked = stored(union_all(found), "benchmark-places")
    ids = marked.select("doc_id").distinct()
    some = rows.join(_sized(ids, rules.broadcast_ids), "doc_id", "left_semi").select(
        "doc_id", F.xxhash64("text").alias("row"), "text"
    )
    near = some.dropDuplicates(["doc_id", "row"]).join(marked, ["doc_id", "row"])
    near = near.select("doc_id", "row", "item", "n", "width", "length", "places", words_of(F.col("text")).alias("words"))
    # rows of a few hundred bytes become many windows: as many partitions as there are, none merged
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    near = near.repartition(tasks, "doc_id", "row", "item")
    shingles = F.coalesce(*[F.when(F.col("width") == w, shingles_of("words", w)) for w in widths])
    near = near.select(
        "doc_id",
        "item",
        "n",
        "width",
        shingles.alias("all"),
        F.explode(starts_of(F.col("places"), F.col("n"), F.col("width"), F.col("length"))).alias("start"),
    )
    windows = near.select(
        F.monotonically_increasing_id().alias("number"),
        "doc_id",
        "item",
        "start",
        F.slice("all", F.col("start") + 1, F.col("n") - F.col("width") + 1).alias("window"),
    )
    windows = stored(windows, "benchmark-windows")
    longest = items.agg(F.max(F.size("shingles"))).first()[0]
    prints = fingerprints(windows, "number", "window", longest).join(windows.select("number", "item"), "number")

    index = _sized(stored(item_index(items.select("item", "print"), rules), "benchmark-index"), rules.broadcast_rows)
    looked = prints.select(
        "number", "item", "print", F.explode(F.sequence(F.lit(0), F.lit(rules.blocks - 1))).alias("block")
    ).withColumn("value", block_of(F.col("print"), F.col("block"), rules))
    differing = F.col("print").bitwiseXOR(F.col("item_print"))
    share = rules.radius // rules.blocks
    earlier = F.lit(False)  # found under an earlier block already
    for block in range(rules.blocks - 1):
        close = F.bit_count(block_of(differing, block, rules)) <= share
        earlier = earlier | ((F.col("block") > block) & close)
    candidates = (
        looked.join(index, ["item", "block", "value"])
        .where((F.bit_count(differing) <= rules.radius) & ~earlier)
        .select("number")
    )
    bags = _sized(items.select("item", "item_id", F.col("shingles").alias("bag")), rules.broadcast_rows)
    compared = windows.join(candidates, "number").join(bags, "item").withColumn("shared", shared("window", "bag"))
    rest = F.size("window") + F.size("bag") - F.col("shared")
    return (
        compared.where(100 * F.col("shared") >= rules.similarity * rest)
        .groupBy("doc_id", "item_id")
        .agg(
            F.max(F.col("shared") / rest).alias("similarity"),
            F.count(F.lit(1)).alias("windows"),
            F.min(F.col("start").cast("long")).alias("first_word"),
        )
    )
