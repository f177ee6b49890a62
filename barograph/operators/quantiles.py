"""Exact quantiles without collecting a group.

``percentile`` keeps all distinct values of a group in one buffer, which is right for a group that
is small by its key (a city in a season). For a whole table these functions count the distinct
values and deal them into buckets by an integer key that keeps the order of doubles: exponent, then
the first bits of the mantissa. Bucket totals tell which buckets hold a wanted rank, and only those
are put in order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Mantissa bits of a bucket: values of one bucket differ by less than one part in so many powers of two.
BITS = 12


def melt(df: DataFrame, columns: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """Long form (keys, feature, value) of the non-null numbers; one pass over the rows."""
    pairs = F.array(
        *[F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value")) for c in columns]
    )
    return (
        df.select(*keys, F.explode(pairs).alias("_pair"))
        .select(*keys, "_pair.feature", "_pair.value")
        .where(F.col("value").isNotNull())
    )


def ordered_key(value: Column | str, bits: int = BITS) -> Column:
    """A whole number that never decreases as a double grows; equal for doubles whose exponent and first
    ``bits`` bits of the mantissa are equal. NaN comes last, as it sorts.

    Next to a power of two the logarithm may name the neighbouring exponent; the key is then the last
    one of that exponent or the first one of the next, which keeps the order.
    """
    value = F.col(value) if isinstance(value, str) else value
    value = value.cast("double")
    size = F.abs(value)
    exponent = F.floor(F.log2(size))
    scaled = F.floor(size / F.pow(F.lit(2.0), exponent.cast("double")) * (1 << bits))
    magnitude = (exponent + 1100) * (1 << bits) + scaled - (1 << bits)
    most = F.lit(4000 << bits).cast("long")
    signed = F.when(value > 0, magnitude).otherwise(-magnitude)
    return (
        F.when(F.isnan(value), most + 1)
        .when(size == float("inf"), F.when(value > 0, most).otherwise(-most))
        .when(value == 0, F.lit(0).cast("long"))
        .otherwise(signed)
    )


def value_buckets(counts: DataFrame, keys: Sequence[str], value: str = "value") -> DataFrame:
    """Add ``_slot``, which does not decrease as the value grows: a narrow expression, no pass."""
    return counts.withColumn("_slot", ordered_key(value))


def exact_quantiles(long: DataFrame, keys: Sequence[str], probs: Sequence[float]) -> DataFrame:
    """Linear-interpolated quantiles of (keys, value): columns keys, prob, quantile.

    Rank r = p (n - 1) lies between two neighbours in sorted order; each neighbour is the first
    distinct value whose running count passes its rank. Ranks are first looked up among the totals of
    the buckets of a key; only values of buckets that hold one are ordered.
    """
    keys = list(keys)
    counts = value_buckets(long.groupBy(*keys, "value").agg(F.count(F.lit(1)).alias("_n")), keys)
    upto = Window.partitionBy(*keys).orderBy("_slot").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    totals = (
        counts.groupBy(*keys, "_slot")
        .agg(F.sum("_n").alias("_size"))
        .withColumns({"_end": F.sum("_size").over(upto), "_all": F.sum("_size").over(Window.partitionBy(*keys))})
        .withColumn("_below", F.col("_end") - F.col("_size"))
    )
    rank = F.col("_prob") * (F.col("_all") - 1)

    def held(position: Column, first: str, last: str) -> Column:
        return (position >= F.col(first)) & (position < F.col(last))

    wanted = (
        totals.withColumn("_prob", F.explode(F.array(*[F.lit(float(p)) for p in probs])))
        .withColumn("_rank", rank)
        .where(held(F.floor("_rank"), "_below", "_end") | held(F.ceil("_rank"), "_below", "_end"))
        .groupBy(*keys, "_slot", "_below")
        .agg(F.collect_list(F.struct(F.col("_prob").alias("prob"), "_rank")).alias("_ranks"))
    )
    inside = (
        Window.partitionBy(*keys, "_slot").orderBy("value").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    low, high = F.floor("_rank"), F.ceil("_rank")
    ends = (
        counts.join(wanted, [*keys, "_slot"])
        .withColumn("_upto", F.col("_below") + F.sum("_n").over(inside))
        .withColumn("_from", F.col("_upto") - F.col("_n"))
        .select(*keys, "value", "_from", "_upto", F.explode("_ranks").alias("_want"))
        .select(*keys, "value", "_from", "_upto", "_want.prob", "_want._rank")
        .groupBy(*keys, "prob", "_rank")
        .agg(
            F.max(F.when(held(low, "_from", "_upto"), F.col("value"))).alias("_a"),
            F.max(F.when(held(high, "_from", "_upto"), F.col("value"))).alias("_b"),
        )
    )
    weight = F.col("_rank") - F.floor("_rank")
    value = F.col("_a") + (F.col("_b") - F.col("_a")) * weight
    return ends.select(*keys, "prob", F.when(weight == 0, F.col("_a")).otherwise(value).alias("quantile"))
